"""Toxicity from confirmed examples and unlabelled text (non-negative PU learning).

A linear classifier over the presence of words and beginnings of words is trained with numpy on the risk
``prior * E+[loss(+)] + max(0, Eu[loss(-)] - prior * E+[loss(-)])``; when the second part
would turn negative, the step goes the other way, so that the classifier cannot win by
calling all unlabelled text clean. Labels of clean documents are used for the prior alone.

The fit takes a bounded sample: ``MAX_POSITIVE`` confirmed documents and ``MAX_UNLABELLED``
others at most, by hash of their id and text (copies of a row count once), and of their features (hashed to 2^20 numbers) the ``FEATURES``
that are most over-represented in the confirmed ones. Scores read whole texts of all rows.

Defined cases: a null text counts as empty; an empty text scores by the bias alone; without
confirmed examples every score is 0; a label that is null, or not 0 or 1, is ignored; of
repeated labels of one document the largest counts; ids that are null carry no label and are
scored; very long texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import settle

THRESHOLD = 0.7
MAX_POSITIVE, MAX_UNLABELLED = 5_000, 10_000
WORD_BITS = 20
FEATURES = 2_048
#: Beginnings of words that are features beside the whole word.
PREFIXES = (4, 5)
#: Standard errors by which a feature must be over-represented; share and number of confirmed
#: documents that must hold it.
LEAST_Z, LEAST_SHARE, LEAST_DOCS = 4.0, 0.005, 2
ROUNDS, RATE, DECAY = 300, 0.1, 1e-4
PUNCTUATION = ".,;:!?\"'()[]|"
#: Bytes of words that a task remembers the numbers of, the longest word that it does, and what
#: an entry takes beside its letters.
REMEMBERED, LONGEST, ENTRY = 24 << 20, 64, 250


class WordNumbers(dict):
    """Feature numbers of a word, written as it stands in the text, within REMEMBERED bytes."""

    bytes = 0

    def __missing__(self, raw: str) -> tuple[int, ...]:
        word = raw.strip(PUNCTUATION).lower()
        parts = [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)] if word else []
        numbers = tuple(zlib.crc32(p.encode()) & ((1 << WORD_BITS) - 1) for p in parts)
        if len(raw) <= LONGEST and self.bytes < REMEMBERED:
            self.bytes += ENTRY + len(raw)
            self[raw] = numbers
        return numbers

    def of(self, text: str | None) -> set[int]:
        return set().union(*map(self.__getitem__, set(text.split()))) if text else set()


@dataclass
class Model:
    numbers: np.ndarray  # word numbers, sorted
    weights: np.ndarray
    bias: float

    def by_number(self) -> dict[int, float]:
        return dict(zip(self.numbers.tolist(), self.weights.tolist()))


def bounded(rows: DataFrame, order: Column, most: int, keep: str) -> DataFrame:
    """(order, keep) of the ``most`` rows that come first by a 64-bit hash; copies count once.

    The hash thins the rows to about that many, spread over the tasks; these are computed once,
    and only their hashes are put in order to find the last one.
    """
    hashed = rows.select(order.alias("order"), keep)
    count = hashed.agg(F.approx_count_distinct("order")).first()[0]
    if count > most:
        hashed = hashed.filter(F.col("order") < min(2**63 - 1, int(1.2 * most / count * 2**64) - 2**63))
    few = settle(hashed.groupBy("order").agg(F.min(keep).alias(keep)), 2 * most)
    last = few.select("order").orderBy("order").limit(most).agg(F.max("order")).first()[0]
    return few.filter(F.col("order") <= F.lit(last))


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, key: str, text: str, label: str) -> tuple[DataFrame, float]:
    """(positive, words) of the sample, and the share of confirmed rows among the labelled.

    ``usable`` says, from the id alone, whose labels may be read.
    """
    known = (
        labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .withColumn("usable", usable)
        .filter("usable")
    )
    total, positive = known.agg(F.count("y"), F.sum("y")).first()
    prior = (positive or 0) / total if total else 0.0
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("body"))
    held = rows.filter("id is not null").withColumn("usable", usable).filter("usable").drop("usable")
    # At most 2 * MAX_POSITIVE ids are broadcast.
    chosen = bounded(known.filter(F.col("y") == 1), F.xxhash64("id"), 2 * MAX_POSITIVE, "id")
    confirmed = held.join(F.broadcast(chosen.select("id")), "id", "left_semi")
    order = F.xxhash64("id", "body")
    taken = [
        bounded(part, order, most, "body").select(F.lit(label).alias("positive"), "body")
        for label, part, most in ((1, confirmed, MAX_POSITIVE), (0, held, MAX_UNLABELLED))
    ]
    sample = taken[0].unionAll(taken[1])

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = WordNumbers()
        for batch in batches:
            yield pd.DataFrame(
                {"positive": batch["positive"], "words": [np.array(sorted(numbers.of(t)), dtype=np.int32) for t in batch["body"]]}
            )

    return sample.mapInPandas(words, "positive int, words array<int>"), prior


def choose_features(rows: DataFrame) -> np.ndarray:
    """Numbers of the words whose share among confirmed rows is surely above the others'."""
    sizes = rows.groupBy("positive").count().collect()
    n = {r["positive"]: r["count"] for r in sizes}
    if not n.get(1):
        return np.zeros(0, dtype=np.int64)
    n1, n0 = n[1], max(1, n.get(0, 0))
    counted = (
        rows.select("positive", F.explode("words").alias("w"))
        .groupBy("w")
        .agg(F.sum("positive").alias("c1"), F.sum(1 - F.col("positive")).alias("c0"))
        .filter(F.col("c1") >= max(LEAST_DOCS, LEAST_SHARE * n1))
    )
    p1, p0 = F.col("c1") / n1, (F.col("c0") + 0.5) / (n0 + 1.0)
    z = (p1 - p0) / F.sqrt(p0 * (1 - F.least(p0, F.lit(0.999))) / n1)
    top = counted.withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.col("z").desc(), "w").limit(FEATURES)
    return np.array(sorted(r["w"] for r in top.select("w").collect()), dtype=np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(sets: list[np.ndarray], positive: np.ndarray, features: np.ndarray, prior: float) -> Model:
    """Adam on the non-negative risk with the logistic loss.

    ``sets`` has, for each row, the positions of its features.
    """
    sizes = np.array([len(s) for s in sets])
    column = np.concatenate([*sets, np.zeros(0, dtype=np.int32)]).astype(np.int32)
    row = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    n1, n0 = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    theta = np.zeros(len(features) + 1)
    theta[-1] = np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        f = np.bincount(row, weights=theta[column], minlength=len(sets)) + theta[-1]
        p = _sigmoid(f)
        # Losses: softplus(-f) if called positive, softplus(f) if called negative.
        soft = np.logaddexp(0, f)
        negative_part = soft[~positive].sum() / n0 - prior * soft[positive].sum() / n1
        down = np.where(positive, -prior * p / n1, p / n0)
        up = np.where(positive, -prior * (1 - p) / n1, 0.0)
        slope = up + down if negative_part >= 0 else -down
        gradient = np.append(np.bincount(column, weights=slope[row], minlength=len(features)), slope.sum())
        gradient[:-1] += DECAY * theta[:-1]
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(features, theta[:-1], float(theta[-1]))


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model | None:
    """None without confirmed examples. ``usable`` is a condition on the column ``id``."""
    rows, prior = training_rows(docs, labels, usable, key, text, label)
    rows = settle(rows)
    features = choose_features(rows)
    if not len(features):
        return None

    def positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [np.flatnonzero(np.isin(features, w, assume_unique=True)).astype(np.int32) for w in batch["words"]]
            yield pd.DataFrame({"positive": batch["positive"], "at": at})

    # At most MAX_POSITIVE and MAX_UNLABELLED rows of at most FEATURES numbers.
    found = rows.mapInPandas(positions, "positive int, at array<int>").toPandas().sort_values("positive", kind="stable")
    return fit(list(found["at"]), found["positive"].to_numpy() == 1, features, prior)


def toxicity(text: Column, model: Model | None) -> Column:
    """Probability of the toxic class."""
    if model is None:
        return F.lit(0.0)
    weights, bias = model.by_number(), model.bias

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        numbers = WordNumbers()
        known = weights.keys()
        for batch in batches:
            sums = [sum(weights[w] for w in sorted(numbers.of(t) & known)) for t in batch]
            yield pd.Series(_sigmoid(np.array(sums, dtype=np.float64) + bias))

    return score(text)
