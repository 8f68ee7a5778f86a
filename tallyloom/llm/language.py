"""Language by compression against one raw-content dictionary per language.

A text is cut into blocks, each block is compressed with every language's dictionary, and
the language with the smallest sum wins; a narrow margin marks the row as not accepted.

The dictionaries come from a bounded sample: ``SAMPLE_TEXTS`` different texts a language,
``SAMPLE_CHARS`` characters of each from a place its hash picks. Sampled texts that the first
dictionaries give to another language are left out of the final ones, as labels can be wrong.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any
learned language everything is ``und``; texts of any length are compressed whole; rows with a
null language or text are not learned from, nor languages beyond the ``MOST_LANGUAGES`` most
frequent; equal texts get equal results; of equal sums the
smaller language name wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SAMPLE_TEXTS = 200
SAMPLE_CHARS = 2_000
#: Languages learned, the most frequent first: every text is compressed once for each.
MOST_LANGUAGES = 200
#: Bytes of a dictionary, and of a text block compressed against it at this level.
DICTIONARY_BYTES = 32_768
BLOCK_BYTES = 4_096
LEVEL = 12
#: Share of the best size by which the second must be larger.
MARGIN = 0.02
RESULT = "struct<lang_pred: string, score: double, accepted: boolean>"


def training_sample(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """At most SAMPLE_TEXTS excerpts a language; which ones depends on the texts alone."""
    known = rows.select(F.col(lang).alias("l"), F.col(text).alias("t")).filter("l is not null and length(t) > 0")
    known = known.withColumn("h", F.xxhash64("t"))
    sizes = known.groupBy("l").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.col("n").desc(), "l").limit(MOST_LANGUAGES)
    # A third more than wanted, so that the count's error hardly ever leaves too few.
    share = F.least(F.lit(1.0), F.lit(1.4 * SAMPLE_TEXTS) / F.col("n"))
    picked = (
        known.join(F.broadcast(sizes), "l")
        .filter(F.pmod("h", F.lit(1_000_003)) < share * 1_000_003)
        .select("l", "h", F.length("t").alias("n"), "t")
        .withColumn("at", 1 + F.pmod(F.shiftright("h", 20), F.greatest(F.lit(1), F.col("n") - SAMPLE_CHARS + 1)))
        .select("l", "h", F.col("t").substr(F.col("at").cast("int"), F.lit(SAMPLE_CHARS)).alias("t"))
        .dropDuplicates(["l", "h"])
        .withColumn("k", F.row_number().over(W.partitionBy("l").orderBy("h")))
        .filter(F.col("k") <= SAMPLE_TEXTS)
    )
    found: dict[str, list[str]] = {}
    for row in picked.orderBy("l", "k").collect():
        found.setdefault(row["l"], []).append(row["t"])
    return found


def dictionary_of(texts: list[str]) -> bytes:
    """An equal share of every text, in order."""
    share = max(64, DICTIONARY_BYTES // max(1, len(texts)))
    joined = b"\n".join(t.encode()[:share] for t in texts)
    return joined[:DICTIONARY_BYTES]


class Dictionaries:
    def __init__(self, contents: dict[str, bytes]):
        self.names = sorted(name for name, content in contents.items() if len(content) >= 8)
        self.coders = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.coders.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, text: str) -> list[int]:
        data = text.encode()
        blocks = [data[k : k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(coder.compress(block)) for block in blocks) for coder in self.coders]

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        if not self.names or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, False
        ranked = sorted(zip(self.sizes(text), self.names))
        if len(ranked) == 1:
            return ranked[0][1], 1.0, True
        margin = (ranked[1][0] - ranked[0][0]) / ranked[0][0]
        return ranked[0][1], margin / (margin + MARGIN), margin >= MARGIN


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary content by language."""
    sample = training_sample(rows, text, lang)
    first = Dictionaries({name: dictionary_of(texts) for name, texts in sample.items()})
    clean = {name: [t for t in texts if first.decide(t)[0] == name] for name, texts in sample.items()}
    return {name: dictionary_of(clean[name] or texts) for name, texts in sample.items()}


def language(text: Column, contents: dict[str, bytes]) -> Column:
    """struct(lang_pred, score, accepted): score 0.5 is the margin that is just accepted."""

    @F.pandas_udf(RESULT)
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Dictionaries(contents)
        for batch in batches:
            yield pd.DataFrame(
                [model.decide(t) for t in batch], columns=["lang_pred", "score", "accepted"]
            )

    return decide(text)
