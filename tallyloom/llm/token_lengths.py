"""Exact histogram of encoded lengths, and what suffix sums over it answer.

Documents are aggregated by token count before anything is shuffled; all further work is on
one row per different length. Lengths are dealt into bands; sums run within a band, and the
totals of the bands carry them on, so no task sees more than a band or the list of bands.

Defined cases: a null or empty text has length 0 (``end_token`` adds one to all); groups may
be null; an empty table gives no rows; repeated rows count each; a limit above or between
the lengths is answered exactly; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm.common import settle
from tallyloom.llm.encoding import Encoder, tokenizer_path

#: Lengths of a band.
BAND = 1_024


def token_count(text: Column, path: str | None = None) -> Column:
    path = path or tokenizer_path()

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = Encoder(path)
        return pd.Series([len(encode(t)) // 4 for t in texts], dtype="int64")

    return count(text)


def length_histogram(docs: DataFrame, text: str = "text", groups: list[str] | None = None, path: str | None = None) -> DataFrame:
    """(groups…, length, docs): how many documents have each encoded length, computed once."""
    groups = groups or []
    sized = docs.select(*groups, token_count(F.col(text), path).alias("length"))
    return settle(sized.groupBy(*groups, "length").agg(F.count(F.lit(1)).alias("docs")))


def limits_answered(histogram: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """A row per length taken as context limit.

    docs_up_to and share_up_to are of documents that fit; docs_beyond and tokens_beyond of
    those that are longer; tokens_total of all documents; tokens_truncated is what is left
    when every document is cut at the limit.
    """
    groups = groups or []
    tokens = F.col("length").cast("decimal(38,0)") * F.col("docs")
    bands = histogram.withColumn("band", F.floor(F.col("length") / BAND)).withColumn("tokens", tokens)
    sums = bands.groupBy(*groups, "band").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    over = W.partitionBy(*groups).orderBy(F.col("band").desc()).rowsBetween(W.unboundedPreceding, -1)
    all_of = W.partitionBy(*groups)
    carried = sums.select(
        *groups,
        "band",
        F.coalesce(F.sum("d").over(over), F.lit(0)).alias("d_over"),
        F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t_over"),
        F.sum("d").over(all_of).alias("docs_total"),
        F.sum("t").over(all_of).alias("tokens_total"),
    )
    # Names that may clash are told apart before the join; groups may be null.
    theirs = carried.select(*(F.col(g).alias(f"__{g}") for g in groups), F.col("band").alias("__band"), "d_over", "t_over", "docs_total", "tokens_total")
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups] + [F.col("band") == F.col("__band")]
    inside = W.partitionBy(*groups, "band").orderBy(F.col("length").desc()).rowsBetween(W.unboundedPreceding, -1)
    rows = bands.join(theirs, same).select(
        *groups,
        F.col("length").alias("context_limit"),
        "docs",
        (F.coalesce(F.sum("docs").over(inside), F.lit(0)) + F.col("d_over")).alias("docs_beyond"),
        (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("t_over")).alias("tokens_beyond"),
        "docs_total",
        "tokens_total",
    )
    return rows.select(
        *groups,
        "context_limit",
        "docs",
        (F.col("docs_total") - F.col("docs_beyond")).alias("docs_up_to"),
        ((F.col("docs_total") - F.col("docs_beyond")) / F.col("docs_total")).alias("share_up_to"),
        "docs_beyond",
        F.col("tokens_beyond").cast("long").alias("tokens_beyond"),
        F.col("tokens_total").cast("long").alias("tokens_total"),
        (F.col("tokens_total") - F.col("tokens_beyond") + F.col("context_limit") * F.col("docs_beyond"))
        .cast("long")
        .alias("tokens_truncated"),
    )


#: Context limits and shares of documents that a report answers.
LIMITS = [2**k for k in range(7, 18)]
SHARES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def chosen(answers: DataFrame, limits: list[int], shares: list[float], groups: list[str] | None = None) -> DataFrame:
    """Rows of ``limits_answered`` for limits of any size, and for quantiles of the lengths.

    Read off the suffix sums: what is beyond a limit is beyond the longest length within it; a
    quantile is the smallest length that at least that share of documents has or is below.
    ``kind`` tells limits from quantiles, whose share is in ``share``.
    """
    groups = groups or []
    names = [c for c in answers.columns if c not in groups]
    row, limit = F.struct(*names), F.col("context_limit")
    every = (F.max(F.col("docs_up_to") + F.col("docs_beyond")).alias("docs_total"), F.max("tokens_total").alias("tokens_total"))
    within = [F.max(F.when(limit <= at, row)).alias(f"l{k}") for k, at in enumerate(limits)]
    reached = [F.min(F.when(F.col("share_up_to") >= share, row)).alias(f"q{k}") for k, share in enumerate(shares)]
    one = answers.groupBy(*groups).agg(*every, *within, *reached).filter("docs_total is not null")
    rows = []
    for k, at in enumerate(limits):
        found, docs, tokens = F.col(f"l{k}"), F.col("docs_total"), F.col("tokens_total")
        beyond, tokens_beyond = F.coalesce(found["docs_beyond"], docs), F.coalesce(found["tokens_beyond"], tokens)
        values = {
            "context_limit": F.lit(at).cast("long"),
            "docs": F.when(found["context_limit"] == at, found["docs"]).otherwise(F.lit(0)),
            "docs_up_to": docs - beyond,
            "share_up_to": (docs - beyond) / docs,
            "docs_beyond": beyond,
            "tokens_beyond": tokens_beyond,
            "tokens_total": tokens,
            "tokens_truncated": tokens - tokens_beyond + F.lit(at) * beyond,
        }
        rows.append(_chosen("limit", F.lit(None).cast("double"), values))
    for k, share in enumerate(shares):
        rows.append(_chosen("quantile", F.lit(float(share)), {name: F.col(f"q{k}.{name}") for name in names}))
    return one.select(*groups, F.inline(F.array(*rows)))


def _chosen(kind: str, share: Column, values: dict[str, Column]) -> Column:
    return F.struct(F.lit(kind).alias("kind"), share.alias("share"), *(v.alias(n) for n, v in values.items()))


def length_report(histogram: DataFrame, group: str, limits: list[int] | None = None, shares: list[float] | None = None) -> DataFrame:
    """Every occurring length, the limits and the quantiles, for each group and (scope ``all``) for all documents.

    ``histogram`` is by the one group; the whole histogram is its sum, so texts are encoded once.
    """
    limits, shares = LIMITS if limits is None else limits, SHARES if shares is None else shares
    whole = histogram.groupBy("length").agg(F.sum("docs").alias("docs"))
    parts = []
    for scope, counts, groups in (("group", histogram, [group]), ("all", whole, [])):
        answers = limits_answered(counts, groups)
        each = answers.withColumns({"kind": F.lit("length"), "share": F.lit(None).cast("double")})
        both = each.unionByName(chosen(answers, limits, shares, groups)).withColumn("scope", F.lit(scope))
        parts.append(both if groups else both.withColumn(group, F.lit(None).cast(histogram.schema[group].dataType)))
    return parts[0].unionByName(parts[1])


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_up_to, tokens_truncated) of any limits, from an ungrouped histogram."""
    return chosen(limits_answered(histogram), limits, []).select("context_limit", "docs_up_to", "tokens_truncated")


def length_quantile(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least that share of documents has or is below."""
    return chosen(limits_answered(histogram), [], shares).select("share", F.col("context_limit").alias("length"))
