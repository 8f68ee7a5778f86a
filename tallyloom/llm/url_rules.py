"""Verdicts on addresses from many rules, of which each address runs only a few.

Rules are written as filter lists write them: ``||`` is the start of a host or of one of
its labels, ``^`` a separator or an end, ``*`` anything, all else stands for itself. Every
rule is indexed by the rarest of its whole literal tokens, rarest by count over the given
addresses; the tokens of an address fetch candidate rules, and only those run their regular
expression. A rule without a whole literal token is a candidate for every address. Of the
rules that match, one of a site (``||``) wins over any other, then the longer, then the
greater text. Built-in expressions only.

Defined cases: a null address or one without ``://`` has an empty host and path and meets
only rules that match the empty text; an address no rule matches is allowed; repeated rows
each get their verdict; an empty table or rule list works. Other columns pass through, those
named like a result column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Rules up to which their index is broadcast; a shuffle join beyond.
BROADCAST_RULES = 10_000
#: Rules up to which the index is written into the plan as literals.
INLINE_RULES = 2_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def is_site(self) -> bool:
        return self.text.startswith("||")

    @property
    def name(self) -> str:
        return self.text.removeprefix("||")

    @property
    def regex(self) -> str:
        """Over host and path in one; sites match case, others don't."""
        start = r"(?s)^(?:[^/]*\.)?" if self.is_site else "(?is)"
        wild = {"^": "(?:[^a-z0-9]|^|$)", "*": ".*"}
        return start + "".join(wild.get(c) or re.escape(c) for c in self.name)

    @property
    def tokens(self) -> list[str]:
        """Literal runs that stand whole in every address the rule matches."""
        shown = self.text.lower()
        return sorted(set(re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", shown)))


#: The production list. Fixed values.
SITE_RULES = [
    Rule("block", "||net/"),
    Rule("allow", "||example.net/en/"),
    Rule("block", "||example.com/de/"),
    Rule("allow", "||org/fr/"),
]
PATTERN_RULES = [
    Rule("block", f"^{word}^")
    for word in "adult bet betting casino escort gambling jackpot nude poker porn sex slots viagra warez xxx".split()
] + [
    Rule("block", "^free^download^"),
    Rule("block", "^track^*^click^"),
    Rule("block", "^wp^login.php"),
]
RULES = SITE_RULES + PATTERN_RULES


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _tokens(place: Column) -> Column:
    """Whole tokens of an address; the empty one fetches the rules that have none."""
    runs = F.split(F.translate(place, UPPER, LOWER), "[^a-z0-9]+")
    return F.array_union(F.array(F.lit("")), runs)


def rule_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(rule_id, verdict, name, is_site, regex, token): a row per literal token of a rule."""
    rows = [
        (number, r.verdict, r.name, r.is_site, r.regex, token)
        for number, r in enumerate(rules)
        for token in (r.tokens or [""])
    ]
    names = ["rule_id", "verdict", "name", "is_site", "regex", "token"]
    if rows and len(rules) <= INLINE_RULES:
        structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names))) for row in rows]
        return spark.range(1).select(F.inline(F.array(*structs)))
    return spark.createDataFrame(
        rows, "rule_id int, verdict string, name string, is_site boolean, regex string, token string"
    )


def judge(pages: DataFrame, url: str = "url", rules: list[Rule] | None = None) -> DataFrame:
    """Input columns with host, path, rule (site rules), pattern (others) and verdict."""
    rules = RULES if rules is None else rules
    spark = pages.sparkSession
    small = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    listed = rule_frame(spark, rules)

    address = F.col(url)
    places = (
        pages.select(address.alias("__url"))
        .filter("__url is not null")
        .select("__url", F.concat(host_of(F.col("__url")), path_of(F.col("__url"))).alias("place"))
    )
    tokens = places.select("__url", "place", F.explode(_tokens(F.col("place"))).alias("token"))

    # How often each rule token occurs: pre-aggregated, one row per token of the rules.
    seen = tokens.join(small(listed.select("token").distinct()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        listed.join(seen, "token", "left")
        .groupBy("rule_id", "verdict", "name", "is_site", "regex")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    hits = (
        tokens.join(small(rarest), "token")
        .filter(F.expr("place rlike regex"))
        .groupBy("__url")
        .agg(F.max(F.struct("is_site", F.length("name").alias("size"), "name", "verdict")).alias("__hit"))
    )
    hit = F.col("__hit")
    site = F.coalesce(hit["is_site"], F.lit(False))
    return (
        pages.withColumn("__key", address)
        .join(hits, F.col("__key") == F.col("__url"), "left")
        .withColumn("host", host_of(F.col("__key")))
        .withColumn("path", path_of(F.col("__key")))
        .withColumn("rule", F.when(site, hit["name"]))
        .withColumn("pattern", F.when(~site, hit["name"]))
        .withColumn("verdict", F.coalesce(hit["verdict"], F.lit("allow")))
        .drop("__key", "__url", "__hit")
    )
