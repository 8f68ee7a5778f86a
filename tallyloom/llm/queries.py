"""One query per operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    alignment,
    decontaminate,
    fingerprint,
    language,
    lexical_search,
    line_frequency,
    packing,
    personal_data,
    simhash,
    token_lengths,
    toxicity,
    url_rules,
    warc,
)
from tallyloom.llm.common import drop_folder, read, remainder, work_folder


def op1_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprint_edits(read(spark, folder, "documents"))


def op2_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return line_frequency.drop_boilerplate(docs).select("doc_id", "source", "text", "lines_dropped")


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    contents = language.learn(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return docs.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        language.language(F.col("text"), contents).alias("found"),
    ).select("doc_id", "held_out", "found.*")


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = work_folder(spark, "warc")
    try:
        warc.write_archives(warc.records_of(read(spark, folder, "pages")), archives)
        headers = warc.read_archives(spark, archives)  # read at once
    finally:
        drop_folder(spark, archives)
    return headers.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return token_lengths.length_report(token_lengths.length_histogram(docs, groups=["lang"]), "lang")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.learn(docs, read(spark, folder, "labels"), remainder(F.col("id"), 3) != 1)
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and item that it holds; documents that hold none have no row."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    matched = decontaminate.with_matches(docs, read(spark, folder, "benchmark"))
    return matched.select("doc_id", F.inline("matches"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignments(read(spark, folder, "documents"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    found = personal_data.find_personal_data(docs.select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def held(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id",
        *map(held, personal_data.BASE_KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data_digest(read(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprint,
        op2_line_frequency,
        op3_url_rules,
        op4_language,
        op5_warc,
        op6_token_lengths,
        op7_toxicity,
        op8_decontaminate,
        op9_packing,
        op10_simhash,
        op11_lexical_search,
        op12_alignment,
        op13_personal_data,
    )
}

_BARE = "trim({0}, ' ' || chr(9) || chr(13))"

_OP2 = f"""
with lines as (
  select r, source, unnest(string_split(text, chr(10))) as raw
  from (select row_number() over () as r, source, text from documents where source is not null)
), bare as (
  select distinct r, source, {_BARE.format('raw')} as line from lines
), totals as (
  select source, count(*) as site_pages from documents group by source
), flagged as (
  select b.source, b.line from bare b join totals t on b.source = t.source
  where b.line <> '' group by b.source, b.line, t.site_pages
  having count(*) >= {line_frequency.MIN_PAGES} and count(*) > cast({line_frequency.RATIO} as double) * t.site_pages
), flags as (
  select source, list(line) as dropped from flagged group by source
), kept as (
  select d.doc_id, d.source, d.text, f.dropped,
    list_filter(string_split(d.text, chr(10)), lambda x: not list_contains(f.dropped, {_BARE.format('x')})) as rest
  from documents d left join flags f on d.source = f.source
)
select doc_id, source,
  case when dropped is null or text is null then text else array_to_string(rest, chr(10)) end as text,
  case when dropped is null or text is null then 0 else len(string_split(text, chr(10))) - len(rest) end as lines_dropped
from kept
"""

_PLACE = "coalesce(regexp_extract(url, '{0}', {1}), '')"
_HOST = f"translate({_PLACE.format(url_rules.PARTS, 1)}, '{url_rules.UPPER}', '{url_rules.LOWER}')"


def _first(rules: list[url_rules.Rule], answer) -> str:
    """The first rule that matches, the longest first."""
    ranked = sorted(rules, key=lambda r: (len(r.name), r.name), reverse=True)
    tests = "".join(f" when regexp_matches(host || path, '{r.regex}') then '{answer(r)}'" for r in ranked)
    return f"case{tests} end"


_OP3 = f"""
with places as (
  select page_id, url, {_HOST} as host, {_PLACE.format(url_rules.PARTS, 2)} as path from pages
), judged as (
  select page_id, host, path,
    case when url is not null then {_first(url_rules.SITE_RULES, lambda r: r.name)} end as rule,
    {_first(url_rules.SITE_RULES, lambda r: r.verdict)} as site_verdict,
    case when url is not null then {_first(url_rules.PATTERN_RULES, lambda r: r.name)} end as any_pattern,
    {_first(url_rules.PATTERN_RULES, lambda r: r.verdict)} as pattern_verdict
  from places
)
select page_id, host, path, rule,
  case when rule is null then any_pattern end as pattern,
  case when rule is not null then site_verdict when any_pattern is not null then pattern_verdict else 'allow' end as verdict
from judged
"""

_OP5 = f"""
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), o as (
  select payload_digest, max(page_id) as original from p where payload_bytes >= {warc.MIN_BYTES} group by payload_digest
)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when o.original is not null and o.original <> p.page_id then 'revisit' else 'response' end as record_type,
  case when o.original <> p.page_id then o.original end as refers_to
from p left join o on p.payload_digest = o.payload_digest
"""

_TERMS = f"regexp_extract_all(translate(text, '{url_rules.UPPER}', '{url_rules.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_OP11 = f"""
with docs as (
  select row_number() over () as r, doc_id, {_TERMS} as terms from documents
), sized as (
  select r, doc_id, len(terms) as n, terms from docs where len(terms) > 0
), whole as (
  select count(*) as docs_n, sum(n)::bigint as terms_n from sized
), held as (
  select r, doc_id, n, term, count(*) as tf from (select r, doc_id, n, unnest(terms) as term from sized) group by all
), weights as (
  select term, floor(1000 * ln((2 * docs_n + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from held, whole group by term, docs_n
), asked as (
  select distinct i, item_id, term from (
    select i, item_id, unnest({_TERMS}) as term from (select row_number() over () as i, item_id, text from benchmark)
  )
), scored as (
  select i, item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs_n) // terms_n)))))::bigint as score
  from asked join held using (term) join weights using (term), whole group by all
), ranked as (
  select item_id, row_number() over (partition by i order by score desc, doc_id)::int as rank, doc_id, score
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= {lexical_search.BEST}
"""

ORACLE = {"op11_lexical_search": _OP11, "op2_line_frequency": _OP2, "op3_url_rules": _OP3, "op5_warc": _OP5}
