"""The registered queries over the operators of this package, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    alignment,
    content_sort,
    host_rules,
    html_crf,
    languages,
    mixing,
    pieces,
    quality,
    repeats,
    runs,
    simhash,
    token_files,
    toxicity,
)
from sluice.llm.common import bounded_batches, table

BYTES, END_ID = public_tokenizers.path("byte_bpe_50k.json"), 2
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.write(docs, BYTES, END_ID).checked_rows()


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.groups(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    bounded_batches(spark)
    found = pages.select("page_id", "url", html_crf.train(pages).column(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def encoded(docs: DataFrame) -> DataFrame:
    """doc_id with counts and digests of a text's ids and of the text that these decode to."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", pieces.round_trip(F.col("text"), PIECES).alias("found")).select("doc_id", "found.*")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


#: Sources nearer to each other than they are, languages by fixed shares, fewer texts of signs; 85 % of all words.
MIX = {
    "source": 0.7,
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "topic": {"signs": 0.02, "note": 0.08, "article": 0.4, "long": 0.5},
}
MIX_KEEP = 0.85


def mixed(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    by = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.form_of(text)}
    return mixing.sample(docs, by, mixing.word_count(text), MIX, MIX_KEEP)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("row.doc_id", "source", "lang", "topic", "n_tokens", "p", "kept")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.kept_texts(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
        F.try_validate_utf8(F.col("kept").cast("string")).alias("kept_text"),  # null where a cut is within a letter
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_rules.judged(table(spark, sf_dir, "documents"), F.col("source"), carry=["doc_id"])
    return rows.select("row.doc_id", *host_rules.MEASURES, "base_failed", "host_rejected", "kept")


def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_out(F.col("doc_id"))
    profiles = languages.learn(docs.filter(~held))
    found = docs.select("doc_id", held.alias("held_out"), languages.predicted(F.col("text"), profiles).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def toxicity_chain(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Chain:
    """The chain low quality, then toxic, fitted on the labels."""
    labels = table(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    return toxicity.fit(docs, labels, ["low_quality", "toxic"])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.scores(docs, toxicity_chain(spark, docs, sf_dir))
    p = F.col("p.toxic")
    return scored.select(
        "row.doc_id", F.col("p.low_quality").alias("p_low_quality"), p.alias("p_toxic"), (p >= toxicity.THRESHOLD).alias("toxic")
    )


def with_periods(doc_id: Column, text: Column) -> Column:
    """The text; of a tenth of the documents, by a hash of the id, all words from one on are the first few of these in turn.
    A text with a null id stays."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    period = F.slice(words, a + 1, p)
    all_words = F.concat(F.slice(words, F.lit(1), a), F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), F.array_join(F.slice(all_words, F.lit(1), n), " ")).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bounded_batches(spark)
    rows = docs.select("doc_id", runs.found(with_periods(F.col("doc_id"), F.col("text"))).alias("found"))
    rows = rows.select("doc_id", "found.*")
    # The exponents length / period are compared as products; runs come by start, then period, so that the first of equal ones stays.
    larger = "r.length * greatest.period > greatest.length * r.period"
    greatest = F.expr(f"aggregate(runs, get(runs, 0), (greatest, r) -> if({larger}, r, greatest))")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("r", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "r.start", "r.length", "r.period",
        F.expr("1000 * r.length div r.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by a hash of the id; none without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


QUALITY_LIMIT = 0.7


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality.learn(docs, labels).column(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_LIMIT).cast("int"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), BYTES, PIECES).documents()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_main_text": op3_main_text,
        "op4_pieces": op4_pieces,
        "op5_mixing": op5_mixing,
        "op6_repeats": op6_repeats,
        "op7_simhash": op7_simhash,
        "op8_host_rules": op8_host_rules,
        "op9_languages": op9_languages,
        "op10_toxicity": op10_toxicity,
        "op11_runs": op11_runs,
        "op12_quality": op12_quality,
        "op13_alignment": op13_alignment,
    }


OP2_SQL = """
with n as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as normal from documents),
g as (
  select *, sha256(normal) as text_sha256, count(*) over (partition by normal) as group_size,
         first_value(doc_id) over (partition by normal order by chars desc, doc_id) as keep_id from n)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g"""


OP6_SQL = """
with t as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n_bytes from documents),
starts as (
  select doc_id, i, md5(substr(h, 2 * i + 1, 800)) as w from t, unnest(range(0, greatest(n_bytes - 399, 0))) as u(i)),
again as (select doc_id, i from (select *, count(*) over (partition by w) as c from starts) where c > 1),
heads as (
  select doc_id, i, (i - lag(i) over (partition by doc_id order by i) <= 400) is not true as head from again),
parts as (select doc_id, i, count_if(head) over (partition by doc_id order by i) as part from heads),
spans as (select doc_id, min(i) as a, max(i) + 400 as b from parts group by doc_id, part),
gaps as (select *, coalesce(lag(b) over (partition by doc_id order by a), 0) as z from spans),
cut as (
  select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, max(b) as last,
         string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' order by a) as head
  from gaps join t using (doc_id) group by doc_id),
kept as (
  select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
         unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1)) as bytes
  from t left join cut using (doc_id))
select doc_id, n_bytes, n_removed, n_spans, sha256(bytes) as kept_sha256, try(decode(bytes)) as kept_text from kept"""


def _op8_sql() -> str:
    rules, limit = host_rules.HOST_RULES, host_rules.HOST_LIMIT
    few, most = host_rules.LEAST_PRIOR, host_rules.MOST_PRIOR
    sums = ", ".join(f"sum(case when {rule} then 1 else 0 end) as f_{name}" for name, rule in rules.items())
    totals = ", ".join(f"sum(f_{r}) / sum(n) as m_{r}" for r in rules)
    spread = ", ".join(f"sum(n * (f_{r} / n - m_{r}) ** 2) / any_value(total) as v_{r}" for r in rules)
    weight = {
        r: f"greatest({few}, least({most}, case when v_{r} - m_{r} * (1 - m_{r}) * hosts / total > 0 then "
        f"m_{r} * (1 - m_{r}) / (v_{r} - m_{r} * (1 - m_{r}) * hosts / total) - 1 else {most} end))"
        for r in rules
    }
    worst = ", ".join(f"(f_{r} + {w} * m_{r}) / (n + {w})" for r, w in weight.items())
    base = " or ".join(f"({rule})" for rule in host_rules.BASE_RULES.values())
    return f"""
with t as (
  select doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as win from t, unnest(range(1, len(w) - 3)) as r(i)),
twice as (select doc_id, i, count(*) over (partition by doc_id, win) as c from windows),
repeats as (
  select doc_id, count(distinct i + k) as n from twice, unnest([0, 1, 2, 3, 4]) as u(k) where c > 1 group by doc_id),
m as (
  select doc_id, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
  from t left join repeats using (doc_id)),
hosts as (select source, count(*) as n, {sums} from m where source is not null group by source),
a as (select sum(n) as total, count(*) as hosts, {totals} from hosts),
v as (select {spread} from hosts, a),
verdicts as (select source, greatest({worst}) > {limit} as rejected from hosts, a, v)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) as base_failed,
       coalesce(rejected, false) as host_rejected, not ({base}) and not coalesce(rejected, false) as kept
from m left join verdicts using (source)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op6_repeats": OP6_SQL, "op8_host_rules": _op8_sql()}
