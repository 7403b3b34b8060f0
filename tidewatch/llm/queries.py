"""The operators of this package as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, decontam, imatch, infill, licenses, lines, ngrams, packing, repeats, simhash, substrings, toxicity, urls
from .common import read


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.format_chats(turns.unionByName(control), path))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=2048, end=1)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"), size=4, radius=4)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity.grade(docs, toxicity.train(docs, read(spark, folder, "labels")))


def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.edited_fingerprints(read(spark, folder, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"), window=13, share=20)


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.dedup(read(spark, folder, "documents"), window=20)
    kept = F.sha2(substrings.kept_words("text").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(read(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.score(read(spark, folder, "documents"))


def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = infill.transform(read(spark, folder, "documents"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return infill.restore(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


def _tails_repeated(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten repeats a part of its words to the end."""
    white = r"[\x20\x09-\x0D]+"
    text = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, g = F.split(text, white), F.floor(h / 10)
    n = F.size("words")
    rows = docs.select("doc_id", text.alias("text"), h.alias("h"), g.alias("g"))
    rows = rows.withColumn("words", F.when((F.col("h") % 10 == 0) & (text != ""), words))
    rows = rows.withColumn("a", (F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    part = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(part, times)), F.lit(1), n - F.col("a"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.find_runs(_tails_repeated(read(spark, folder, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup(read(spark, folder, "documents"), least=1, documents=10)
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


LLM_REGISTRY = {
    "pipeline": corpus_pipeline.run,
    "op1_chat_formatting": op1_chat_formatting,
    "op2_packing": op2_packing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_license_scans": op10_license_scans,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}

_RULES = ", ".join(f"('{kind}', '{host}', '{path}')" for kind, host, path in urls.RULES)

_OP8 = f"""
WITH RECURSIVE rules(kind, rule_host, rule_path) AS (VALUES {_RULES}),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages
  WHERE regexp_matches(html, '(?i)canonical|http-equiv')),
targets AS (
  SELECT url, CASE
    WHEN regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?canonical\\b')
      THEN regexp_extract(tag, '(?i)\\bhref\\s*=\\s*["'']?([^"''>\\s]+)', 1)
    WHEN regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')
      THEN regexp_extract(tag, '(?i)\\burl\\s*=\\s*[''"]?([^"''>\\s]+)', 1) END AS target
  FROM tags),
found AS (
  SELECT url AS from_url, CASE WHEN target LIKE '/%' AND target NOT LIKE '//%'
    THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || target ELSE target END AS to_url
  FROM targets WHERE length(target) > 0),
spelled AS (
  SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM (SELECT url FROM pages UNION SELECT to_url FROM found)),
split AS (
  SELECT url,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail, rest
  FROM spelled),
judged AS (
  SELECT url, host, path, CASE WHEN rest IS NOT NULL THEN host || tail END AS place,
    (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule
  FROM split),
ruled AS (
  SELECT judged.*, kind FROM judged LEFT JOIN rules ON rule = rule_host || rule_path),
edges AS (
  SELECT x.place AS a, y.place AS b FROM found JOIN ruled x ON x.url = from_url JOIN ruled y ON y.url = to_url),
steps AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a, a AS b FROM steps UNION SELECT r.a, s.b FROM reach r JOIN steps s ON r.b = s.a),
bad AS (SELECT DISTINCT r.a AS place FROM reach r JOIN ruled z ON r.b = z.place WHERE z.kind = 'block')
SELECT page_id, host, path, rule,
  coalesce(kind, CASE WHEN place IN (SELECT place FROM bad) THEN 'block' END, 'allow') AS verdict
FROM pages LEFT JOIN ruled ON pages.url IS NOT DISTINCT FROM ruled.url
"""

_OP11 = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units)::BIGINT AS n,
    list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(h, k, 8))::BIGINT) AS u
  FROM tokens),
placed AS (
  SELECT *, least(u[1] % (n + 1), u[2] % (n + 1)) AS a, greatest(u[1] % (n + 1), u[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR u[3] % 100 >= 50
      THEN 'plain' WHEN u[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
    coalesce(array_to_string(units[a + 1:b], ''), '') AS middle, coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM placed)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""

_OP13 = """
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS cut FROM documents),
lines AS (SELECT row, unnest(cut) AS line, generate_subscripts(cut, 1) AS pos FROM rows),
keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM lines),
gone AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10),
kept AS (
  SELECT row, count(*) AS n_lines, count(*) FILTER (key IN (FROM gone)) AS n_dropped,
    string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (FROM gone)) AS text
  FROM keyed GROUP BY row)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM kept JOIN rows USING (row)
"""

LLM_ORACLE = {
    "op8_url_filters": _OP8,
    "op11_fill_in_middle": _OP11,
    "op13_line_dedup": _OP13,
}
