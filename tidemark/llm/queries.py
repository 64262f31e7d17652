"""The registered queries of this subpackage, over whole tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    decontamination,
    fill_in_middle,
    nearest,
    packing,
    periodic_runs,
    pii,
    piece_encoding,
    secrets,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
    warc,
    warc_sql,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_warc_derivatives", warc_sql.SQL)
def op1(spark, sf_dir):
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")), "page_id")


@query("op2_benchmark_leaks")
def op2(spark, sf_dir):
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op3_substring_dedup",
    r"""
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM w)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, rank() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE
         [ws[p] FOR p IN range(1, len(ws) + 1) IF NOT list_contains(ps, p)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
""",
)
def op3(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), k=20)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op4_simhash")
def op4(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=4, shingle_words=4)


@query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_hash_prefix_forest")
def op6(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return nearest.nearest(rows, rows.where("vec_id % 50 = 0"), k=5)


@query("op7_vector_best_fit")
def op7(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), packing.Capacity(tokens=2048))


@query("op8_crf_pii")
def op8(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query("op9_length_histogram")
def op9(spark, sf_dir):
    return token_counts.suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


@query("op10_secret_scans")
def op10(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def planted(text: Column, doc_id: Column) -> Column:
    """Texts of one id in ten, by CRC-32, with a run planted from word a on: period p to the end of the text."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.nullif(F.size(words), F.lit(0))
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")).otherwise(text)


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_sentencepiece")
def op12(spark, sf_dir):
    found = piece_encoding.encode(table(spark, sf_dir, "documents"), with_decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op13_fill_in_middle",
    r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS ws,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(ws) AS n, least(h1 % (len(ws) + 1), h2 % (len(ws) + 1)) AS a,
         greatest(h1 % (len(ws) + 1), h2 % (len(ws) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(ws[1:a], '') AS pre, array_to_string(ws[a + 1:b], '') AS mid, array_to_string(ws[b + 1:], '') AS suf
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
""",
)
def op13(spark, sf_dir):
    found = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
