"""Registered queries of the corpus operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alignfold.llm import (bpe, corpus_sql, gru_lm, host_rules, licenses, mixing, periods, sharding, simhash, token_files,
                           toxicity, vector_codes, warc, winnow)
from alignfold.llm.common import WORD, documents, id_crc, text_or_empty

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty().cast("binary")
    docs = documents(spark, sf_dir).select("doc_id", "source", (F.length(text) + 1).cast("long").alias("size"),
                                           F.crc32(text).alias("text_crc32"))
    shards = sharding.interleave_shards(docs, 8, carry=("size", "text_crc32"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "source")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(documents(spark, sf_dir), RANKS, PATTERN, decoded=True)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(numbers.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = id_crc() % 4 == 2
    model = toxicity.fit(docs, labels, ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                              (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.regexp_count(text_or_empty(), F.lit(WORD))
    mixed, _ = mixing.mix_rows(documents(spark, sf_dir), size, F.array("source"), mixing.repeating([3, 1, 2]), share=1.5, passes=2)
    return mixed.select("doc_id", "size", F.col("sizes")[0].alias("source_size"), F.col("targets")[0].alias("target"),
                        (F.col("size") * F.size("given")).alias("taken"),
                        F.expr("CASE WHEN pattern[0] <> 'z' THEN substring(pattern[0], 2) END").alias("source"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    names = F.array_join(F.array_distinct(F.col("matches.license")), ",")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), names.alias("licenses"),
                        F.array_max("matches.coverage").alias("best_coverage"), "matches")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.neighbours(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        winnow.as_text("hashes").alias("fingerprint"),
                        winnow.as_text("edited_hashes").alias("edited_fingerprint"),
                        winnow.likeness("hashes", "edited_hashes").alias("near_edited"),
                        winnow.likeness("hashes", "next_hashes").alias("near_next"))


def op8_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(documents(spark, sf_dir), id_crc() % 7 != 2)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    manifest = token_files.write_files(docs, token_files.new_folder(docs), VOCABULARY, PATTERN, end_id=2)
    return token_files.read_files(manifest)


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = host_rules.judge(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "n_lines", "host_bad")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = warc.new_folder(pages)
    warc.write_archive(pages, folder, min_bytes=0)
    found = warc.resolved(spark, folder)
    return found.select(F.col("document_id").cast("long").alias("page_id"), "payload_bytes",
                        F.col("payload_sha1").alias("payload_digest"), "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, codebooks = vector_codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=("label",))
    return vector_codes.with_label_errors(found).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(codebooks)).alias("codebooks_sha256"), "label")


def planted_copies(doc_ids: pa.Array, first: np.ndarray) -> np.ndarray:
    """For one in ten documents, by the crc32 of the id: from word a on, p words over and over."""
    source = np.arange(int(first[-1]))
    for doc_id, begin, n in zip(doc_ids.to_pylist(), first[:-1].tolist(), np.diff(first).tolist()):
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[begin + a:begin + n] = begin + a + np.arange(n - a) % p
    return source


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(documents(spark, sf_dir), edit=planted_copies)
    # runs come by start and period, so the first of the greatest exponents is the one asked for
    best = F.expr("aggregate(runs, cast(null as struct<start: long, length: long, period: long>), (b, r) -> "
                  "if(b is null or r.length * b.period > b.length * r.period, r, b))")
    text = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    text = F.when(F.size("runs") > 0, F.concat(text, F.lit("\n"))).otherwise("")
    found = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                         F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "b.start", "b.length", "b.period",
                        F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
                        "n_words")


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_simhash, op3_byte_bpe, op4_toxicity, op5_mixing, op6_licenses, op7_fingerprints, op8_gru_lm,
    op9_token_files, op10_host_rules, op11_warc, op12_vector_codes, op13_periodic_runs)}


def _op10_sql() -> str:
    """Counts, moments of the hosts' rates and verdicts of op10 in DuckDB."""
    n, f = "cast(n AS DOUBLE)", {r: f"cast({r} AS DOUBLE)" for r in host_rules.RULES}
    fails = ", ".join(f"({rule}) AS {name}" for name, rule in host_rules.RULES.items())
    sums = ", ".join(f"sum(cast({r} AS BIGINT)) AS {r}" for r in host_rules.RULES)
    moments = ", ".join(f"sum({f[r]}) / sum({n}) AS {r}_mean, var_pop({f[r]} / {n}) - sum({f[r]}) / sum({n}) "
                        f"* (1 - sum({f[r]}) / sum({n})) * sum(1 / {n}) / count(*) AS {r}_between" for r in host_rules.RULES)
    weight = {r: f"(CASE WHEN {r}_between > 0 THEN least(greatest({r}_mean * (1 - {r}_mean) / {r}_between - 1, 1.0), 1e6) "
                 "ELSE 1e6 END)" for r in host_rules.RULES}
    bad = " OR ".join(f"({f[r]} + {r}_mean * {weight[r]}) / ({n} + {weight[r]}) > {host_rules.HOST_LIMIT}" for r in host_rules.RULES)
    word = "[^ \\t\\n\\x0B\\f\\r]+"
    return f"""WITH base AS (
      SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '{word}') AS ws FROM documents),
    lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM base),
    places AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM base),
    windows AS (SELECT rid, p, lead(w, 2) OVER v AS w3, hash(w) AS h, w || ' ' || lead(w, 1) OVER v || ' ' || lead(w, 2) OVER v AS t
      FROM places WINDOW v AS (PARTITION BY rid ORDER BY p)),
    marked AS (SELECT rid, p, w3 IS NOT NULL AND count(*) OVER (PARTITION BY rid, t) > 1 AS rep FROM windows),
    covered AS (SELECT rid, count(*) FILTER (WHERE hit) AS n_repeat_words FROM (
      SELECT rid, rep OR coalesce(lag(rep, 1) OVER v, false) OR coalesce(lag(rep, 2) OVER v, false) AS hit
      FROM marked WINDOW v AS (PARTITION BY rid ORDER BY p)) GROUP BY rid),
    counted AS (
      SELECT b.rid, doc_id, source, cast(len(ws) AS BIGINT) AS n_words,
             cast(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
             cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             cast(len(ls) AS BIGINT) AS n_lines, cast(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             cast(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM base b JOIN lines l ON l.rid = b.rid LEFT JOIN covered c ON c.rid = b.rid),
    failed AS (SELECT *, {fails} FROM counted),
    hosts AS (SELECT source, count(*) AS n, {sums} FROM failed WHERE source IS NOT NULL GROUP BY source),
    moments AS (SELECT {moments} FROM hosts),
    verdicts AS (SELECT source, {bad} AS host_bad FROM hosts, moments)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base AS base_failed,
           NOT base AND NOT coalesce(host_bad, false) AS kept, n_lines, coalesce(host_bad, false) AS host_bad
    FROM failed f LEFT JOIN verdicts v ON v.source = f.source"""


ORACLE: dict[str, str] = {"op10_host_rules": _op10_sql(), **corpus_sql.ORACLE}
