"""Registered plans: ordering, sampling and splits over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignfold.functions.text import content_hash_sql, hash_unit_sql, seeded_key, seeded_key_sql
from alignfold.operators import splits as S
from alignfold.plans import fixtures as FX
from alignfold.plans.q_prompts import PREFQ_SQL, SFTQ_SQL, pref_questions, sft_questions
from alignfold.plans.registry import query

SEED = 42


def docs(spark, sf):
    return FX.table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")


@query("seeded_shuffle", f"""SELECT doc_id, CAST(row_number() OVER (ORDER BY {seeded_key_sql(SEED, 'doc_id')}, doc_id) - 1 AS BIGINT)
                              AS position FROM documents""")
def seeded_shuffle(spark, sf):
    """Position of every document in the seeded shuffle (global row index, no unpartitioned window)."""
    d = docs(spark, sf).select("doc_id")
    return S.with_row_index(d, [seeded_key(SEED, "doc_id"), F.col("doc_id")], out="position")


@query("head_n", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def head_n(spark, sf):
    """The first 100 rows in a declared order (top-k: the limit is the operator)."""
    return S.take_n(docs(spark, sf).select("doc_id", "n_chars"), 100, [("n_chars", "desc"), "doc_id"])


@query("head_half", "SELECT doc_id, lang, n_chars FROM documents ORDER BY lang DESC, n_chars, doc_id LIMIT (SELECT count(*) // 2 FROM documents)")
def head_half(spark, sf):
    """T7 with half the table: many ties in the first order column, no task holds the rows that are taken."""
    d = docs(spark, sf).select("doc_id", "lang", "n_chars")
    return S.take_n(d, d.count() // 2, [("lang", "desc"), "n_chars", "doc_id"])


@query("sample_n", f"SELECT doc_id FROM documents ORDER BY {seeded_key_sql(SEED, 'doc_id')}, doc_id LIMIT 50")
def sample_n(spark, sf):
    """Shuffled sample of exactly 50 rows (the sample size is the operator)."""
    return S.sample_n(docs(spark, sf).select("doc_id"), 50, SEED, "doc_id")


@query("sample_half", f"""SELECT doc_id FROM documents ORDER BY {seeded_key_sql(SEED, 'doc_id')}, doc_id
    LIMIT (SELECT count(*) // 2 FROM documents)""")
def sample_half(spark, sf):
    """T8 with half the table."""
    d = docs(spark, sf).select("doc_id")
    return S.sample_n(d, d.count() // 2, SEED, "doc_id")


@query("random_split_exact", f"""SELECT doc_id, CASE WHEN rn < ceil(n * 0.1) THEN 'test' ELSE 'train' END AS split FROM (
      SELECT doc_id, row_number() OVER (ORDER BY {seeded_key_sql(SEED, 'doc_id')}, doc_id) - 1 AS rn,
             count(*) OVER () AS n FROM documents)""")
def random_split_exact(spark, sf):
    """T9 exact: test = the ceil(10%) rows with the smallest seeded hash."""
    train, test = S.random_split(docs(spark, sf).select("doc_id"), 0.1, SEED, "doc_id", exact=True)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("random_split_hash", f"""SELECT doc_id, CASE WHEN {hash_unit_sql(SEED, 'doc_id')} < 0.1 THEN 'test' ELSE 'train' END
                                  AS split FROM documents""")
def random_split_hash(spark, sf):
    """T9 scale form: hash bucket < 10% -> test; no sort, no count."""
    train, test = S.random_split(docs(spark, sf).select("doc_id"), 0.1, SEED, "doc_id")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("head_split", """SELECT doc_id, CASE WHEN rn < round(n * 10 / 100.0) THEN 'validation' ELSE 'train' END AS split FROM (
      SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents)""")
def head_split(spark, sf):
    """First 10% (in doc_id order) to validation."""
    train, val = S.head_split(docs(spark, sf).select("doc_id"), 10, ["doc_id"])
    return train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("validation")))


@query("tail_holdout", """SELECT doc_id, CASE WHEN rn >= n - 100 THEN 'eval' ELSE 'train' END AS split FROM (
      SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents)""")
def tail_holdout(spark, sf):
    """Last 100 rows (doc_id order) held out for evaluation."""
    train, ev = S.tail_holdout(docs(spark, sf).select("doc_id"), 100, ["doc_id"])
    return train.withColumn("split", F.lit("train")).unionByName(ev.withColumn("split", F.lit("eval")))


@query("split_overlap", f"""SELECT doc_id FROM documents
      WHERE {hash_unit_sql(SEED, 'doc_id')} >= 0.2
        AND {content_hash_sql('text')} IN (SELECT {content_hash_sql('text')} FROM documents WHERE {hash_unit_sql(SEED, 'doc_id')} < 0.2)""")
def split_overlap(spark, sf):
    """Training rows whose exact text also occurs in the validation split (leakage audit)."""
    train, val = S.random_split(docs(spark, sf), 0.2, SEED, "doc_id")
    return S.overlap_rows(train, val, "text").select("doc_id")


@query("funnel", FX.with_ctes(
    """SELECT * FROM (VALUES (0, 'sft_questions'), (1, 'preference_questions'), (2, 'after_dedup'), (3, 'after_min_length'))
         s(step, stage) JOIN (
       SELECT 0 AS step, CAST(count(*) AS BIGINT) AS n FROM sftq UNION ALL
       SELECT 1, CAST(count(*) AS BIGINT) FROM prefq UNION ALL
       SELECT 2, CAST(count(*) AS BIGINT) FROM (SELECT question FROM sftq UNION SELECT question FROM prefq) UNION ALL
       SELECT 3, CAST(count(*) AS BIGINT) FROM (SELECT question FROM sftq UNION SELECT question FROM prefq) WHERE length(question) >= 8
       ) USING (step)""", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def funnel(spark, sf):
    """M1 + M6: rows per stage of the prompt-set build."""
    f = S.prompt_set_funnel(sft_questions(spark, sf), pref_questions(spark, sf), min_len=8)
    return f.withColumn("step", F.col("step").cast("int"))
