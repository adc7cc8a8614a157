"""Registered plans: filters and audits (F7-F13), similarity join."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from alignfold.functions.text import content_hash_sql, count_hits_sql, hash_unit_sql
from alignfold.operators import filters as FL
from alignfold.operators import similarity as SIM
from alignfold.plans import fixtures as FX
from alignfold.plans.registry import query

KEYWORDS = ("the", "der", "que", "ment", "ung")
SEED = 42


@query("keyword_filter", f"""SELECT doc_id, CAST({count_hits_sql('text', KEYWORDS)} AS INTEGER) AS hits FROM documents
                              WHERE {count_hits_sql('text', KEYWORDS)} >= 3""")
def keyword_filter(spark, sf):
    """documents hitting at least 3 of 5 domain terms (case-sensitive substrings), whole texts."""
    d = FX.table(spark, sf, "documents").select("doc_id", "text")
    return FL.keyword_filter(d, "text", KEYWORDS, 3).select("doc_id", F.col("hits").cast("int").alias("hits"))


# over a thousand terms, by rule: all strings of three of these letters
MANY = ["".join(x) for x in product("aehilnorstu", repeat=3)]


@query("keyword_filter_many", f"""SELECT item_id, hits FROM (
      SELECT item_id, CAST(len(list_filter({MANY}, lambda t: contains(text, t))) AS INTEGER) AS hits FROM benchmark)
    WHERE hits >= 20""")
def keyword_filter_many(spark, sf):
    """F7 with 1,331 terms: the same form as with five."""
    d = FX.table(spark, sf, "benchmark").select("item_id", "text")
    return FL.keyword_filter(d, "text", MANY, 20).select("item_id", F.col("hits").cast("int").alias("hits"))


def _emb(spark, sf):
    e = FX.table(spark, sf, "embeddings")
    anchors = e.filter(F.col("label") == 0).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    cand = e.filter(F.col("label") != 0).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return cand, anchors


SIM_SQL = """sims AS (
  SELECT c.vec_id, list_cosine_similarity(CAST(c.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) AS s
  FROM embeddings c, embeddings a WHERE c.label <> 0 AND a.label = 0)"""


@query("semantic_max", FX.with_ctes("SELECT vec_id, round(max(s), 6) AS max_sim FROM sims GROUP BY vec_id", SIM_SQL))
def semantic_max(spark, sf):
    """F8 (max): highest cosine similarity of each candidate to the anchor set."""
    cand, anchors = _emb(spark, sf)
    return SIM.semantic_scores(cand, anchors).select("vec_id", F.round("max_sim", 6).alias("max_sim"))


@query("semantic_topk_mean", FX.with_ctes(
    "SELECT vec_id, round(list_avg(list_slice(list_sort(list(s), 'DESC'), 1, 5)), 6) AS topk_mean FROM sims GROUP BY vec_id",
    SIM_SQL))
def semantic_topk_mean(spark, sf):
    """F8 (top-5 mean): mean of the five highest similarities per candidate."""
    cand, anchors = _emb(spark, sf)
    return SIM.semantic_scores(cand, anchors, k=5).select("vec_id", F.round("topk_mean", 6).alias("topk_mean"))


@query("semantic_filter", FX.with_ctes(
    "SELECT vec_id FROM sims GROUP BY vec_id HAVING max(s) >= 0.3", SIM_SQL))
def semantic_filter(spark, sf):
    """F8: candidates whose best anchor similarity reaches 0.3."""
    cand, anchors = _emb(spark, sf)
    return SIM.semantic_filter(cand, anchors, 0.3).select("vec_id")


JUDGE_SQL = FX.with_ctes("""SELECT question_id, 1 + quality + (1 - toxic) AS score FROM docs_scored
                            WHERE quality = 1 AND 1 + quality + (1 - toxic) >= 2""", FX.DOCS_SCORED_SQL)


@query("judge_filter", JUDGE_SQL)
def judge_filter(spark, sf):
    """round 1 keeps quality = 1; round 2 scores 1 + quality + (1 - toxic) and keeps >= 2."""
    d = FX.docs_scored(spark, sf)
    r1 = FL.judge_filter(d, "quality", 1)
    r2 = r1.withColumn("score", 1 + F.col("quality") + (1 - F.col("toxic")))
    return FL.judge_filter(r2, "score", 2).select("question_id", "score")


@query("judge_pass_rate", FX.with_ctes(
    """SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN quality >= 1 THEN 1.0 ELSE 0.0 END), 6) AS round1_rate,
              round(avg(CASE WHEN quality >= 1 AND 1 + quality + (1 - toxic) >= 2 THEN 1.0 ELSE 0.0 END), 6) AS round2_rate
       FROM docs_scored""", FX.DOCS_SCORED_SQL))
def judge_pass_rate(spark, sf):
    d = FX.docs_scored(spark, sf).withColumn("score", 1 + F.col("quality") + (1 - F.col("toxic")))
    r2 = F.avg(F.when((F.col("quality") >= 1) & (F.col("score") >= 2), 1.0).otherwise(0.0))
    return d.agg(F.count(F.lit(1)).alias("n"), F.round(FL.judge_pass_rate(d, "quality", 1), 6).alias("round1_rate"),
                 F.round(r2, 6).alias("round2_rate"))


@query("repeated_values", f"""SELECT {content_hash_sql('text')} AS value_hash, CAST(count(*) AS BIGINT) AS n,
                                      CAST(min(length(text)) AS INTEGER) AS value_len
                               FROM documents GROUP BY 1 HAVING count(*) >= 2""")
def repeated_values(spark, sf):
    """document texts repeated two or more times."""
    r = FL.repeated_values(FX.table(spark, sf, "documents"), "text", 2)
    return r.select("value_hash", "n", F.col("value_len").cast("int").alias("value_len"))


@query("drop_repeated", f"""SELECT doc_id FROM documents WHERE {content_hash_sql('text')} NOT IN (
                              SELECT {content_hash_sql('text')} FROM documents GROUP BY 1 HAVING count(*) >= 2)""")
def drop_repeated(spark, sf):
    """every row whose text is one of the repeated values is removed."""
    return FL.drop_repeated(FX.table(spark, sf, "documents"), "text", 2).select("doc_id")


BRACES = r"\{[^{}\s]+\}"


@query("unresolved_placeholders", f"SELECT page_id FROM pages WHERE regexp_matches(html, '{BRACES}')")
def unresolved_placeholders(spark, sf):
    """pages still containing a brace placeholder."""
    return FL.unresolved_placeholders(FX.table(spark, sf, "pages"), "html", BRACES).select("page_id")


@query("length_match", FX.with_ctes(
    """SELECT conv_id, turn, round(CAST(length(response_rejected) AS DOUBLE) / length(response_chosen), 6) AS length_ratio
       FROM pref WHERE abs(CAST(length(response_rejected) AS DOUBLE) / length(response_chosen) - 1.0) <= 0.5""",
    FX.PREF_SQL))
def length_match(spark, sf):
    """pairs whose rejected answer is within 50% of the chosen answer's length."""
    m = FL.length_match(FX.pref(spark, sf), 0.5)
    return m.select("conv_id", "turn", F.round("length_ratio", 6).alias("length_ratio"))


@query("fill_quota", f"""SELECT doc_id, lang FROM (
      SELECT d.doc_id, d.lang, row_number() OVER (PARTITION BY d.lang ORDER BY {hash_unit_sql(SEED, 'd.doc_id')}, d.doc_id) AS rn,
             coalesce(h.have, 0) AS have
      FROM documents d LEFT JOIN (SELECT d2.lang, count(*) AS have FROM documents d2 JOIN labels l USING (doc_id) GROUP BY d2.lang) h
        USING (lang)
      WHERE d.doc_id NOT IN (SELECT doc_id FROM labels))
    WHERE rn <= greatest(200 - have, 0)""")
def fill_quota(spark, sf):
    """top each language up to 200 labelled rows from the unlabelled pool (seeded choice)."""
    d = FX.table(spark, sf, "documents").select("doc_id", "lang")
    lab = FX.table(spark, sf, "labels").select("doc_id")
    base = d.join(lab, "doc_id", "left_semi")
    pool = d.join(lab, "doc_id", "left_anti")
    return FL.fill_quota(base, pool, "lang", 200, SEED, "doc_id").select("doc_id", "lang")
