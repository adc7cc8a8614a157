"""Registered plans: user hooks (U2, U4, U5) with callables that run over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignfold.operators import infer as INF
from alignfold.operators import rewards as R
from alignfold.operators import tokens as K
from alignfold.plans import fixtures as FX
from alignfold.plans.registry import query


@query("model_reward", FX.with_ctes(
    """SELECT prompt_id, gen_id, (length(content) - length(replace(content, 'e', ''))) / 100.0::DOUBLE AS model_reward
       FROM completions""", FX.COMPLETIONS_SQL))
def model_reward(spark, sf):
    """A batch scorer as the reward (here: the letter e per hundred)."""
    c = FX.completions(spark, sf).withColumn("prompt", F.col("prompt_id").cast("string"))
    out = R.score_with(c, lambda prompts, contents: contents.str.count("e") / 100.0)
    return out.select("prompt_id", "gen_id", "model_reward")


@query("tokenizer_hook", """SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_tokens,
    CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS id_sum
    FROM (SELECT doc_id, regexp_extract_all(text, '[^ \\n]+') AS ws FROM documents)""")
def tokenizer_hook(spark, sf):
    """U4: a user tokenizer (here: the length of each word) as a column function."""
    tok = K.pandas_tokenizer(lambda texts: [[len(w) for line in t.split("\n") for w in line.split(" ") if w] for t in texts])
    d = FX.table(spark, sf, "documents").select("doc_id", tok(F.col("text")).alias("ids"))
    return d.select("doc_id", F.size("ids").cast("int").alias("n_tokens"),
                    F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("batch_map", "SELECT doc_id, n_chars * 2 AS doubled FROM documents WHERE n_chars % 2 = 0")
def batch_map(spark, sf):
    """A user batch function that drops rows."""
    d = FX.table(spark, sf, "documents").select("doc_id", "n_chars")
    return INF.map_batches(d, lambda pdf: pdf[pdf["n_chars"] % 2 == 0].assign(doubled=lambda x: x["n_chars"] * 2)
                           [["doc_id", "doubled"]], "doc_id long, doubled long")
