"""Declared schemas of every record type; nothing is inferred from files."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
D = T.DoubleType()

TURN = T.StructType([T.StructField(n, S) for n in ("from", "value", "role", "content")])
SFT = T.StructType([T.StructField("conversations", T.ArrayType(TURN)), T.StructField("system_prompt", S)])
PREFERENCE = T.StructType([T.StructField(n, S) for n in ("question", "response_chosen", "response_rejected")])
REWARD_PAIR = T.StructType([
    T.StructField("system", S),
    T.StructField("history", T.ArrayType(T.ArrayType(S))),
    T.StructField("question", S),
    T.StructField("response_chosen", S),
    T.StructField("response_rejected", S),
])
PAIR = T.StructType([T.StructField("query", S), T.StructField("answer", S)])
HISTORY = T.ArrayType(PAIR)
PROMPT = T.StructType([T.StructField("question", S), T.StructField("answer", S)])
MESSAGE = T.StructType([T.StructField("role", S), T.StructField("content", S)])
MESSAGE_PROMPT = T.StructType([T.StructField("prompt", T.ArrayType(MESSAGE)), T.StructField("answer", S)])
CONV_PROMPT = T.StructType([T.StructField("conversations", T.ArrayType(
    T.StructType([T.StructField("from", S), T.StructField("value", S)])))])
PREF_TEXT = T.StructType([T.StructField(n, S) for n in ("prompt", "chosen", "rejected")])
TOKENISED = T.StructType([T.StructField(n, T.ArrayType(I)) for n in ("input_ids", "attention_mask", "labels")])
TOKENISED_PAIR = T.StructType([T.StructField(n, T.ArrayType(I)) for n in (
    "input_ids_chosen", "attention_mask_chosen", "input_ids_rejected", "attention_mask_rejected")])
COMPLETION = T.StructType([T.StructField("prompt_id", L), T.StructField("gen_id", I), T.StructField("content", S)])
EVAL_QUESTION = T.StructType([
    T.StructField("id", L), T.StructField("source", S), T.StructField("scene", S),
    T.StructField("perspective", S), T.StructField("question", S),
])
EVAL_RESULT = T.StructType([T.StructField("Input", S), T.StructField("Output", S)])
METRIC_MAP = T.MapType(S, D)
METRIC_LONG = T.StructType([
    T.StructField("run", S), T.StructField("step", L), T.StructField("ts", T.TimestampType()),
    T.StructField("metric", S), T.StructField("value", D),
])
SCORE_SHEET = T.StructType([
    T.StructField("model", S), T.StructField("question_id", L), T.StructField("accuracy", I),
    T.StructField("structure", I), T.StructField("cot", I),
])
LEXICON = T.StructType([T.StructField("category", S), T.StructField("term", S)])
