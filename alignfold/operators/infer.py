"""Batched generation over a prompt table (U3) and batched row-dropping maps.

The model itself is not part of this library: ``generate_fn`` is any callable
``(prompts: list[str], system_prompt: str) -> list[str]``. It runs inside
``mapInPandas``, once per Arrow batch, in chunks of ``batch`` prompts; the model
is loaded once per task by the callable's own closure. Output is keyed by the
prompt id, never by position.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.operators.prompts import clean_response


def batch_infer(df: DataFrame, generate_fn: Callable, key: str = "id", prompt: str = "question", batch: int = 4,
                system_prompt: str = "", stop: str | None = "</s>") -> DataFrame:
    """Generate one output per prompt; outputs are cut at ``stop`` and stripped."""
    import pandas as pd

    from alignfold.session import ship_package

    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            outs = []
            texts = pdf[prompt].fillna("").tolist()
            for i in range(0, len(texts), batch):
                outs.extend(generate_fn(texts[i:i + batch], system_prompt))
            yield pd.DataFrame({key: pdf[key].to_numpy(), "Input": texts, "raw_output": outs})

    key_type = df.schema[key].dataType.simpleString()
    out = df.select(key, prompt).mapInPandas(run, f"{key} {key_type}, Input string, raw_output string")
    cleaned = clean_response("raw_output", stop) if stop else F.col("raw_output")
    return out.withColumn("Output", cleaned).drop("raw_output")


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """User batch function ``fn(pd.DataFrame) -> pd.DataFrame`` that may drop rows."""
    from alignfold.session import ship_package

    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            out = fn(pdf)
            if out is not None and len(out):
                yield out
    return df.mapInPandas(run, schema)
