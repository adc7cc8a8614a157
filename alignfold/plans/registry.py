"""Registry of named plans: each has a Spark builder (spark, sf_dir) -> DataFrame and, where
the operator is SQL-expressible, an equivalent DuckDB query over the same parquet tables."""

from __future__ import annotations

from typing import Callable

QUERIES: dict = {}
ORACLE: dict = {}


def _positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB rounds a tiny negative to -0.0,
    Spark to 0.0; adding 0.0 turns -0.0 into 0.0 and leaves every other value unchanged."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "(" + sql[j:k + 1] + " + 0.0)")
        i = k + 1


def query(name: str, sql: str | None = None) -> Callable:
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _positive_zero_rounds(sql)
        return fn
    return deco


def load_all() -> None:
    # import for side effects: each module registers its plans
    from alignfold.plans import (q_prompts, q_rewards, q_splits, q_tokens, q_filters, q_metrics, q_io, q_hooks, q_values)  # noqa: F401
