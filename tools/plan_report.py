"""Write PLANS.md: the physical shape of every registered plan (from Spark's own plan, no execution).

Counts come from the initial physical plan at the given scale factor. At sf0.1 Spark
broadcasts small join sides; on large tables the same joins are sort-merge joins, so the
shuffle count below is the one that matters at scale. Plans that checkpoint or write tables
while they are built (row index, long dialogs, round trips, streams) run those parts before the
counted plan: ``checkpoints`` and ``shuffles_before`` count the checkpoints and the shuffles in
their plans. Regenerate with ``python tools/plan_report.py [sf_dir]``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "partial_aggs": r"functions=\[partial_",
    "windows": r"\bWindow \[",
    "generates": r"\bGenerate ",
    "python": r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapCoGroupsInPandas|MapInArrow",
    "pushed_scans": r"PushedFilters: \[[^\]]+\]",
}


HEADLINE = ("prompt_set", "group_advantage", "keyword_filter")


def formatted(df) -> str:
    """``explain('formatted')`` text with the long Unicode-whitespace literals abbreviated."""
    import contextlib
    import io

    from alignfold.functions.text import PY_WHITESPACE

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue().replace(PY_WHITESPACE, "<unicode-whitespace>")
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def shape(plan: str) -> dict:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from alignfold.session import get_spark
    from alignfold.plans.registry import QUERIES, load_all

    spark = get_spark()
    load_all()
    kind = type(spark.range(0))
    plain, before = kind.checkpoint, []

    def seen(self, eager=True):
        plan = self._jdf.queryExecution().executedPlan().toString()
        before.append(len(re.findall(PATTERNS["shuffles"], plan)))
        return plain(self, eager)

    kind.checkpoint = seen
    rows = []
    for name in sorted(QUERIES):
        before.clear()
        df = QUERIES[name](spark, sf)
        p = df._jdf.queryExecution().executedPlan().toString()
        p = re.sub(r"AdaptiveSparkPlan.*\n", "", p)
        rows.append((name, shape(p) | {"checkpoints": len(before), "shuffles_before": sum(before)}))
    kind.checkpoint = plain
    keys = [*PATTERNS, "checkpoints", "shuffles_before"]
    out = ["# PLANS", "", __doc__.strip(), "",
           "| plan | " + " | ".join(keys) + " |", "| --- | " + " | ".join("---" for _ in keys) + " |"]
    for name, s in rows:
        out.append(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |")
    for name in HEADLINE:
        out += ["", f"## {name}", "", "```", formatted(QUERIES[name](spark, sf)), "```"]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
