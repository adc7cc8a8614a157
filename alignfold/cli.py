"""Command line entry points for the data steps: ``python -m alignfold.cli <command> ...``.

  prompts   SFT + preference JSONL -> deduplicated, length-filtered, sorted prompt set
  rm-data   preference JSONL -> reward-model pairs (system, history, question, chosen, rejected)
  score     inference results JSONL -> rule-based reward columns
  metrics   flat metric JSON files -> one row per run, one column per metric
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from pyspark.sql import functions as F

from alignfold.functions.lexicon import load_lexicon
from alignfold.functions.schemas import PREFERENCE, SFT
from alignfold.operators import metrics as M
from alignfold.operators import prompts as P
from alignfold.operators import rewards as R
from alignfold.operators import splits as S
from alignfold.operators import turns as TU
from alignfold.session import checkpoint_dir, get_spark
from alignfold.sources import io


def _prompts(spark, a) -> dict:
    sft, _ = io.quarantine(io.read_jsonl(spark, a.sft, SFT))
    pref, _ = io.quarantine(io.read_jsonl(spark, a.dpo, PREFERENCE))
    # both question sets feed the output, the funnel and the overlap report: read the inputs once
    work = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex}"
    sq = io.ensure_stage(spark, f"{work}/sft", lambda: TU.first_user_turn(sft).select("question"))
    pq = io.ensure_stage(spark, f"{work}/preference", lambda: TU.extract_questions(pref))
    ps = S.build_prompt_set(sq, pq, min_len=a.min_length, sort=False)
    if a.format == "conversation":  # sorted by question, written as [{from: human, value}]
        io.write_jsonl(P.to_conversation_prompts(ps.orderBy("question")).select("conversations"), a.out,
                       single_file=a.single_file)
    else:
        io.write_jsonl(ps, a.out, order_by=["question"], single_file=a.single_file)
    funnel = {r.stage: r.n for r in S.prompt_set_funnel(sq, pq, a.min_length).collect()}
    overlap = S.source_overlap(sq, pq).first().asDict()
    return {"funnel": funnel, "overlap": {"only_sft": overlap["only_a"], "only_preference": overlap["only_b"],
                                          "both": overlap["both"]}}


def _rm_data(spark, a) -> dict:
    pref, bad = io.quarantine(io.read_jsonl(spark, a.dpo, PREFERENCE))
    pairs = P.to_reward_pairs(pref)
    io.write_jsonl(pairs, a.out, single_file=a.single_file)
    return {"quarantined_lines": bad.count()}


def _score(spark, a) -> dict:
    good, bad = io.quarantine(io.read_results(spark, a.results))
    res = good.withColumnRenamed("Output", "content")
    scored = R.score(res, load_lexicon(a.lexicon))
    io.write_jsonl(scored.select("q_id", "q_text", "entity", "structure", "safety", "length", "combined"), a.out,
                   single_file=a.single_file)
    means = scored.agg(*[F.avg(c).alias(c) for c in ("entity", "structure", "safety", "length", "combined")]).first()
    return {"means": means.asDict(), "quarantined_lines": bad.count()}


def _metrics(spark, a) -> dict:
    found = io.read_metrics(spark, a.glob)
    wide = M.list_metrics(found.filter(F.col("value").isNotNull()))
    unread = found.filter(F.col("raw").isNotNull()).select("run", "metric").collect()
    return {"runs": [r.asDict() for r in wide.orderBy("run").collect()],  # one small row per run
            "unread": [r.asDict() for r in unread]}


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="alignfold")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prompts")
    p.add_argument("--sft", required=True)
    p.add_argument("--dpo", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--min-length", type=int, default=8)
    p.add_argument("--format", choices=["grpo", "conversation"], default="grpo")
    r = sub.add_parser("rm-data")
    r.add_argument("--dpo", required=True)
    r.add_argument("--out", required=True)
    s = sub.add_parser("score")
    s.add_argument("--results", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--lexicon", default="clinical")
    m = sub.add_parser("metrics")
    m.add_argument("--glob", required=True)
    for x in (p, r, s):
        x.add_argument("--single-file", action="store_true", help="one output file (small outputs only)")
    a = ap.parse_args(argv)
    spark = get_spark()
    run = {"prompts": _prompts, "rm-data": _rm_data, "score": _score, "metrics": _metrics}[a.cmd]
    report = run(spark, a)
    print(json.dumps(report, ensure_ascii=False, default=str))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])
