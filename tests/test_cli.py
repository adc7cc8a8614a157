"""CLI entry points run in-process on small JSONL inputs."""

import json
import os

from alignfold import cli


def _w(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")


def _read_json_dir(d):
    out = []
    for f in sorted(os.listdir(d)):
        if f.endswith(".json"):
            out += [json.loads(x) for x in open(os.path.join(d, f), encoding="utf-8") if x.strip()]
    return out


def test_prompts_rm_data_score_metrics(spark, tmp_path):
    t = str(tmp_path)
    _w(f"{t}/sft.jsonl", [{"conversations": [{"from": "human", "value": "How to sleep better?"}, {"from": "gpt", "value": "a"}]},
                          {"conversations": [{"role": "user", "content": "short"}]}])
    _w(f"{t}/dpo.jsonl", [{"question": "How to sleep better?", "response_chosen": "c", "response_rejected": "r"},
                          {"question": "Is tai chi useful here?", "response_chosen": "c", "response_rejected": ""},
                          "{broken"])
    rep = cli.main(["prompts", "--sft", f"{t}/sft.jsonl", "--dpo", f"{t}/dpo.jsonl", "--out", f"{t}/p", "--single-file"])
    assert [r["question"] for r in _read_json_dir(f"{t}/p")] == ["How to sleep better?", "Is tai chi useful here?"]
    assert rep["funnel"]["after_min_length"] == 2 and rep["overlap"]["both"] == 1
    cli.main(["prompts", "--sft", f"{t}/sft.jsonl", "--dpo", f"{t}/dpo.jsonl", "--out", f"{t}/pc", "--format",
              "conversation", "--single-file"])
    assert [r["conversations"][0]["value"] for r in _read_json_dir(f"{t}/pc")] == [
        "How to sleep better?", "Is tai chi useful here?"]
    rep = cli.main(["rm-data", "--dpo", f"{t}/dpo.jsonl", "--out", f"{t}/rm"])
    assert len(_read_json_dir(f"{t}/rm")) == 1 and rep["quarantined_lines"] == 1
    _w(f"{t}/res.jsonl", [{"Input": json.dumps({"id": 1, "question": "q"}), "Output": "建议就诊，咨询医生，定期复查。"}])
    rep = cli.main(["score", "--results", f"{t}/res.jsonl", "--out", f"{t}/s"])
    assert rep["means"]["safety"] == 1.0
    _w(f"{t}/runs/r1/all_results.json", [json.dumps({"train_loss": 0.5})])
    rep = cli.main(["metrics", "--glob", f"{t}/runs/*/*.json"])
    assert rep["runs"] == [{"run": "r1", "train_loss": 0.5}]
