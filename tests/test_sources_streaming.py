"""Sources / sinks (S1-S12) round trips and stream = batch checks."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.lexicon import load_lexicon
from alignfold.functions.schemas import PREFERENCE, SFT
from alignfold.operators import filters as FL
from alignfold.operators import metrics as M
from alignfold.operators import rewards as R
from alignfold.sources import io
from alignfold.streaming import streams as X


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_jsonl_quarantine_and_dir_reader(spark, tmp_path):
    p = str(tmp_path / "train" / "sub" / "a.jsonl")
    _write(p, [json.dumps({"question": "q1", "response_chosen": "c", "response_rejected": "r"}, ensure_ascii=False),
               "", "{not json", json.dumps({"question": "帕金森 q2"}, ensure_ascii=False)])
    _write(str(tmp_path / "train" / "ignored.txt"), ["{\"question\": \"x\"}"])
    df = io.read_jsonl(spark, p, PREFERENCE)
    good, bad = io.quarantine(df)
    assert sorted(r.question for r in good.collect()) == ["q1", "帕金森 q2"]
    assert bad.count() == 1
    splits = io.read_json_dir(spark, str(tmp_path / "train"), PREFERENCE)
    assert splits["train"].filter(F.col("question").isNotNull()).count() == 2
    try:
        io.read_json_dir(spark, str(tmp_path / "missing"), PREFERENCE)
        raise AssertionError("missing directory must raise")
    except FileNotFoundError:
        pass


def test_sft_records_and_writer_roundtrip(spark, tmp_path):
    rec = {"conversations": [{"from": "human", "value": "问题"}, {"role": "assistant", "content": "答"}]}
    p = str(tmp_path / "sft.jsonl")
    _write(p, [json.dumps(rec, ensure_ascii=False)])
    df, _ = io.quarantine(io.read_jsonl(spark, p, SFT))
    assert df.first().conversations[1]["content"] == "答"
    out = str(tmp_path / "out")
    io.write_jsonl(df.select(F.lit("q").alias("question"), F.lit("").alias("answer")), out, order_by=["question"],
                   single_file=True)
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in os.listdir(out) if f.endswith(".json"))
    assert json.loads(text.strip()) == {"question": "q", "answer": ""}


def test_lines_metrics_csv_results(spark, tmp_path):
    _write(str(tmp_path / "q.txt"), ["  a  ", "", "b"])
    lines = [r.line for r in io.read_lines(spark, str(tmp_path / "q.txt")).orderBy("line_key").collect()]
    assert lines == ["a", "", "b"]
    _write(str(tmp_path / "runs" / "r1" / "all_results.json"), [json.dumps({"train_loss": 1.5, "epoch": 2.0})])
    _write(str(tmp_path / "runs" / "r2" / "all_results.json"), [json.dumps({"eval_loss": 0.25}, indent=4)])
    m = io.read_metrics(spark, str(tmp_path / "runs" / "*" / "*.json"))
    assert {(r.run, r.metric, r.value) for r in m.collect()} == {("r1", "train_loss", 1.5), ("r1", "epoch", 2.0),
                                                                 ("r2", "eval_loss", 0.25)}
    m = m.filter(F.col("run") == "r1")
    io.write_metrics(m.withColumn("phase", F.lit("train")), str(tmp_path / "mout"))
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(tmp_path / "mout") for f in fs if f.startswith("part-")]
    assert [json.loads(open(f).read()) for f in files] == [{"train_loss": 1.5, "epoch": 2.0}]  # flat object
    back = io.read_metrics(spark, str(tmp_path / "mout" / "*" / "*" / "part-*"))
    assert {(r.run, r.metric, r.value) for r in back.collect()} == {("r1", "train_loss", 1.5), ("r1", "epoch", 2.0)}
    wide = M.list_metrics(m.select("run", "metric", "value"))
    assert wide.first().train_loss == 1.5
    with open(tmp_path / "b.csv", "wb") as f:
        f.write("﻿name,score\nx,1\n".encode("utf-8"))
    c = io.read_csv_bom(spark, str(tmp_path / "b.csv"))
    assert c.columns == ["name", "score"]
    _write(str(tmp_path / "res.jsonl"), [json.dumps({"Input": json.dumps({"id": 3, "question": "q"}), "Output": "o"}),
                                         json.dumps({"Input": "plain text", "Output": "p"})])
    good, bad = io.quarantine(io.read_results(spark, str(tmp_path / "res.jsonl")))
    assert {x.q_text: x.q_id for x in good.collect()} == {"q": 3, "plain text": None} and bad.count() == 0


def test_ensure_stage(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    p = str(tmp_path / "stage")
    assert io.ensure_stage(spark, p, build).count() == 3
    assert io.ensure_stage(spark, p, build).count() == 3
    assert len(calls) == 1


def test_stream_keyword_filter_equals_batch(spark, tmp_path):
    src = tmp_path / "corpus"
    for i in range(3):
        _write(str(src / f"part{i}.jsonl"), [json.dumps({"doc_id": i * 10 + j, "text": t})
                                            for j, t in enumerate(["the cat and", "der Hund", "nothing", "que the"])])
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    terms = ["the", "que", "der"]
    s = X.stream_keyword_filter(spark, str(src), schema, "text", terms, 1, max_files_per_trigger=1)
    out = X.run_available_now(s.select("doc_id", "hits"), str(tmp_path / "sink"))
    got = {(r.doc_id, r.hits) for r in spark.read.parquet(out).collect()}
    batch = FL.keyword_filter(spark.read.schema(schema).json(str(src)), "text", terms, 1)
    assert got == {(r.doc_id, r.hits) for r in batch.collect()}


def test_stream_score_and_dedup(spark, tmp_path):
    lex = load_lexicon("clinical")
    src = tmp_path / "comp"
    rows = [{"prompt_id": 1, "gen_id": i, "content": c, "ts": "2024-01-01T00:00:0%dZ" % i}
            for i, c in enumerate(["建议就诊，咨询医生", "可以停药", "建议就诊，咨询医生"])]
    _write(str(src / "a.jsonl"), [json.dumps(r, ensure_ascii=False) for r in rows])
    schema = "prompt_id long, gen_id int, content string, ts timestamp"
    s = X.stream_score(spark.readStream.schema(schema).json(str(src)), lex)
    out = X.run_available_now(s.select("gen_id", "combined"), str(tmp_path / "scored"))
    got = {r.gen_id: r.combined for r in spark.read.parquet(out).collect()}
    exp = {r.gen_id: r.combined for r in R.score(spark.read.schema(schema).json(str(src)), lex).collect()}
    assert got == exp
    d = X.stream_prompt_set(spark.readStream.schema(schema).json(str(src)).withColumnRenamed("content", "question"),
                            "1 hour", min_len=1)
    out = X.run_available_now(d.select("question"), str(tmp_path / "dedup"))
    assert spark.read.parquet(out).count() == 2


def test_stream_metric_windows_equal_batch(spark, sf_dir, tmp_path):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").cast("string").alias("run"), "ts", F.col("event_type").alias("metric"), "value")
    src = str(tmp_path / "ev")
    ev.write.parquet(src)
    s = spark.readStream.schema(ev.schema).parquet(src)
    w = X.stream_metrics(s, "2 hours", "1 hour", "1 hour")
    out = X.run_available_now(w, str(tmp_path / "win"))
    got = spark.read.parquet(out)
    # append mode only emits windows closed by the watermark; the batch twin holds every window
    batch = M.metric_windows(ev, "2 hours", "1 hour")
    assert 0 < got.count() <= batch.count()
    joined = got.alias("s").join(batch.alias("b"), ["run", "metric", "window_start"])
    assert joined.filter((F.col("s.n") != F.col("b.n")) | (F.abs(F.col("s.mean") - F.col("b.mean")) > 1e-9)).count() == 0
    assert joined.count() == got.count()


def test_stream_kl_alerts(spark, tmp_path):
    rows = [("r1", "2024-01-01T00:%02d:00Z" % m, "kl", v) for m, v in [(0, 2.0), (10, 2.0), (50, 0.05)]]
    rows += [("r1", "2024-01-01T05:00:00Z", "kl", 0.7)]  # advances the watermark past the first windows
    src = tmp_path / "m"
    _write(str(src / "a.jsonl"), [json.dumps({"run": r, "ts": t, "metric": m, "value": v}) for r, t, m, v in rows])
    s = spark.readStream.schema("run string, ts timestamp, metric string, value double").json(str(src))
    X.stream_kl_alerts(X.stream_metrics(s, "1 hour", None, "10 minutes"), str(tmp_path / "alerts"), "kl")
    got = {r.kl_flag for r in spark.read.parquet(str(tmp_path / "alerts")).collect()}
    assert got == {"explosion"}  # the 00:00 window mean (2.0 + 2.0 + 0.05) / 3 > 1.0; 05:00 is still open


def test_failfast_mode_aborts_on_bad_line(spark, tmp_path):
    import pytest

    p = str(tmp_path / "bad.jsonl")
    _write(p, [json.dumps({"question": "ok"}), "{not json"])
    with pytest.raises(Exception):
        io.read_jsonl(spark, p, PREFERENCE, mode="FAILFAST").collect()


def test_quarantine_loses_no_line_and_passes_no_broken_one(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    good = ['{"a": "x", "n": 1}', '  {"n": 2}', '{"a": null}', '{}', '{"a": "extra", "z": [1, {"y": 2}]}']
    bad = ['{"a": "cut", "n": 3', '{"a": "cu', '{"a": "wrong", "n": "three"}', '{"a": "x", "n": 4} tail', '{"a": "x"},{"a": "y"}',
           '{not json', 'null', '[1]', '7', '"text"']
    p = str(tmp_path / "lines.jsonl")
    _write(p, [x for pair in zip(good + bad, ["", "   ", "\t"] * 5) for x in pair])
    for df in (io.read_jsonl(spark, p, schema), io.read_json_dir(spark, str(tmp_path), schema)["train"]):
        ok, broken = io.quarantine(df)
        assert sorted(r[0] for r in broken.collect()) == sorted(bad)
        assert sorted((r.a or "", r.n or 0) for r in ok.collect()) == [("", 0), ("", 0), ("", 2), ("extra", 0), ("x", 1)]
        assert ok.select("n").count() == len(good)  # pruned columns do not change the split


def test_metric_files_with_values_that_are_no_numbers(spark, tmp_path):
    _write(str(tmp_path / "r1" / "all.json"), ['{"train_loss": 1.5, "note": "abc", "epoch": 2.0, "nested": {"x": 1}}'])
    _write(str(tmp_path / "r2" / "all.json"), ["no json at all"])
    got = {(r.run, r.metric): (r.value, r.raw) for r in io.read_metrics(spark, str(tmp_path / "*" / "*.json")).collect()}
    assert got[("r1", "train_loss")] == (1.5, None) and got[("r1", "epoch")] == (2.0, None)
    assert got[("r1", "note")] == (None, "abc") and got[("r1", "nested")][0] is None
    assert got[("r2", None)][1].strip() == "no json at all"
    twice = spark.createDataFrame([("r", "train", "m", 1.0), ("r", "train", "m", 3.0)], "run string, phase string, metric string, value double")
    io.write_metrics(twice, str(tmp_path / "out"))
    assert [r.value for r in io.read_metrics(spark, str(tmp_path / "out" / "*" / "*" / "part-*")).collect()] == [3.0]


def test_line_keys_do_not_depend_on_the_file_split(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        _write(str(tmp_path / name), [f"{name} {i}" for i in range(50)])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        seen = []
        for size in ("64", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            seen.append(sorted((r.file, r.line_key, r.line) for r in io.read_lines(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert seen[0] == seen[1] and [k for _, k, _ in seen[0]] == list(range(50)) * 2


def test_line_keys_of_a_file_in_many_splits(spark, tmp_path):
    import random
    rng = random.Random(6)
    ends = ["\n", "\r\n", "\r\n", "\r"]
    lines = [rng.choice(["", " ", "é" * rng.randint(1, 9), "x" * rng.randint(0, 40), "a\tb"]) for _ in range(300)]
    text = "".join(x + rng.choice(ends) for x in lines[:-1]) + "last"
    (tmp_path / "many.txt").write_bytes(text.encode())
    (tmp_path / "none.txt").write_bytes(b"")
    (tmp_path / "one.txt").write_bytes(b"only")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = [x.strip() for x in text.replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    try:
        for size in (17, 64, 101, 333, 1000, 1 << 20):  # line ends lie at the cuts
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            got = io.read_lines(spark, str(tmp_path)).collect()
            assert [r.line for r in sorted((r for r in got if "many" in r.file), key=lambda r: r.line_key)] == want, size
            assert sorted(r.line_key for r in got if "many" in r.file) == list(range(len(want))) and len(got) == len(want) + 1
            assert [(r.line, r.line_key) for r in got if "one" in r.file] == [("only", 0)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


HEALTH = dict(kl_metric="kl", loss_metric="loss", reward_metric="reward", window=3, spike_sd=1.0, flat_sd=0.05)


def test_stream_health_equals_batch_over_restarts_and_late_rows(spark, tmp_path):
    import random
    rng = random.Random(4)
    hour = 3600
    rows = [(run, metric, 1_700_006_400 + h * hour + rng.randint(0, hour - 1),
             float("nan") if rng.random() < 0.02 else rng.choice([0.05, 0.3, 1.2, 1.0, 1.0, 9.0]))
            for run in ("a", "b") for metric in ("kl", "loss", "reward") for h in range(40) if rng.random() < 0.8 for _ in range(3)]
    rows.sort(key=lambda r: r[2])
    last = rows[-1][2]
    frame = lambda part: spark.createDataFrame(part, "run string, metric string, s long, value double").select(
        "run", "metric", F.timestamp_seconds("s").alias("ts"), "value")
    sink, src = str(tmp_path / "out"), str(tmp_path / "in")
    cut = len(rows) // 5
    for i in range(5):  # five starts of the stream; each later one also brings rows that are far too late
        late = [(*r[:3], 1e6) for r in rows[:3]] if i >= 2 else []
        frame(rows[i * cut:(i + 1) * cut if i < 4 else None] + late).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        X.run_health(X.stream_buckets(stream, "hour", "30 minutes"), sink, **HEALTH)
    got = spark.read.parquet(sink)
    batch = M.training_health(frame(rows), bucket="hour", **HEALTH).filter(F.col("bucket_ts") + hour <= last - 1800)
    cols = ["run", "metric", "bucket_ts", F.round("mean", 9).alias("mean"), "n", "kl_flag", "loss_flag", "reward_flag"]
    found, want = (sorted(map(str, d.select(*cols).collect())) for d in (got, batch))
    assert found == want and {"jump", "nan"} <= {r.loss_flag for r in got.collect()} and "spike" in {r.reward_flag for r in got.collect()}
    states = [d for d in os.listdir(X.health_state(spark, sink)) if d.startswith("batch_id=")]
    assert len(states) <= 2  # of ten batches
    held = spark.read.parquet(os.path.join(X.health_state(spark, sink), max(states, key=lambda d: int(d.split("=")[1]))))
    assert held.count() <= 2 * 3 * 3


def test_exact_dedup_drops_copies_of_any_age(spark, tmp_path):
    src, sink = str(tmp_path / "in"), str(tmp_path / "out")
    texts = [["the first prompt", "the second prompt", "the first prompt", "short", None], ["the second prompt", "a third prompt"], [],
             ["the first prompt", "a third prompt", "the fourth prompt"]]
    for part in texts:
        spark.createDataFrame([(t,) for t in part], "question string").coalesce(1).write.mode("append").parquet(src)
        X.run_exact_prompt_set(spark.readStream.schema("question string").parquet(src), sink)
    want = ["a third prompt", "the first prompt", "the fourth prompt", "the second prompt"]
    assert sorted(r.question for r in spark.read.parquet(sink).collect()) == want
    out, seen = str(tmp_path / "o"), str(tmp_path / "s")
    for batch_id, part in ((0, texts[0]), (0, texts[0]), (1, texts[1]), (1, texts[1])):  # batches that run again
        X.exact_batch(spark.createDataFrame([(t,) for t in part], "question string"), batch_id, out, seen, "question")
    assert sorted(r.question for r in spark.read.parquet(out).collect()) == ["a third prompt", "the first prompt", "the second prompt"]


def test_a_batch_that_runs_again_leaves_one_copy(spark, tmp_path):
    b = spark.createDataFrame([("a", "loss", 0, 1.0, 0, 1), ("a", "loss", 3600, 5.0, 0, 1)], X.BUCKETS)
    for _ in range(2):
        X.health_batch(b.filter("bucket = 0"), 0, str(tmp_path / "o"), str(tmp_path / "s"), **HEALTH)
    for _ in range(2):
        X.health_batch(b.filter("bucket > 0"), 1, str(tmp_path / "o"), str(tmp_path / "s"), **HEALTH)
    assert sorted((r.bucket_ts, r.loss_flag) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [(0, "ok"), (3600, "jump")]


def test_stream_keeps_malformed_lines_and_restarts(spark, tmp_path):
    src, sink = tmp_path / "in", str(tmp_path / "sink")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    _write(str(src / "a.jsonl"), [json.dumps({"doc_id": 1, "text": "the cat"}), '{"doc_id": 2, "text": "the', "not json"])
    for _ in range(2):  # the second run has nothing new
        X.run_available_now(X.stream_keyword_filter(spark, str(src), schema, "text", ["the"]), sink)
    _write(str(src / "b.jsonl"), [json.dumps({"doc_id": 3, "text": "the dog"}), json.dumps({"doc_id": 4, "text": "no hit"})])
    X.run_available_now(X.stream_keyword_filter(spark, str(src), schema, "text", ["the"]), sink)
    good, bad = io.quarantine(spark.read.parquet(sink))
    assert sorted(r.doc_id for r in good.collect()) == [1, 3] and bad.count() == 2


def test_checkpoint_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    import pytest

    from alignfold import session

    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_json_dir_takes_documents(spark, tmp_path):
    """Arrays and printed objects beside JSON lines: the same records; what is neither goes line by line."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.StringType())])
    record = [{"a": i, "t": f'line\n"{i}" [x]'} for i in range(6)]
    (tmp_path / "deep").mkdir()
    files = {"array.json": json.dumps(record[:2]), "printed.json": "\n \n" + json.dumps(record[2:4], indent=2),
             "deep/object.json": json.dumps(record[4], indent=1), "lines.json": json.dumps(record[5]) + "\n\n{bad\n",
             "mixed.json": '[{"a": 10, "t": "m"}, 7, null, {"a": "no"}]', "broken.json": '[\n{"a": 11, "t": "b"}\n{"a": 12',
             "two.json": '{\n"a": 13},{"a": 14}\n', "none.json": "[]", "empty.json": "", "array.jsonl": '[{"a": 15}]\n'}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, bad = io.quarantine(io.read_json_dir(spark, str(tmp_path), schema)["train"])
    assert sorted((r.a, r.t) for r in good.collect()) == [(x["a"], x["t"]) for x in record] + [(10, "m"), (11, "b")]
    assert sorted(r[0].replace(" ", "") for r in bad.collect()) == sorted(
        ["{bad", "7", "null", '{"a":"no"}', "[", '{"a":12', "{", '"a":13},{"a":14}', '[{"a":15}]'])
    lines, rest = io.quarantine(io.read_json_dir(spark, str(tmp_path), schema, layout="lines")["train"])
    assert sorted(r.a for r in lines.collect()) == [5, 11]
    with pytest.raises(ValueError):
        io.read_json_dir(spark, str(tmp_path), schema, layout="other")
