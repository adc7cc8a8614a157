import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, sentence, text_of  # noqa: E402

from alignfold.llm import host_rules, queries  # noqa: E402


def brute(text):
    for c in "\t\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for line in text.split("\n") for w in line.split(" ") if w]
    n = len(words)
    times = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if times[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if x.strip(" ")]
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def found(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts(spark):
    rows = awkward()
    got = host_rules.judge(frame(spark, rows, clashes=True)).collect()
    assert sorted((str(r.doc_id), found(r)) for r in got) == sorted((str(r[0]), brute(text_of(r))) for r in rows)


def test_a_bad_host_goes_and_small_or_missing_hosts_are_not_condemned(spark):
    import random
    rng = random.Random(1)
    rows = [(i, sentence(rng, 80), "en", "good", 0) for i in range(300)]
    rows += [(1000 + i, sentence(rng, 80) + (" # | $ & %" * 4 if i % 10 else ""), "en", "bad", 0) for i in range(200)]
    rows += [(2000, "x # | $ & % " * 30, "en", "tiny", 0), (2001, sentence(rng, 80) + " #" * 40, "en", None, 0),
             (2002, sentence(rng, 80), "en", None, 0), (2003, "short", "en", "good", 0)]
    rows += [(3000 + i, sentence(rng, 80), "en", f"h{i % 20}", 0) for i in range(400)]
    got = {r.doc_id: r for r in host_rules.judge(frame(spark, rows)).collect()}
    assert all(got[i].kept for i in range(300)) and not any(got[1000 + i].kept for i in range(200))
    assert got[2001].kept and got[2002].kept and not got[2003].kept
    assert all(got[3000 + i].kept for i in range(400))


def test_prior_shrinks_by_size(spark):
    rows = [(h, h, "en", f"h{h:02d}", 0) for h in range(20)]
    counted = frame(spark, rows).selectExpr("doc_id AS id", "source AS host", "explode(sequence(1, 40)) AS k").selectExpr(
        "id", "host", "CASE WHEN k <= id * 2 THEN array('lines') ELSE array() END AS failed")
    small = spark.createDataFrame([(99, "one", ["lines"])], "id long, host string, failed array<string>")
    got = {r.host: r for r in host_rules.host_verdicts(counted.unionByName(small)).filter("rule = 'lines'").collect()}
    assert got["h19"].shrunk > got["h10"].shrunk > got["h00"].shrunk
    assert abs(got["h19"].shrunk - 38 / 40) < abs(got["one"].shrunk - 1)


def test_empty(spark):
    assert host_rules.judge(empty(spark)).count() == 0


@pytest.mark.parametrize("text", ["", "\n\n", "a b c a b c", "a b a b a b", "x\nx\n x\nx"])
def test_text(text):
    n, chars, symbols, lines, dup, repeat = host_rules.count_text(text)
    assert (n, chars, symbols, dup, repeat) == brute(text)[:5]


def test_query(spark, sf_dir):
    import duckdb
    docs = dict(duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall())
    got = queries.op10_host_rules(spark, sf_dir).collect()
    assert len(got) == len(docs)
    assert all(found(r) == brute(docs[r.doc_id] or "") for r in got)
    assert all(r.kept == (not r.base_failed and not r.host_bad) for r in got)


def test_query_equals_its_sql(spark, sf_dir):
    from alignfold.plans.oracle import duck, rows_of

    con = duck(sf_dir)
    cur = con.execute(queries.ORACLE["op10_host_rules"])
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    df = queries.op10_host_rules(spark, sf_dir)
    assert sorted(df.columns) == sorted(cols) and rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
