import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, sentence  # noqa: E402

from alignfold.llm import licenses, queries  # noqa: E402


def planted():
    rng = random.Random(21)
    rows, want = [], {}
    for i, (name, texts) in enumerate((n, x) for n, t in licenses.TEMPLATES.items() for x in [t]):
        for j, text in enumerate(texts):
            for k, change in enumerate(("whole", "upper", "break", "edit")):
                words = text.split()
                if change == "edit":
                    if len(words) < 12:
                        continue
                    words[len(words) // 2] = "changed"
                    words.insert(len(words) // 3, "more words")
                body = (" " if change != "break" else "\n").join(words)
                body = body.upper() if change == "upper" else body
                doc = 10_000 + i * 100 + j * 10 + k
                head = sentence(rng, 40)
                rows.append((doc, f"{head} {body} {sentence(rng, 40)}", "en", "a", 0))
                want[doc] = (name, len(head) + 1, len(head) + 1 + len(body))
    return rows, want


def test_planted_notices(spark):
    rows, want = planted()
    rows += awkward()
    got = {r.doc_id: r.matches for r in licenses.scan(frame(spark, rows, clashes=True)).collect()}
    for doc, (name, start, end) in want.items():
        assert [m.license for m in got[doc]] == [name], (doc, name, got[doc])
        m = got[doc][0]
        assert m.start == start and m.end == end and m.coverage >= licenses.COVERAGE
    assert not any(got[r[0]] for r in awkward())


def test_two_places_and_rival_templates(spark):
    gpl2, gpl3 = licenses.TEMPLATES["GPL-2.0"][1], licenses.TEMPLATES["GPL-3.0"][1]
    text = gpl3 + " middle words " * 30 + gpl2 + " and " + licenses.TEMPLATES["MIT"][0]
    got = licenses.scan(frame(spark, [(1, text, "en", "a", 0)])).first().matches
    assert [m.license for m in got] == ["GPL-3.0", "GPL-2.0", "MIT"] and all(m.coverage == 1 for m in got)
    assert [text[m.start:m.end] for m in got] == [gpl3, gpl2, licenses.TEMPLATES["MIT"][0]]


def test_repeated_notices_have_a_match_each():
    index = licenses.Index.build(licenses.TEMPLATES)
    for texts in licenses.TEMPLATES.values():
        for line in texts:
            for n in range(2, 11):
                for gap in ("\n", "\n# ", " and then "):
                    text = "Intro words here\n" + gap.join([line] * n) + "\nmore words follow"
                    got = index.scan(text, licenses.COVERAGE)
                    want = [len("Intro words here\n") + i * len(line + gap) for i in range(n)]
                    assert [m[3:] for m in got] == [(a, a + len(line)) for a in want], (line, n, gap)


@pytest.mark.parametrize("where", range(6))
def test_a_changed_notice_among_repeated_ones_has_its_match(where):
    line = licenses.TEMPLATES["Apache-2.0"][0]
    lines = [line] * 6
    lines[where] = line.replace("Licensed", "Given")
    got = licenses.Index.build(licenses.TEMPLATES).scan("\n".join(lines), licenses.COVERAGE)
    assert [m[2] for m in got] == [6 if i == where else 7 for i in range(6)]


@pytest.mark.parametrize("text, names", [
    ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]), ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1"]),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ["CC-BY-ND-4.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("This work is licensed under the GNU Lesser General Public License, version 7.", []),
    ("This work is licensed under the GNU General Public License, version 4.", []), ("Licensed under CC BY-XY 4.0.", []),
    ("Licensed under CC BY 3.0.", []), ("Released under the XYZ License.", []), ("Licensed under the ZLIB License.", [])])
def test_near_misses_have_their_own_name_or_none(text, names):
    index = licenses.Index.build(licenses.TEMPLATES)
    assert [m[0] for m in index.scan(f"some words before {text} and some after", licenses.COVERAGE)] == names


def test_no_template_is_reported_without_a_word_that_decides_it():
    index = licenses.Index.build(licenses.TEMPLATES)
    word = {i: w.decode() for w, i in index.ids.items()}
    tried = 0
    for t, name in enumerate(index.names):
        line = [word[i] for i in index.words[t].tolist()]
        for i in index.needs[t]:
            for other in ("", "zzz"):
                text = " ".join(x if x != word[i] else other for x in line)
                assert name not in [m[0] for m in index.scan(f"before it {text} after it", licenses.COVERAGE)], (name, word[i])
                tried += 1
        for i in index.bars[t]:
            at = len(line) // 2
            text = " ".join([*line[:at], word[i], *line[at:]])
            assert name not in [m[0] for m in index.scan(f"before it {text} after it", licenses.COVERAGE)], (name, word[i])
    assert tried > 60 and all(index.needs[t] for t, w in enumerate(index.words) if len(w) <= 12)


def test_alignment_is_the_longest_common_run_in_the_band():
    rng = random.Random(2)
    for _ in range(60):
        index = licenses.Index.build({"t": [" ".join(rng.choice("abcd") for _ in range(rng.randint(5, 15)))]})
        word = index.words[0]
        row = np.array([rng.randint(0, 4) for _ in range(30)], np.int64)
        diagonal = rng.randint(-3, 20)
        best = {}  # longest common subsequence over the cells of the band
        for i in range(len(word) + 1):
            for j in range(diagonal - licenses.BAND - 1 + i, diagonal + licenses.BAND + 1 + i):
                inside = -licenses.BAND <= j - 1 - (i - 1) - diagonal <= licenses.BAND
                same = i and inside and 1 <= j <= len(row) and word[i - 1] == row[j - 1]
                best[i, j] = max(best.get((i - 1, j), 0), best.get((i, j - 1), 0), best.get((i - 1, j - 1), 0) + bool(same))
        assert index.align(row, 0, diagonal)[0] == max(best.values())


def test_every_run_of_four_template_words_is_found():
    index = licenses.Index.build(licenses.TEMPLATES)
    rng = random.Random(3)
    for t, word in enumerate(index.words):
        at = rng.randint(0, len(word) - 4)
        row = np.concatenate([np.zeros(5, np.int64), word[at:at + 4], np.zeros(5, np.int64)])
        found = {i for i, _ in index.candidates(row)}
        assert any((index.words[i].tobytes().find(word[at:at + 3].tobytes()) >= 0 or
                    index.words[i].tobytes().find(word[at + 1:at + 4].tobytes()) >= 0) for i in found)


def test_empty(spark):
    assert licenses.scan(empty(spark)).count() == 0
    assert licenses.scan(frame(spark, awkward()), templates={}).filter("size(matches) > 0").count() == 0


@pytest.mark.parametrize("line, name", [
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Released under the MIT License.", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0")])
def test_query(spark, sf_dir, line, name):
    import duckdb
    want = {r[0] for r in duckdb.execute(f"select doc_id from '{sf_dir}/documents.parquet' where contains(text, ?)", [line]).fetchall()}
    rows = queries.op6_licenses(spark, sf_dir).collect()
    assert len(rows) == duckdb.sql(f"select count(*) from '{sf_dir}/documents.parquet'").fetchall()[0][0]
    assert {r.doc_id for r in rows if name in r.licenses.split(",")} == want
