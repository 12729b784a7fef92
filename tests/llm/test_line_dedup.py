"""Repeated lines against a plain loop, on both paths (streamed ranges and hot keys)."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from roadlens.llm import line_dedup

UP = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)


def brute(rows):
    """[(doc_id, lines, dropped, text)] of (doc_id, text) rows."""
    rank = lambda i: (i is not None, i or 0)
    key = lambda line: line.strip(line_dedup.BLANKS).translate(UP)
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or i == max(holders[key(x)], key=rank)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def collected(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in frame.collect()), key=str)


def texts(seed, many):
    r = random.Random(seed)
    pool = ["short", "", "   ", "exactly twenty chars", "nineteen characters", "A Line That Repeats Across Documents", "a line that repeats across documents\t",
            "\x0b a line that repeats across documents \r", "\xa0a line that repeats across documents", "ÄÖÜ Straße in Großbuchstaben überall", "äöü Straße in Großbuchstaben überall",
            "中文的行在许多文件里重复出现并且足够长才算数的", "🙂" * 20, "🙂" * 19, *[f"a line of its own number {i} and more" for i in range(60)]]
    return ["\n".join(r.choice(pool) for _ in range(r.randrange(0, 12))) for _ in range(many)]


@pytest.mark.parametrize("hot_rows, hot_keys", [(1_000, 1_000), (3, 4), (0, 10_000)])
def test_equals_the_loop(documents, hot_rows, hot_keys):
    rows = [(i, t) for i, t in enumerate(texts(1, 150))]
    rows += [(7, rows[3][1]), (7, rows[4][1]), (7, rows[7][1]), (None, rows[5][1]), (None, rows[9][1]), (500, None), (501, ""), (502, "\n\n"), (-3, rows[11][1])]
    found = line_dedup.line_dedup(documents([t for _, t in rows], [i for i, _ in rows]), hot_rows=hot_rows, hot_keys=hot_keys)
    assert collected(found) == brute(rows)


def test_long_texts_and_sparse_bitmaps(documents):
    body = "\n".join(f"line number {i} of a very long document" if i % 1000 else "the line that all of these documents hold" for i in range(20_000))
    rows = [(1, body), (2, body + "\nmore of this long and tedious text"), (3, body), (4, "the line that all of these documents hold")]
    frame = documents([t for _, t in rows], [i for i, _ in rows])
    assert collected(line_dedup.line_dedup(frame, hot_rows=10)) == brute(rows)
    words = {r.d: r.kept_words for r in line_dedup.keep_bitmaps(frame).collect()}
    assert set(words) == {1, 2, 3} and len(words[3]) == 20 and len(words[1]) == 313  # 3 keeps all but every 1,000th line, 1 keeps none
    assert all(w.bits == ~(1 << (w.word * 64 + 63) // 1000 * 1000 % 64) for w in words[3] if w.word and (w.word * 64 + 63) // 1000 * 1000 >= w.word * 64) and words[1][0].bits == 0


def test_awkward_repeated_and_empty(awkward, nothing, documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = line_dedup.line_dedup(awkward)
    assert found.columns == [*awkward.columns, "n_lines", "n_dropped"] and collected(found) == brute(rows)
    assert line_dedup.line_dedup(nothing).count() == 0
    same = [(9, "one line that is repeated often enough")] * 40 + [(8, "one line that is repeated often enough")] * 40
    frame = documents([t for _, t in same], [i for i, _ in same])
    assert collected(line_dedup.line_dedup(frame)) == brute(same) == collected(frame.withColumns({"n_lines": F.lit(1), "n_dropped": F.lit(0)}))
    clash = frame.withColumns({"n_lines": F.lit("x"), "D": F.lit("y")})
    assert line_dedup.line_dedup(clash).columns == [*clash.columns, "n_lines_", "n_dropped"]


def test_no_python_and_one_range_exchange(documents):
    plan = line_dedup.line_dedup(documents(["a\nb"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("rangepartitioning") == 1
