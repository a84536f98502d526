"""Periodic runs against the definition, word by word."""

import hashlib
import random

import numpy as np
import pytest

from tabmill.llm import periodic, queries

SCHEMA = "doc_id long, text string, start string, runs int, `a.b` int"


def brute(words):
    """All runs by trying every period at every place."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_order(found):
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def made(rnd):
    words = []
    while rnd.random() < 0.8:
        words += [rnd.choice("abcdefgh" * 3) + str(rnd.randrange(50)) for _ in range(rnd.randrange(30))]
        block = [rnd.choice("ab") for _ in range(rnd.choice([1, 2, 3, 5, 7, 8, 9, 12, 16, 17, 31, 33, 40]))]
        words += (block * 9)[:rnd.randrange(1, 9 * len(block) + 1)]
    return words


def test_runs_equal_those_of_every_period():
    rnd = random.Random(3)
    texts = [made(rnd) for _ in range(150)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 500, ["a", "b"] * 3, ["a", "b"] * 300]
    texts += [(["x", *["y"] * 19] * 8 + ["x"])[:k] for k in (79, 80, 81, 160)]
    texts.append((["w%d" % (i * i % 97) for i in range(300)]) * 4)
    numbers, known = [], {}
    for i, own in enumerate(texts):
        numbers += [known.setdefault(w, len(known)) for w in own] + [-1 - i]
    lengths = np.array([len(t) for t in texts])
    found = periodic.find_runs(np.array(numbers, np.int64), lengths)
    first, want = 0, []
    for own in texts:
        want += [(s + first, s + length + first, q) for s, length, q in brute_order(brute(own))]
        first += len(own) + 1
    assert [tuple(r) for r in found.tolist()] == want and len(want) > 100
    assert max(q for *_, q in want) == 300


def test_query_equals_brute_force_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    given = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    got = queries.op13_minimizer_runs(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(given)
    with_runs = 0
    for r in got:
        words = queries.replayed(r.doc_id, (given[r.doc_id] or "").encode().split())
        if len(words) > 1500:
            continue
        found = brute_order(brute(words))
        best = None
        for run in found:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found)).hexdigest()
        with_runs += bool(found)
    assert with_runs > 5


def test_odd_rows(spark):
    rows = [(1, None, "x", 1, 1), (2, "", "x", 1, 1), (None, "a " * 10, "x", 1, 1), (3, "a b " * 4 + "c", None, None, None),
            (3, "a b " * 4 + "c", None, None, None), (4, "w " * 40000 + "é", "x", 1, 1), (5, " \n\t", "x", 1, 1)]
    got = periodic.runs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_id[3].runs] == [(0, 8, 2)] and by_id[3].collapsed == "a b c"
    assert [tuple(x) for x in by_id[4].runs] == [(0, 40000, 1)] and by_id[4].collapsed == "w é"
    assert [tuple(x) for x in by_id[None].runs] == [(0, 10, 1)]
    assert all(by_id[i].runs == [] and by_id[i].collapsed == "" for i in (1, 2, 5))
    assert periodic.runs(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(0, np.int64), np.zeros(0, np.int64), times=3)
