"""Runs of repeated phrases against brute force."""
import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

pytest.importorskip("public_tokenizers")

from faultline.llm import periodic, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def brute_runs(w):
    """(start, length, period) by comparing every word with the one a period before."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        same = [w[i] == w[i + q] for i in range(len(w) - q)] + [False]
        start = None
        for i, eq in enumerate(same):
            if eq and start is None:
                start = i
            if not eq and start is not None:
                s = w[start:i + q]
                if len(s) >= max(6, 4 * q) and not any(s[r:] == s[:len(s) - r] for r in range(1, q)):
                    out.append((start, len(s), q))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        k, out = rng.choice([1, 2, 2, 3, 5]), []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 9))]
            if rng.random() < 0.3:
                unit = unit * rng.randint(1, 4) + unit[:rng.randint(0, len(unit))]
            out += (unit * rng.randint(1, 9))[:rng.randint(0, 90)]
        yield [b"w%d" % x for x in out]


def test_runs_of_random_texts():
    made = list(texts(3, 600))
    found = 0
    for i in range(0, len(made), 7):
        for w, got in zip(made[i:i + 7], periodic._chunk(made[i:i + 7])):
            assert got == brute_runs(w)
            assert periodic.collapse(w, got) == brute_collapsed(w, got)
            found += len(got)
    assert found > 500


def test_long_periods_and_long_runs():
    rng = random.Random(5)
    unit = [b"%d" % rng.randrange(40) for _ in range(701)]
    w = [b"x"] * 50 + unit * 5 + unit[:30] + [b"y", b"x"] * 3000
    want = [(0, 50, 1), (50, 5 * 701 + 30, 701), (50 + 5 * 701 + 30, 6000, 2)]
    assert periodic._chunk([w, w[:4000], w])[0] == want
    assert periodic._chunk([w, w[:4000], w])[2] == want
    many = [b"a"] * 200_000
    assert periodic._chunk([many]) == [[(0, 200_000, 1)]]


def test_successors():
    import numpy as np
    rng = np.random.default_rng(2)
    values = rng.permutation(300)
    tree = periodic.Wavelets(values)
    low = rng.integers(0, 300, 500)
    high = low + 1 + (rng.random(500) * (300 - low)).astype(int)
    x = rng.integers(0, 310, 500)
    below = tree.below(low, high, x)
    for a, b, y, got in zip(low, high, x, below):
        inside = np.sort(values[a:b])
        assert got == (inside < y).sum()
    kth = tree.kth(low, high, (high - low) // 2)
    assert all(np.sort(values[a:b])[(b - a) // 2] == v for a, b, v in zip(low, high, kth))


def test_find_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a " * 5), (5, "a " * 6), (6, "a b c " * 4), (6, "a b c " * 4),
            (None, "é x é x é x é x"), (7, "b a " * 3 + "c"), (8, "q " * 30_000)]
    table = spark.createDataFrame([(*r, 9, "old") for r in rows], "doc_id long, text string, n_words int, collapsed string")
    got = periodic.find(table)
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    for r in got.collect():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode())
        want = [(0, 30_000, 1)] if len(w) == 30_000 else brute_runs(w)
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(w), want)
        assert r.collapsed.encode() == b" ".join(["q".encode()] if len(w) == 30_000 else brute_collapsed(w, want))
    assert periodic.find(table.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            planted += 1
        runs = brute_runs(w)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2]) and r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(brute_collapsed(w, runs)).encode()).hexdigest()
    assert planted > 5
