"""Product codes against full scans."""
import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from faultline.llm import codes  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, code string, _id int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{row: (code, error, label_error)} and the codebooks, by full scans in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    books = [[r[1][p * w:(p + 1) * w] for r in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(books[p]))
    for t in range(rounds + 1):
        found = [[nearest(p, v[p * w:(p + 1) * w]) for p in range(parts)] for _, v, _ in kept]
        if t == rounds:
            break
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [r[1][p * w:(p + 1) * w] for r, f in zip(kept, found) if f[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    by_label = defaultdict(int)
    for (_, _, y), f in zip(kept, found):
        by_label[y] += sum(d for d, _ in f)
    return sorted((str(i), bytes(j for _, j in f).hex(), sum(d for d, _ in f), by_label[y]) for (i, _, y), f in zip(kept, found)), books


def run(table, scans=None, **options):
    coded, books = codes.compress(table, scans=scans, **options)
    got = codes.with_label_error(coded).collect()
    return sorted((str(r.vec_id), r.code and bytes(r.code).hex(), r.error, r.label_error) for r in got), books


def sample(n, width=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return [(i, (centres[i % 12] + 0.2 * rng.normal(size=width)).tolist(), None if i % 7 == 0 else i % 3) for i in range(n)]


def test_codes_are_those_of_full_scans(spark):
    rows = sample(300)
    rows += [(1000 + i, rows[0][1], 5) for i in range(200)]                 # many equal vectors under one label
    rows += [(0, rows[3][1], 1), (None, rows[4][1], None), (5, rows[5][1], 2)]      # repeated and null ids
    rows += [(-1, None, 1), (-2, [None] + rows[0][1][1:], 1), (-3, [math.nan] + rows[0][1][1:], 1),
             (-4, [math.inf] + rows[0][1][1:], 1)]                          # dropped
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    scans: list[int] = []
    got, books = run(table.repartition(3), scans)
    want, wanted_books = brute(rows)
    assert got == want
    assert books.tolist() == wanted_books
    text = ",".join(str(x) for p in wanted_books for c in p for x in c)
    assert codes.codebook_digest(books) == hashlib.sha256(text.encode()).hexdigest()
    assert scans[0] == 8 * len(want) and scans[-1] < scans[0] / 2           # the bounds spare most of the work
    assert run(table.repartition(5))[0] == got


def test_fewer_rows_than_entries_and_ties(spark):
    rows = [(i, [float(i % 2)] * 8, 0) for i in range(5)]                   # equal entries: the lower index
    got, _ = run(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    assert got == brute(rows)[0]
    assert run(spark.createDataFrame([], SCHEMA))[0] == []


def test_vectors_that_cannot_be_coded(spark):
    rows = sample(40)
    odd = [(500, [1.0] * 24, 1), (501, [1.0] * 3, 1), (502, [], 1), (503, [1e30] + rows[0][1][1:], 2)]
    got, _ = run(spark.createDataFrame([(*r, "x", 1) for r in rows + odd], SCHEMA))
    want, _ = brute(rows)
    assert [r for r in got if int(r[0]) < 500] == want
    assert [r[1:3] for r in got if int(r[0]) >= 500] == [(None, None)] * 4


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (20000 * rng.normal(size=8)).clip(-60000, 60000).tolist(), 1) for i in range(60)]
    got, books = run(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    want, wanted = brute(rows)
    assert got == want and books.tolist() == wanted


def test_net_displacement_is_tighter_than_summed_drift():
    """An entry that moves out and back leaves every older bound as it was."""
    b = np.array([[[0], [50]]])
    there = b + np.array([[[0], [30]]])
    assert codes.displacements([b, there, b])[0].max() == 0
    assert codes.displacements([b, there, b])[1, 0, 0] == pytest.approx(30, rel=1e-5)
    x = np.array([[[3]], [[60]]])
    code, bound, stamp, own, n = codes.assign(x, [b], codes.displacements([b]), None, None, None)
    assert code.ravel().tolist() == [0, 1] and own.ravel().tolist() == [9, 100] and n == 2
    *_, n = codes.assign(x, [b, there, b], codes.displacements([b, there, b]), code, bound, stamp)
    assert n == 0
