"""The distributed isotonic curve against pooling the whole sequence in one pass."""
from fractions import Fraction

import numpy as np
import pytest

from faultline.operators.isotonic import isotonic_apply, isotonic_blocks


def brute(rows):
    """Blocks (lo, hi, mean) by pooling adjacent violators over all distinct scores."""
    at = {}
    for p, y in rows:
        if p is not None and y is not None:
            w, s = at.get(p, (0, 0))
            at[p] = w + 1, s + y
    out = []
    for p in sorted(at):
        out.append([p, p, *at[p]])
        while len(out) > 1 and Fraction(out[-2][3], out[-2][2]) >= Fraction(out[-1][3], out[-1][2]):
            lo, _, w, s = out.pop(-2)
            out[-1] = [lo, out[-1][1], w + out[-1][2], s + out[-1][3]]
    return [tuple(x) for x in out]


def curve(blocks, x):
    xs, vs = [], []
    for lo, hi, w, s in blocks:
        for k in dict.fromkeys((lo, hi)):
            xs.append(k)
            vs.append(s / w)
    return np.interp(x, xs, vs)


@pytest.mark.parametrize("partitions", [1, 4, 70])
def test_blocks_and_curve(spark, partitions):
    rng = np.random.default_rng(partitions)
    rows = []
    for model, n, digits in (("a", 3000, 3), ("b", 500, 1), ("c", 1, 3), (None, 40, 2)):
        p = np.round(rng.random(n), digits)
        y = (rng.random(n) < p ** 2).astype(int)
        rows += [(model, float(a), int(b)) for a, b in zip(p, y)]
    rows += [("a", None, 1), ("a", 0.5, None)]
    df = spark.createDataFrame(rows, "model string, p double, y int")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = isotonic_blocks(df, ["model"])
        got = {}
        for r in blocks.collect():
            got.setdefault(r.model, []).append((r.lo, r.hi, r.w, r.s))
        want = {m: brute([(p, y) for k, p, y in rows if k == m]) for m in ("a", "b", "c", None)}
        assert {m: sorted(x) for m, x in got.items()} == want
        asked = spark.createDataFrame([(m, x, i) for i, (m, x) in enumerate([(m, x) for m in ("a", "b", "c", None, "other") for x in (-1.0, 0.0, 0.1234, 0.5, 0.77, 1.0, 2.0, None)])],
                                      "model string, p double, n int")
        for most in (10 ** 6, 0):                       # the broadcast curve, and the join
            out = {r.n: (r.model, r.p) for r in isotonic_apply(blocks, asked, ["model"], most_knots=most).collect()}
            assert len(out) == 40
            for model, x, n in [(r.model, r.p, r.n) for r in asked.collect()]:
                if x is None or model == "other":
                    assert out[n] == (model, None)
                else:
                    assert out[n][0] == model and out[n][1] == pytest.approx(float(curve(want[model], x)), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_without_groups_and_empty(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0), (0.3, 1), (0.3, 1)], "p double, y int")
    assert [tuple(r) for r in isotonic_blocks(df).orderBy("lo").collect()] == [(0.1, 0.2, 2, 1), (0.3, 0.3, 2, 2)]
    assert isotonic_blocks(df.limit(0)).count() == 0
    assert [r.p for r in isotonic_apply(isotonic_blocks(df.limit(0)), df).collect()] == [None] * 4


def test_the_number_of_blocks_is_bounded(spark):
    """A sequence that is convex already keeps every edge; distinct slopes need many rows."""
    rows, x = [], 0
    for w in range(1, 40):
        for s in range(w + 1):
            if np.gcd(w, s) == 1:
                rows.append((s / w, w, s))
    rows.sort()
    n, blocks = sum(w for _, w, _ in rows), len(rows)
    assert blocks < 4 * n ** (2 / 3)
    data = [(float(i), int(k < s)) for i, (_, w, s) in enumerate(rows) for k in range(w)]
    assert isotonic_blocks(spark.createDataFrame(data, "p double, y int")).count() == blocks
