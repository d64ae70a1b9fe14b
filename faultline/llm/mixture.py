"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets an expected number of copies, the target of its source over the size of its
source.  The whole part is certain.  The fractional parts are rounded by the pivotal method
(Deville and Tille): two fractions meet, mass moves between them at random, one of them becomes
0 or 1 and the other meets the next.  The mass is counted in words, so every meeting keeps the
words of a source, and only the last open document of a source moves them off the target.

The rounding is a reduction tree.  Leaves are (source, size class, hash bucket) and hold
documents of nearly equal size, so that the words taken follow the copies taken; each leaf leaves
one fraction, which its parent combines: leaves, buckets, classes, source.  Leaves are a function
of the rows alone, so reruns agree, and a hot source is spread over thousands of them.

Defined cases: a null text has size 0; null is a source of its own and sorts last; equal rows are
rounded one by one; a source without words has target 0 and is not taken; an empty table gives an
empty result.  Columns of the input are passed through, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import WORD, join_on_small, saved

# fixed values: weights by rank of the source, the share of all words that the mix holds, and
# the most copies of a document
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0

#: Hash buckets of a (source, size class): 2 ** LEAF_BITS leaves, FAN_BITS less at the next level.
LEAF_BITS, FAN_BITS = 12, 6

_OWN = ("_m_source", "_m_size", "_m_class", "_m_leaf", "_m_tie", "_m_whole", "_m_p", "_m_u")


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST_COPIES,
                   weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target): ``share`` of all words dealt out
    by weight, each target at most ``most`` times its source, the excess dealt out again.

    That is the water level L with sum(min(cap, L * weight)) = total.  With the sources ordered
    by cap / weight, the level that solves the equation for the first k sources full never
    exceeds L and equals it for one k, so L is the largest of these levels.  One row per source
    goes through the window, never documents.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
                      - 1) % len(weights) + 1)
    ranked = sizes.select("source", "source_size", w.alias("w"),
                          (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    level = (F.lit(float(share)) * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    return (ranked.withColumn("level", level)
            .withColumn("level", F.max("level").over(everything))
            .select("source", "source_size",
                    F.least(F.col("cap"), F.greatest(F.lit(0.0), F.col("level") * F.col("w")))
                    .alias("target")))


def _meet(a: float, b: float, size_a: float, size_b: float, u: float) -> tuple[float, float]:
    """One step for two fractions: words move from one to the other until a fraction is 0 or 1.

    The words ``a * size_a + b * size_b`` are kept, and so is the expectation of either fraction."""
    up, down = min((1 - a) * size_a, b * size_b), min(a * size_a, (1 - b) * size_b)
    if u * (up + down) < down:                         # towards a
        a, b = a + up / size_a, b - up / size_b
    else:
        a, b = a - down / size_a, b + down / size_b
    return _snap(a), _snap(b)


def _snap(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p


def _round_runs(keys: list[str]):
    """A worker's pass over rows sorted by ``keys``: rounds each run of equal keys down to one
    fraction at most.  Holds one Arrow batch and one open row."""
    def run(batches):
        held, held_p, held_size, held_key = None, 0.0, 0, None  # the open row, as a batch of one row
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = batch.schema.get_field_index("_m_p")
            column = {f.name: i for i, f in enumerate(batch.schema)}
            p, u, size = (batch.column(column[c]).to_pylist() for c in ("_m_p", "_m_u", "_m_size"))
            key = list(zip(*[batch.column(column[k]).to_pylist() for k in keys]))
            open_at = -1                               # index of the open row; -1: it is `held`
            for i in range(n):
                if key[i] != held_key:
                    if held is not None:               # the last group's remainder leaves as it is
                        yield _with_p(held, at, [held_p])
                        held = None
                    held_key, open_at = key[i], None
                if not 0.0 < p[i] < 1.0:
                    continue
                if not size[i]:                        # no words to move: drawn alone
                    p[i] = float(u[i] < p[i])
                    continue
                if open_at is None:
                    open_at = i
                    continue
                mine, own = (held_p, held_size) if open_at == -1 else (p[open_at], size[open_at])
                mine, p[i] = _meet(mine, p[i], own, size[i], u[i])
                if open_at == -1:
                    held_p = mine
                else:
                    p[open_at] = mine
                if not 0.0 < mine < 1.0:
                    if open_at == -1:
                        yield _with_p(held, at, [held_p])
                        held = None
                    open_at = i if 0.0 < p[i] < 1.0 else None
                # else the newcomer was decided and the open row stays open
            if open_at is not None and open_at >= 0:   # carry the open row into the next batch
                held, held_p, held_size = batch.slice(open_at, 1), p[open_at], size[open_at]
                done = pa.array([i != open_at for i in range(n)])
                yield _with_p(batch, at, p).filter(done)
            else:
                yield _with_p(batch, at, p)
        if held is not None:
            yield _with_p(held, at, [held_p])

    return run


def _with_p(batch, at, p):
    return batch.set_column(at, batch.schema.field(at), pa.array(p, pa.float64()))


def pivotal_copies(rows: DataFrame, source: str, size: str, expected: str, tie: list[str],
                   seed: int = 17, name: str = "copies") -> DataFrame:
    """``rows`` with an integer column ``name``: copies of each row, whose expectation is the
    column ``expected``.  ``tie``: columns that order rows of one size, and seed the draws."""
    bits = F.length(F.bin(F.col("_m_size")))
    size_class = F.when(F.col("_m_size") < 4, F.col("_m_size")).otherwise(
        4 * bits + F.expr("shiftright(_m_size, length(bin(_m_size)) - 3)").bitwiseAND(3))
    own = {"_m_source": F.col(source), "_m_size": F.col(size).cast("long"),
           "_m_whole": F.floor(F.col(expected)).cast("long")}
    tree = (rows.withColumns(own)
            .withColumns({"_m_p": F.col(expected) - F.col("_m_whole"),
                          "_m_class": size_class.cast("long"),
                          "_m_tie": F.xxhash64(F.lit(seed), F.col(size), *[F.col(c) for c in tie])})
            .withColumns({"_m_leaf": F.expr(f"shiftrightunsigned(_m_tie, {64 - LEAF_BITS})"),
                          "_m_u": F.lit(0.0)}))
    plan = [(["_m_source", "_m_class", "_m_leaf"], 0), (["_m_source", "_m_class", "_m_leaf"], FAN_BITS),
            (["_m_source", "_m_class"], 0), (["_m_source"], 0)]
    decided, rest = [], tree
    for level, (keys, shift) in enumerate(plan):
        u = F.expr("shiftrightunsigned(xxhash64(_m_tie, "
                   f"{seed * 31 + level}), 11)") / F.lit(float(1 << 53))
        step = rest.withColumns({"_m_u": u} | ({"_m_leaf": F.shiftright("_m_leaf", shift)} if shift else {}))
        step = step.repartition(*keys).sortWithinPartitions(
            "_m_source", F.desc("_m_class"), "_m_leaf", F.desc("_m_size"), "_m_tie")
        step = saved(step.mapInArrow(_round_runs(keys), step.schema), f"mix-level-{level}")
        open_row = (F.col("_m_p") > 0) & (F.col("_m_p") < 1)
        decided.append(step.filter(~open_row))
        rest = step.filter(open_row)
    # one fraction is left in a source whose expectation is not a whole number
    last = F.expr(f"shiftrightunsigned(xxhash64(_m_tie, {seed * 31 + len(plan)}), 11)") / F.lit(float(1 << 53))
    decided.append(rest.withColumn("_m_p", (last < F.col("_m_p")).cast("double")))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.withColumn(name, (F.col("_m_whole") + F.col("_m_p").cast("long")).cast("int")).drop(*_OWN)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with mix_size, its words, and mix_tie, a hash that orders texts of one size."""
    return docs.withColumns({"mix_size": n_words(F.col(text)), "mix_tie": F.xxhash64(F.col(text))})


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        share: float = SHARE, most: float = MOST_COPIES, weights: tuple = WEIGHTS,
        seed: int = 17) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies."""
    return mix_measured(measure(docs, text), source, doc_id, share, most, weights, seed).drop("mix_tie")


def mix_measured(sized: DataFrame, source: str = "source", doc_id: str = "doc_id", share: float = SHARE,
                 most: float = MOST_COPIES, weights: tuple = WEIGHTS, seed: int = 17) -> DataFrame:
    """As ``mix``, of rows that ``measure`` has been over; they need no text any more."""
    totals = sized.groupBy(F.col(source).alias("source")).agg(
        F.sum("mix_size").cast("long").alias("source_size"))
    targets = saved(source_targets(totals, share, most, weights), "mix-targets").select(
        F.col("source").alias("_mix_source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"))
    rows = join_on_small(sized, targets, sized[source].eqNullSafe(F.col("_mix_source"))).withColumn(
        "_mix_r", F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size"))
        .otherwise(0.0))
    return pivotal_copies(rows, source, "mix_size", "_mix_r", [doc_id, "mix_tie"], seed,
                          "mix_copies").drop("_mix_source", "_mix_r")
