"""Isotonic regression as a mergeable reduction.

Scores are reduced to one weighted row per distinct value.  Pooling adjacent violators may go in any
order, so each range of scores is pooled by itself and the blocks that are left are pooled again, some
neighbouring ranges at a time, until one range holds all.  Blocks carry counts and sums as integers;
violations are compared by cross products, so the result is that of pooling the whole sequence in one
pass, to the last bit.

Blocks of 0/1 labels are the edges of a convex chain between lattice points (the running counts of
rows and of positives), so n rows leave fewer than 4 * n^(2/3) of them: under 4,000 of 30,000 rows,
under 4 million of a billion.  That bounds what the last step and the curve hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.plans.prefix import prefix_sums
from faultline.session import materialize

#: Ranges pooled together in a step, and the knots up to which a curve is sent to the tasks (16 bytes
#: each); a longer one is met by a join.
FAN_IN = 32
MOST_KNOTS = 2_000_000


def _pooled(df: DataFrame, g: list[str]) -> DataFrame:
    """Blocks of each group's rows inside each partition, which is in the order of (group, lo)."""
    kinds = [df.schema[c] for c in g]
    schema = T.StructType([*kinds, *[T.StructField(c, T.DoubleType()) for c in ("lo", "hi")],
                           *[T.StructField(c, T.LongType()) for c in ("w", "s")], T.StructField("__range", T.LongType())])

    def push(blocks: list[tuple], lo, hi, w: int, s: int) -> None:
        """Appends a row to blocks of strictly increasing means, and pools what violates."""
        while blocks and blocks[-1][3] * w >= s * blocks[-1][2]:
            lo, _, w0, s0 = blocks.pop()
            w, s = w + w0, s + s0
        blocks.append((lo, hi, w, s))

    def run(batches):
        key, held = None, []

        def done(like):
            cols = [pa.array([k] * len(held), t) for k, t in zip(key[:-1], like[:len(g)])]
            cols += [pa.array(c, t) for c, t in zip(zip(*held), (pa.float64(), pa.float64(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays([*cols, pa.array([key[-1]] * len(held), pa.int64())], names=schema.names)
        types = None
        for batch in batches:
            types = [c.type for c in batch.columns]
            columns = [c.to_pylist() for c in batch.columns]
            for *k, lo, hi, w, s, r in zip(*columns):
                if (*k, r) != key:
                    if held:
                        yield done(types)
                    key, held = (*k, r), []
                push(held, lo, hi, w, s)
        if held:
            yield done(types)
    return df.select(*g, "lo", "hi", "w", "s", "__range").mapInArrow(run, schema)


def isotonic_blocks(scores: DataFrame, group_cols: list[str] | None = None, y: str = "y", p: str = "p",
                    counted: tuple[str, str] | None = None) -> DataFrame:
    """(group..., lo, hi, w, s): the blocks of the increasing curve through (p, y), w rows and s positives
    each.  Rows without a score or a label are left out.  ``counted`` names columns that hold rows and
    positives already counted."""
    g = list(group_cols or [])
    known = scores.where(F.col(p).isNotNull() & (F.lit(True) if counted else F.col(y).isNotNull()))
    w, s = (F.sum(counted[0]), F.sum(counted[1])) if counted else (F.count(F.lit(1)), F.sum(F.col(y).cast("long")))
    rows = known.groupBy(*g, F.col(p).cast("double").alias("lo")).agg(w.alias("w"), s.alias("s"))
    ranged = (rows.repartitionByRange(*g, "lo").sortWithinPartitions(*g, "lo")
              .select(*g, "lo", F.col("lo").alias("hi"), "w", "s", F.spark_partition_id().cast("long").alias("__range")))
    blocks = materialize(_pooled(ranged, g), "isotonic")
    ranges = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while ranges > 1:
        ranges = -(-ranges // FAN_IN)
        near = blocks.withColumn("__range", F.floor(F.col("__range") / FAN_IN))
        near = near.repartition(ranges, *g, "__range") if g or ranges > 1 else near.repartition(1)
        blocks = materialize(_pooled(near.sortWithinPartitions(*g, "__range", "lo"), g), "isotonic")
    return blocks.drop("__range")


def knots(blocks: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """(group..., x, v): the curve's corners; it is level inside a block and straight between blocks."""
    g = list(group_cols or [])
    v = F.col("s") / F.col("w")
    return blocks.select(*g, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x"), v.alias("v"))


def isotonic_apply(blocks: DataFrame, scores: DataFrame, group_cols: list[str] | None = None, p: str = "p",
                   most_knots: int = MOST_KNOTS) -> DataFrame:
    """``scores`` with ``p`` put through its group's curve: linear between corners, level outside them;
    NULL for a group without a curve."""
    g = list(group_cols or [])
    curve = knots(blocks, g)
    if curve.limit(most_knots + 1).count() > most_knots:
        return _apply_by_join(curve, scores, g, p)
    held: dict[tuple, list] = {}
    for r in curve.collect():                          # at most most_knots rows
        held.setdefault(tuple(r[:len(g)]), []).append((r["x"], r["v"]))
    curves = {k: tuple(np.array(sorted(x)).T) for k, x in held.items()}
    shared = scores.sparkSession.sparkContext.broadcast(curves)
    out = scores.withColumn(p, F.col(p).cast("double"))

    def run(batches):
        for batch in batches:
            x = batch.column(batch.schema.get_field_index(p))
            x = x.to_numpy(zero_copy_only=False).astype(np.float64)
            new = np.full(len(x), np.nan)
            rows: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in g])):
                rows.setdefault(key, []).append(i)
            for key, mine in rows.items() if g else [((), slice(None))]:
                if key in shared.value:
                    new[mine] = np.interp(x[mine], *shared.value[key])
            new[np.isnan(x)] = np.nan
            i = batch.schema.get_field_index(p)
            yield batch.set_column(i, batch.schema.names[i], pa.array(new, pa.float64(), from_pandas=True))
    return out.mapInArrow(run, out.schema)


def _apply_by_join(curve: DataFrame, scores: DataFrame, g: list[str], p: str) -> DataFrame:
    """The same with a curve of any length: a running count of the corners up to each distinct score
    numbers the corner on its left, and two equality joins bring both neighbours."""
    corners = curve.select(*g, F.col("x").alias("__x"), F.lit(0).alias("__kind"), F.lit(1).cast("long").alias("__c"), "v")
    asked = scores.where(F.col(p).isNotNull()).select(*g, F.col(p).cast("double").alias("__x")).distinct()
    both = corners.unionByName(asked.select("*", F.lit(1).alias("__kind"), F.lit(0).cast("long").alias("__c"), F.lit(None).cast("double").alias("v")))
    placed = materialize(prefix_sums(both, ["__x", "__kind"], ["__c"], g), "corners")
    names = [f"__g{i}" for i in range(len(g))]
    corner = placed.where("__kind = 0").select(*[F.col(c).alias(n) for c, n in zip(g, names)], F.col("cum___c").alias("__at"), F.col("__x").alias("__cx"), F.col("v").alias("__cv"))
    found = placed.where("__kind = 1").select(*g, "__x", "cum___c")
    for side, at in (("l", F.col("cum___c")), ("r", F.col("cum___c") + 1)):
        near = corner.withColumnsRenamed({"__at": f"__{side}at", "__cx": f"__{side}x", "__cv": f"__{side}v", **{n: f"{n}{side}" for n in names}})
        on = at == F.col(f"__{side}at")
        for c, n in zip(g, names):
            on = on & F.col(c).eqNullSafe(F.col(f"{n}{side}"))
        found = found.join(near, on, "left")
    value = F.when(F.col("__lx").isNull(), F.col("__rv")).when(F.col("__rx").isNull(), F.col("__lv")).otherwise(
        (F.col("__rv") - F.col("__lv")) / (F.col("__rx") - F.col("__lx")) * (F.col("__x") - F.col("__lx")) + F.col("__lv"))
    found = found.select(*[F.col(c).alias(n) for c, n in zip(g, names)], F.col("__x").alias("__p"), value.alias("__new"))
    on = F.col(p).cast("double") == F.col("__p")
    for c, n in zip(g, names):
        on = on & F.col(c).eqNullSafe(F.col(n))
    return scores.join(found, on, "left").select(*[F.col("__new").alias(p) if c == p else F.col(f"`{c}`") for c in scores.columns])
