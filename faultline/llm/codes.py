"""Vector code compression: product codes whose codebooks are fitted by exact rounds of assignment,
with norm-of-sum bounds in place of most of the distance work.

A vector becomes integers floor(scale * x) and is cut into equal parts; each part position has a
codebook.  A round assigns every part to its nearest entry (ties to the lower index) and replaces
each entry by the floored mean of its parts.  For every part a row keeps its code, a lower bound on
the distance to every *other* entry, and the number of the round in which that bound was measured.
All codebooks so far are kept as well, so a later round lowers the bound by the largest true net
displacement of another entry between the two rounds: the norm of the sum of its moves, never more
than the sum of their norms.  Only where the distance to the part's own entry is not below what
remains are all entries measured again.  Bounds are rounded so that a part passed over is proven to
keep its entry; results are those of full scans.

A round is one pass over the table of vectors and states in the shared folder; what moved is summed
inside the tasks, each of which adds one array of sums to its rows, and these arrays are added up by
position.  The driver holds codebooks only: rounds * entries * width integers.

Defined cases: rows whose vector is null or holds nulls, NaN or infinities are dropped.  The vectors'
width is a parameter; unset, it is the commonest one that can be cut into equal parts (ties: the
smaller).  Rows of another width, or with a component too large for exact 64-bit distances, have no
code and no error, and do not shape the codebooks.  With fewer rows than entries a codebook starts
with what there is; null ids come last, repeated ids in the order of their vectors.  An empty table
gives an empty result.  Only the id, the vector and the label are read; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import join_on_small, saved

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096

#: Relative slack that covers the rounding of a square root and of the bounds kept as floats.
_SLACK = 1e-6


def largest(width: int) -> int:
    """The largest component for which sums of ``width`` squared differences fit 62 bits."""
    return math.isqrt(2 ** 62 // max(width, 1)) // 2


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by entries, of integer rows to integer entries."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2 ** 53:        # every term and sum is an exact float
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """[round, part, entry]: the largest net displacement since that round of any other entry."""
    now = history[-1]
    out = np.zeros((len(history), *now.shape[:2]))
    for t, old in enumerate(history):
        moved = np.sqrt(((now - old).astype(np.float64) ** 2).sum(-1)) * (1 + _SLACK)
        for j in range(moved.shape[1]):
            out[t, :, j] = np.delete(moved, j, axis=1).max(1, initial=0)
    return out


def assign(x: np.ndarray, history: list[np.ndarray], drift: np.ndarray, code: np.ndarray | None,
           bound: np.ndarray | None, stamp: np.ndarray | None):
    """Codes, bounds, stamps and own squared distances of rows ``x`` [row, part, position] for the
    last codebooks of ``history``, and how many parts were measured against all entries."""
    n, parts, _ = x.shape
    now = history[-1]
    code = np.zeros((n, parts), np.uint8) if code is None else code.copy()
    fresh = bound is None
    bound = np.zeros((n, parts), np.float32) if fresh else bound.copy()
    stamp = np.zeros((n, parts), np.uint8) if stamp is None else stamp.copy()
    own = np.zeros((n, parts), np.int64)
    scanned = 0
    for p in range(parts):
        if fresh:
            again = np.arange(n)
        else:
            own[:, p] = ((x[:, p] - now[p][code[:, p]]) ** 2).sum(1)
            left = bound[:, p].astype(np.float64) - drift[stamp[:, p], p, code[:, p]]
            again = np.flatnonzero(np.sqrt(own[:, p].astype(np.float64)) * (1 + _SLACK) >= left)
        if not len(again):
            continue
        scanned += len(again)
        far = squared(x[again, p], now[p])
        best = far.argmin(1)                              # the first of equal ones: the lower index
        at = np.arange(len(again))
        code[again, p], own[again, p], stamp[again, p] = best, far[at, best], len(history) - 1
        if far.shape[1] > 1:
            far[at, best] = np.iinfo(np.int64).max
            bound[again, p] = np.sqrt(far.min(1).astype(np.float64)) * (1 - _SLACK)
        else:
            bound[again, p] = np.inf
    return code, bound, stamp, own, scanned


def _sums(x: np.ndarray, code: np.ndarray, sign: int, out: np.ndarray) -> None:
    """Adds to out[part, entry] the count and the component sums of the rows there."""
    for p in range(code.shape[1]):
        for j in np.unique(code[:, p]):
            here = code[:, p] == j
            out[p, j, 0] += sign * int(here.sum())
            out[p, j, 1:] += sign * x[here, p].sum(0)


def _pack(code, bound, stamp) -> pa.Array:
    rows = np.concatenate([code, stamp, bound.astype("<f4").view(np.uint8).reshape(len(code), -1)], axis=1)
    width = rows.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def _unpack(state: pa.Array, parts: int):
    raw = np.frombuffer(b"".join(state.to_pylist()), np.uint8).reshape(len(state), 6 * parts)
    return raw[:, :parts], np.ascontiguousarray(raw[:, 2 * parts:]).view("<f4"), raw[:, parts:2 * parts]


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1)


def whole(vec):
    """Whether a vector is there and all its components are finite numbers."""
    return vec.isNotNull() & F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def commonest_width(rows: DataFrame, vec: str, parts: int) -> int | None:
    sizes = rows.groupBy(F.size(vec).alias("w")).count().filter(f"w > 0 and w % {parts} = 0")
    top = sizes.orderBy(F.desc("count"), "w").first()
    return top["w"] if top else None


def compress(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, width: int | None = None,
             scans: list | None = None) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): rows of id, label, code (bytes, one entry index a part) and error (squared
    distance to the coded vector), and codebooks [part, entry, position].

    ``scans`` gets, per round, the number of parts that were measured against all entries.
    """
    if not 1 <= entries <= 256 or not 0 <= rounds <= 255:
        raise ValueError("codes and round stamps are single bytes: at most 256 entries and 255 rounds")
    rows = df.select(F.col(vec_id).alias("_id"), F.col(label).alias("_label"), F.col(vec).cast("array<double>").alias("_vec"))
    rows = rows.filter(whole(F.col("_vec")))
    width = width or commonest_width(rows, "_vec", parts)
    if width is not None and (width < 1 or width % parts):
        raise ValueError(f"vectors of width {width} cannot be cut into {parts} equal parts")
    most = largest(width or 0)
    fits = (F.size("_vec") == (width or -1)) & F.forall("_vec", lambda x: F.abs(x) < float(most // scale))
    kind = T.ArrayType(T.IntegerType() if most < 2 ** 31 else T.LongType())
    good = rows.filter(fits).withColumn("_vec", F.transform("_vec", lambda x: F.floor(x * scale).cast(kind.elementType)))
    fields = rows.schema.fields[:2]
    first = good.orderBy(F.col("_id").asc_nulls_last(), "_vec").limit(entries).collect()
    rest = rows.filter(~fits).select("_id", "_label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    if not first:
        return rest.withColumnsRenamed({"_id": vec_id, "_label": label}), np.zeros((parts, 0, 0), np.int64)
    history = [np.array([r["_vec"] for r in first], np.int64).reshape(len(first), parts, -1).swapaxes(0, 1)]
    k, part_width = history[0].shape[1:]
    totals = np.zeros(parts * k * (1 + part_width), object)
    state = good
    state_type = T.StructType([*fields, T.StructField("_vec", kind), T.StructField("_state", T.BinaryType()),
                               T.StructField("_sums", T.ArrayType(T.LongType())), T.StructField("_scans", T.LongType())])

    def one_pass(seen: list[np.ndarray], last: bool):
        drift = displacements(seen)

        def run(batches):
            held, sums, scanned = None, np.zeros((parts, k, 1 + part_width), np.int64), 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(2), parts)
                old = _unpack(batch.column(3), parts) if len(seen) > 1 else (None, None, None)
                code, bound, stamp, own, n = assign(x, seen, drift, *old)
                scanned += n
                if last:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary()),
                                                      pa.array(own.sum(1), pa.int64())], names=["_id", "_label", "code", "error"])
                    continue
                if old[0] is None:
                    _sums(x, code, 1, sums)
                else:                                    # only what moved changes the sums
                    moved = np.flatnonzero((old[0] != code).any(1))
                    _sums(x[moved], old[0][moved], -1, sums)
                    _sums(x[moved], code[moved], 1, sums)
                if held:
                    yield _state_batch(*held, None, None)
                held = batch, _pack(code, bound, stamp)
            if held:
                yield _state_batch(*held, sums.ravel(), scanned)
        return run

    for t in range(rounds):
        state = saved(state.mapInArrow(one_pass(list(history), False), state_type), f"codes-{t}")
        if scans is not None:
            scans.append(state.agg(F.sum("_scans")).first()[0])
        added = (state.filter("_sums is not null").select(F.posexplode("_sums"))
                 .groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect())
        for r in added:
            totals[r["pos"]] += int(r["s"])
        history.append(_means(history[-1], totals.reshape(parts, k, -1)))
    final = T.StructType([*fields, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    coded = state.mapInArrow(one_pass(list(history), True), final)
    return coded.unionByName(rest).withColumnsRenamed({"_id": vec_id, "_label": label}), history[-1]


def _state_batch(batch, state, sums, scanned) -> pa.RecordBatch:
    """The batch with its new states; the sums of a task stand in the first row of its last batch."""
    n = batch.num_rows
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), batch.column(2), state,
         pa.array([None if sums is None else sums.tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
         pa.array([scanned] + [None] * (n - 1), pa.int64())],
        names=["_id", "_label", "_vec", "_state", "_sums", "_scans"])


def _means(now: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Floored means; an entry without parts stays."""
    out = now.copy()
    for p in range(now.shape[0]):
        for j in range(now.shape[1]):
            count, *sums = totals[p, j]
            if count:
                out[p, j] = [int(s) // int(count) for s in sums]
    return out


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``: the error summed over the rows of equal labels, null labels together.  A
    label of many rows is summed in its tasks first; labels come back by a join."""
    sums = coded.groupBy(F.col(label).alias("_of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return join_on_small(coded, sums, F.col(label).eqNullSafe(F.col("_of")), "left").drop("_of")


def codebook_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components as decimals by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
