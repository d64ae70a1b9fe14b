"""Exact k nearest binary codes by incremental multi-index hashing (Norouzi, Punjani and Fleet).

A vector's code has the sign of each component as a bit.  Codes are cut into m segments of
``segment_bits`` bits and indexed by (segment, value).  Round r looks up, for each open query,
all segment values at exactly r flipped bits.  After round r every code within m * (r + 1) - 1
bits has been met, since some segment of such a code differs by r bits at most; a query is closed
once its k-th verified distance is within that bound.  Rounds go on until no query is open, at
the latest when whole segments have been flipped, so the result is exact.

Only distinct codes are indexed and met; a code's ids are attached afterwards, the k + 1 smallest
of them, which are all that k answers can need.  The k-th distance to a bounded sample of codes
limits from above what can be an answer; the join tests it, so that no other pair is produced.
``segment_bits`` should be about log2 of the number of codes: 16 up to 10^6, 32 beyond 10^8.

Defined cases: codes of one width are searched, a parameter or else the commonest one (of equally
common ones the smaller); a warning counts the vectors of other widths, which have no distance to
these.  Rows without id or with a null vector are not indexed; a null component is a zero bit; repeated rows count once; a query is not
its own answer; ties go to the smaller id; fewer than k other codes are all returned; an empty
table gives an empty result.
"""

from __future__ import annotations

import warnings
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import saved

SEGMENT_BITS = 16
SAMPLE = 1000


def codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
          width: int | None = None) -> tuple[DataFrame, int, int]:
    """(id, code) of distinct rows, the code as an array of 64-bit words; the number of bits; and how
    many rows have an id and a vector, but of another width."""
    there = vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull())
    sizes = there.groupBy(F.size(embedding).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    of = F.lit(width) if width is not None else F.lit(None).cast("int")
    row = sizes.agg(F.min(F.struct((-F.col("n")).alias("n"), "w"))["w"].alias("w"), F.sum("n").alias("n"),
                    F.sum(F.when(F.col("w") == of, F.col("n"))).alias("mine"), (-F.min(-F.col("n"))).alias("most")).first()
    bits = width if width is not None else row["w"] or 0
    others = (row["n"] or 0) - ((row["mine"] if width is not None else row["most"]) or 0)
    words = [F.aggregate(F.slice(embedding, 64 * j + 1, 64), F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, 1)
                         .bitwiseOR(F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long"))) for j in range((bits + 63) // 64)]
    rows = there.filter((F.size(embedding) == bits) & F.lit(bits > 0))
    code = F.array(*words) if words else F.array(F.lit(0).cast("long"))
    return rows.select(F.col(vec_id).alias("id"), code.alias("code")).distinct(), bits, others


def _distance(a, b, n_words: int) -> F.Column:
    total = F.lit(0)
    for j in range(n_words):
        total = total + F.bit_count(a[j].bitwiseXOR(b[j]))
    return total


def _segment(code, j: int, width: int) -> F.Column:
    return F.shiftrightunsigned(code[j * width // 64], j * width % 64).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long"))


def nearest(vectors: DataFrame, queries, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
            segment_bits: int = SEGMENT_BITS, width: int | None = None) -> DataFrame:
    """(query_id, rank, id, distance) for the rows that the condition ``queries`` on ``id`` selects."""
    if 64 % segment_bits:
        raise ValueError("segment_bits must divide 64")
    rows, bits, others = codes(vectors, vec_id, embedding, width)
    if others:
        warnings.warn(f"{others} vectors are not of {bits} components and left out of the search", stacklevel=2)
    rows = saved(rows, "mih-codes")
    n_words, m = max(1, (bits + 63) // 64), -(-bits // segment_bits) or 1
    # a code's k + 1 smallest ids: one of them may be the query itself.  Spark limits the groups
    # before it shuffles them, so a code that very many rows share costs little
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).filter(F.col("n") <= k + 1)
    ids = saved(ranked.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "mih-ids")
    index = saved(ids.select("code", "ids", F.posexplode(F.array(*[_segment(F.col("code"), j, segment_bits) for j in range(m)]))
                             .alias("segment", "value")), "mih-index")
    # the k-th distance to at most SAMPLE codes, for each query
    sample = [r[0] for r in ids.select("code").orderBy(F.xxhash64("code"), "code").limit(SAMPLE).collect()]
    sample_column = F.array(*[F.array(*[F.lit(w).cast("long") for w in c]) for c in sample]) if sample else None
    open_ = rows.filter(queries(F.col("id"))).select(F.col("id").alias("query_id"), F.col("code").alias("q_code"))
    # one of the sample may be the query itself, hence one further
    far = F.lit(bits) if len(sample) < k + 1 else F.element_at(F.sort_array(
        F.transform(sample_column, lambda c: _distance(F.col("q_code"), c, n_words))), k + 1)
    open_ = saved(open_.withColumn("limit", far.cast("int")), "mih-queries")
    best, closed = None, None
    for r in range(segment_bits + 1):
        masks = F.array(*[F.lit(sum(1 << b for b in flips) - (1 << 64 if sum(1 << b for b in flips) >= 1 << 63 else 0)).cast("long")
                          for flips in combinations(range(segment_bits), r)])
        probes = (open_.select("query_id", "q_code", "limit", F.posexplode(
            F.array(*[_segment(F.col("q_code"), j, segment_bits) for j in range(m)])).alias("segment", "own"))
            .select("query_id", "q_code", "limit", "segment", F.explode(masks).alias("mask"), "own")
            .withColumn("value", F.col("own").bitwiseXOR(F.col("mask"))).drop("own", "mask"))
        near = _distance(F.col("q_code"), F.col("code"), n_words)
        met = (probes.hint("merge").join(index, (probes.segment == index.segment) & (probes.value == index.value) & (near <= F.col("limit")))
               .select("query_id", "q_code", "limit", "code", "ids", near.cast("int").alias("distance"))
               .dropDuplicates(["query_id", "q_code", "code"]))
        found = met.select("query_id", "q_code", "limit", "distance", F.explode("ids").alias("id")).filter("id <> query_id")
        if best is not None:
            found = found.unionByName(best.join(open_.select("query_id", "q_code"), ["query_id", "q_code"], "left_semi")).dropDuplicates(["query_id", "q_code", "id", "distance"])
        order = Window.partitionBy("query_id", "q_code").orderBy("distance", "id")
        best = saved(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank"), f"mih-best-{r}")
        bound = m * (r + 1) - 1
        state = best.groupBy("query_id", "q_code").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("kth"))
        state = open_.join(state, ["query_id", "q_code"], "left").select(
            "query_id", "q_code", F.when(F.col("n") >= k, F.least("limit", "kth")).otherwise(F.col("limit")).alias("limit"),
            (F.coalesce(F.col("n") >= k, F.lit(False)) & (F.col("kth") <= bound) | F.lit(r == segment_bits or bound >= bits)).alias("done"))
        state = saved(state, f"mih-state-{r}")
        ended = best.join(state.filter("done").select("query_id", "q_code"), ["query_id", "q_code"], "left_semi")
        closed = ended if closed is None else closed.unionByName(ended)
        open_ = state.filter("not done").drop("done")
        if open_.isEmpty():
            break
        best = best.drop("limit").join(open_, ["query_id", "q_code"]).select(best.columns)
    order = Window.partitionBy("query_id", "q_code").orderBy("distance", "id")
    return closed.select("query_id", F.row_number().over(order).alias("rank"), "id", "distance")
