"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint has one bit per position that is set in over half the hashes (XXH64, seed 42) of a
text's word shingles.  Two fingerprints link if at most ``max_bits`` bits differ.  The 64 bits are
cut into ``max_bits // 2 + 1`` segments, so that in one of them at most one bit differs; each
segment is indexed once per bit with that bit left out, so such a pair meets in an equality join
on (left-out bit, rest of the segment), and the full distance is verified in the join.

No group lists all its pairs: fingerprints are distinct before the join; each bucket first links
its members to a few pivots (linear), and the components of these links are taken.  The join then
looks for links between different components only; pairs inside one are connected already.
Components come from alternating large-star and small-star rounds, each written to the shared
folder.

Defined cases: a null or empty text has the fingerprint zero and links like any other; a text of
fewer words than a shingle is one shingle; equal rows and equal texts share a fingerprint; a null
doc_id takes part but names a component only if it has no other id (component null); an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import folded_words, join_on_small, saved

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Members of a bucket that all its members are compared with first.
PIVOTS = 6


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    words = folded_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    body, at = b" ".join(words), np.empty(len(words) + 1, np.int64)
    at[0] = 0
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    start = at[:n].tolist()
    end = (at[min(shingle_words, len(words)):][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(body[s:e], seed) for s, e in zip(start, end)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):                    # bounded memory for very long texts
        part = hashes[k:k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", name: str = "_fp",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with a long column holding the 64 bits; other columns are passed through."""
    docs = docs.drop(name)                             # an old column of that name is replaced
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))],
                                             names=[*batch.schema.names, name])
    return docs.mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``fps`` (fp and others) with (bit, rest): the signatures of each
    fingerprint, 64 rows each.  ``bit`` is the position left out and names its segment, ``rest``
    the segment without it."""
    n = max_bits // 2 + 1
    edges = [64 * k // n for k in range(n + 1)]
    masks = []
    for lo, hi in zip(edges, edges[1:]):
        masks += [((1 << hi) - (1 << lo)) & ~(1 << bit) for bit in range(lo, hi)]
    array = F.array(*[F.struct(F.lit(bit).cast("byte").alias("bit"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("rest"))
                      for bit, m in enumerate(masks)])
    return fps.select("*", F.explode(array).alias("v")).select(*fps.columns, "v.bit", "v.rest")


def _differ(x, y) -> F.Column:
    return F.bit_count(x.bitwiseXOR(y))


def star_links(fps: DataFrame, max_bits: int = MAX_BITS, pivots: int = PIVOTS) -> DataFrame:
    """(a, b): each fingerprint with those of its buckets' pivots that are within ``max_bits``.

    A pivot is the member of least hash, for ``pivots`` hashes; a bucket of n members gives
    n * pivots rows at most, and in a dense group nearly all members meet one pivot or another."""
    bucket = Window.partitionBy("bit", "rest")
    chosen = F.array(*[F.min(F.struct(F.xxhash64("fp", F.lit(k)).alias("h"), "fp")).over(bucket)["fp"] for k in range(pivots)])
    # dealt out before the hashes are taken, so that only signatures are shuffled
    index = variants(fps.select("fp"), max_bits).repartition("bit", "rest")
    return (index.withColumn("pivots", F.when(F.count(F.lit(1)).over(bucket) > 1, chosen))
            .filter("pivots is not null")
            .select("fp", F.array_distinct(F.filter("pivots", lambda p: (p != F.col("fp")) & (_differ(p, F.col("fp")) <= max_bits))).alias("met"))
            .filter(F.size("met") > 0).select(F.col("fp").alias("a"), F.explode("met").alias("b")).distinct())


def cross_links(grouped: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) -> (a, b): all links between fingerprints of different roots.

    Only buckets with several roots are looked at, and there only pairs with a member outside the
    bucket's largest group, so that a group's own pairs are neither listed nor met."""
    bucket = Window.partitionBy("bit", "rest")
    sizes = grouped.groupBy("root").agg(F.count(F.lit(1)).cast("int").alias("size"))
    # most fingerprints are their own root, which need not be shuffled with each signature
    narrow = grouped.join(sizes, "root").select("fp", F.when(F.col("root") != F.col("fp"), F.col("root")).alias("root"), "size")
    index = variants(narrow, max_bits).repartition("bit", "rest").withColumn("root", F.coalesce("root", "fp"))
    index = saved(index.withColumns({"least": F.min("root").over(bucket), "most": F.max("root").over(bucket),
                                     "top": F.max(F.struct("size", "root")).over(bucket)["root"]})
                  .filter("least <> most").select("bit", "rest", "fp", "root", "top"), "simhash-mixed")
    left = index.filter("root <> top").select("bit", "rest", F.col("fp").alias("a"), F.col("root").alias("a_root"))
    right = index.select("bit", "rest", F.col("fp").alias("b"), F.col("root").alias("b_root"), (F.col("root") == F.col("top")).alias("b_top"))
    return left.hint("merge").join(right, (left.bit == right.bit) & (left.rest == right.rest) & (F.col("a_root") != F.col("b_root"))
                                   & (F.col("b_top") | (F.col("a") < F.col("b")))
                                   & (_differ(F.col("a"), F.col("b")) <= max_bits)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): the smallest node of each connected component, for every node.

    Large-star: a node's larger neighbours move to its smallest; small-star: its smaller
    neighbours and itself do.  Rounds go on until the edges stay as they are, which they do when
    each node points at its root."""
    def state(df):
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        return row[0], row[1]

    def star(df, large: bool):
        both = df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else df
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("m", "a").alias("m"))
        moved = both.join(least, F.col("a") == F.col("n"))
        if large:
            out = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return out.filter(F.col("a") != F.col("b")).distinct()

    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = state(now)
    while before[0]:
        now = saved(star(star(now, True), False), "cc")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def labelled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    return _rooted(docs, doc_id, text, shingle_words, max_bits).drop("root")


def _rooted(docs: DataFrame, doc_id: str, text: str, shingle_words: int, max_bits: int) -> DataFrame:
    """(doc_id, fp, component_id, root): the root tells components apart."""
    rows = saved(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "fp",
                              shingle_words).drop("text"), "simhash-fp")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")

    def group(edges):
        roots = components(edges)
        return saved(distinct.join(roots, distinct.fp == roots.node, "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-groups")
    stars = saved(star_links(distinct, max_bits), "simhash-stars")
    cross = cross_links(group(stars), max_bits)
    rooted = group(stars.unionByName(cross))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = rooted.join(least, "root").select(F.col("fp").alias("n_fp"), "component_id", "root")
    return rows.join(names, rows.fp == F.col("n_fp")).select("doc_id", "fp", "component_id", "root")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id.  Where several rows of a
    component have this id, or none has an id, the one with the least fingerprint stays; an id on rows
    of several components stays in each that it is the smallest of."""
    found = saved(_rooted(docs, doc_id, text, shingle_words, max_bits), "simhash-labelled")
    stay = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.first("component_id").alias("_id"), F.min("fp").alias("_fp")))
    stay = saved(stay.select("_id", "_fp"), "simhash-stay")
    often = saved(found.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").select(F.col("doc_id").alias("_often")), "simhash-often")
    # an id of one row names it; only rows of other ids and of none are looked at by fingerprint
    once = stay.filter("_id is not null").join(often, F.col("_id") == F.col("_often"), "left_anti")
    named = docs.join(once, docs[doc_id] == F.col("_id"), "left_semi")
    again = docs.filter(F.col(doc_id).isNull()).unionByName(join_on_small(docs, often, docs[doc_id] == F.col("_often"), "left_semi"))
    again = fingerprints(again, text, "_own", shingle_words)
    again = again.join(stay, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_fp")), "left_semi")
    return named.unionByName(again.dropDuplicates([doc_id, "_own"]).drop("_own"))
