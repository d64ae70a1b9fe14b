"""Quality rules: counted rules first, then a logistic regression on hashed n-grams.

Features are the word uni- and bigrams and the 3- and 4-grams of characters, hashed into 2 ** BITS
buckets; a feature's value is its share of the text's n-grams of that family.  The regression is
fitted on labelled rows, its scores are calibrated by a logistic curve on rows held out from the
fit, and every text is scored in Arrow batches against a fixed probability.

The fit uses at most ``max_rows`` labelled texts, one an id, and of each at most ``max_features``
buckets, whose values are scaled up by what is left out (both bounds are parameters; ids and buckets
are chosen by hashes); so at most 8 * max_rows * max_features bytes reach the driver.  Everything else
covers all rows and whole texts.

Defined cases: a null or empty text has no words and fails the counted rules; labels other than
0 and 1, and labels without a document, are left out, of repeated labels the lowest counts;
without labels of both kinds the counted rules alone decide; an empty table gives an empty result;
other columns are passed through.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the counted rules
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

BITS = 18
MAX_ROWS = 4000
MAX_FEATURES = 8192
#: Gradient steps of a fit, five rounds over the rows at least.
STEPS = 15_000
#: A text stays if its calibrated probability of good quality is at least this.
KEEP_FROM = 0.3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(ids: np.ndarray, width: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of ``width`` words which occurs more than once."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    # a hash that differs proves windows different, so texts without equal hashes are done
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n].astype(np.uint64) + np.uint64(1)
    order = np.sort(mixed)
    if not (order[1:] == order[:-1]).any():
        return 0
    # exact ranks of windows of 2, 4, ... words: pairs of ranks of the halves
    rank, size = ids.astype(np.int64), 1
    while size < width:
        pair = rank[:-size] * (int(rank.max()) + 1) + rank[size:]
        rank, size = np.unique(pair, return_inverse=True)[1].astype(np.int64), size * 2
    twice = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def counts(text: str | None, body: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The values of COUNTS for a text."""
    if not words:
        return 0, 0, 0 if text is None else sum(text.count(c) for c in SYMBOLS), 0, 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines = [x for x in body.split(b"\n") if x and not x.isspace()]
    return (len(words), len(text) - len(body) + sum(map(len, words)), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated_words(ids))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


def families(text: str, words: list[bytes], bits: int = BITS) -> list[np.ndarray]:
    """Hash buckets of each n-gram of a text, by family."""
    drop = np.uint64(64 - bits)

    def bucket(x, salt):
        return (((x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)) >> drop).astype(np.int32)

    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    a = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)       # code points, 21 bits each
    three = (a[:-2] << np.uint64(42)) | (a[1:-1] << np.uint64(21)) | a[2:]
    four = three[:-1] * np.uint64(0x100000001B3) + a[3:]
    # a word followed by itself is one bigram whatever the word, so that stutter can be learnt
    pair = np.where(one[:-1] == one[1:], np.uint64(0), one[:-1] * np.uint64(0x100000001B3) + one[1:])
    return [bucket(one, 1 << 40), bucket(pair, 2 << 40),
            bucket(three, 3 << 40), bucket(four, 4 << 40)]


@dataclass
class Model:
    """Weights by hash bucket, and the calibration of the raw score: probability that quality is 1."""
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    bits: int = BITS

    def raw(self, text: str, words: list[bytes]) -> float:
        return sum(float(self.weights[f].mean()) for f in families(text, words, self.bits) if len(f))

    def probability(self, text: str, words: list[bytes]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.raw(text, words) + self.offset, -60, 60))))


def _sparse(text: str, words: list[bytes], bits: int, most: int = MAX_FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text; beyond ``most`` buckets a part chosen by hash, scaled up."""
    parts = [f for f in families(text, words, bits) if len(f)]
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    where, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    value = np.bincount(inverse, np.concatenate([np.full(len(f), 1 / len(f)) for f in parts]))
    if len(where) > most:
        salt = np.uint64(zlib.crc32(words[0])) if words else np.uint64(0)
        some = np.sort(np.argsort((where.astype(np.uint64) + salt) * np.uint64(0x9E3779B97F4A7C15), kind="stable")[:most])
        where, value = where[some], value[some] * (len(where) / most)
    return where.astype(np.int32), value.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_ROWS, bits: int = BITS, steps: int = STEPS, max_features: int = MAX_FEATURES) -> Model | None:
    """A calibrated model, or None without labels of both kinds."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("_y")))
    # the labels chosen: at most max_rows narrow rows, so the join may broadcast them
    chosen = known.orderBy(F.xxhash64("_id", F.lit(7)), "_id").limit(max_rows)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    schema = "_id long, _y int, _hash long, _where array<int>, _value array<float>"

    def featurise(batches):
        # an id of many rows has one text, that of the least hash, and sends one row a task
        best: dict[int, tuple] = {}
        for batch in batches:
            for i, y, h, t in zip(*(c.to_pylist() for c in batch.columns)):
                if i not in best or h < best[i][1]:
                    best[i] = y, h, *_sparse(t or "", (t or "").encode().split(), bits, max_features)
        if best:
            y, h, where, value = zip(*best.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(best, pa.int64()), pa.array(y, pa.int32()), pa.array(h, pa.int64()),
                 pa.array(where, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                names=["_id", "_y", "_hash", "_where", "_value"])
    texts = rows.select(F.col("_id").cast("long"), "_y", F.xxhash64("_text").alias("_hash"), "_text").mapInArrow(featurise, schema)
    one = texts.groupBy("_id").agg(F.min_by(F.struct("_y", "_where", "_value"), "_hash").alias("r"))
    got = one.select("_id", "r.*").toArrow().combine_chunks()
    order = np.argsort(np.array(got["_id"].to_pylist(), np.int64), kind="stable").tolist()
    y = np.array(got["_y"].to_pylist(), np.float64)[order] if order else np.empty(0)
    if len(set(y)) < 2:
        return None
    # rows are slices of the two flat columns, not copies: the driver holds the sample once
    where, value = (got[c].chunk(0) for c in ("_where", "_value"))
    ends = where.offsets.to_numpy()
    where, value = where.values.to_numpy(), value.values.to_numpy()
    model = train([(where[ends[i]:ends[i + 1]], value[ends[i]:ends[i + 1]]) for i in order], y, bits, steps)
    del got, where, value, ends
    pa.default_memory_pool().release_unused()
    return model


def train(data: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, bits: int = BITS, steps: int = STEPS,
          rate: float = 0.6, decay: float = 1e-6) -> Model:
    """Logistic regression by adaptive gradient steps; every fourth row only calibrates.

    The classes count alike in the fit, so that a rare class shapes the weights; the calibration
    sees them as they come."""
    rng = np.random.default_rng(7)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    w, g = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
    share = np.array([max((y[~held] == c).mean(), 1e-9) for c in (0, 1)])
    at = np.flatnonzero(~held)
    for _ in range(max(5, -(-steps // max(len(at), 1)))):  # a few rows are gone over more often
        for i in rng.permutation(at):
            where, value = data[i]
            z = float(w[where] @ value)
            step = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[i]) * 0.5 / share[int(y[i])] * value + decay * w[where]
            g[where] += step * step
            w[where] -= rate * step / np.sqrt(g[where])
    check = np.flatnonzero(held) if held.any() else at
    z = np.array([float(w[data[i][0]] @ data[i][1]) for i in check])
    slope, offset = platt(z, y[check])
    return Model(w.astype(np.float32), slope, offset, bits)


def platt(z: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (z, y), by Newton steps; Platt's smoothed
    targets keep it finite where the classes separate."""
    up, down = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(float(np.abs(z).max()), 1e-12)
    x = np.stack([z / scale, np.ones_like(z)], axis=1)
    b = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p))
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0] / scale), float(b[1])


def assess(docs: DataFrame, model: Model | None, text: str = "text", keep_from: float = KEEP_FROM,
           prefix: str = "") -> DataFrame:
    """``docs`` with the columns COUNTS, base_failed, quality_score and kept (names prefixed)."""
    names = [*COUNTS, "base_failed", "quality_score", "kept"]
    docs = docs.drop(*[prefix + n for n in names])     # old columns of these names are replaced
    kinds = [T.LongType()] * len(COUNTS) + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(prefix + n, k) for n, k in zip(names, kinds)]])
    # 2 ** bits floats, as plain values that executors read without this package
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()) if model else None)

    def run(batches):
        model = Model(*shared.value) if shared.value else None
        for batch in batches:
            rows = []
            for t in batch.column(batch.schema.get_field_index(text)):
                t = t.as_py()
                body = (t or "").encode()
                words = body.split()
                found = counts(t, body, words)
                failed = base_failed(found[0], found[4])
                p = model.probability(t or "", words) if model else None
                rows.append((*found, failed, p, not failed and (p is None or p >= keep_from)))
            made = list(zip(*rows)) or [()] * len(names)
            types = [pa.int64()] * len(COUNTS) + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, k) for c, k in zip(made, types)]],
                                             names=[*batch.schema.names, *[prefix + n for n in names]])
    return docs.mapInArrow(run, schema)
