"""Runs of repeated phrases by internal pattern matching over the words of whole texts.

A run is a stretch of consecutive words with smallest period q, at least LEAST_TIMES periods and
LEAST_WORDS words long, that no neighbouring word extends with the same period.  The words of a
chunk of texts, each text closed by a separator of its own, get

* ranks of all dyadic blocks by prefix doubling (only blocks that still have an equal are sorted
  again), which end in a suffix array where equal blocks of every size are neighbours;
* a wavelet matrix over that array, which answers range successors: the next occurrence of a block
  at or after a position.

A run of period q holds, within its first words, an aligned block of B words, B the largest power
of two up to (3q + 1) / 2, whose copy q words on is in the run as well; such q lie in a window shorter
than B.  So each aligned block that occurs more than once asks for its occurrences in that window.
They form an arithmetic progression.  One or two occurrences are candidate periods themselves; three
or more mean that the block itself has the progression's difference as its period, and then the run's
period is the distance between the ends of the two stretches of that difference, around the block and
around its copies.  Candidates are widened in both directions by comparing block ranks and kept if
they are runs; of equal stretches the smallest period stays.

Texts are independent of each other: a task forms chunks of about CHUNK_WORDS words of whole texts,
a longer text is a chunk.  A chunk needs some 8 * log2(words) bytes a word.

Defined cases: a null, empty or blank text has no words and no runs, and collapses to the empty
text; repeated rows are worked out each; an empty table gives an empty result; other columns are
passed through, old columns of the added names are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: the least run
LEAST_WORDS = 6
LEAST_TIMES = 4

CHUNK_WORDS = 1 << 17

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


class Blocks:
    """Ranks of the blocks of 1, 2, 4 ... words of ``ids``, and the suffix array by those blocks.

    ``ids`` must end every text with an id that occurs once, so that no two blocks across a border
    are equal.  A rank is the first place, in the suffix array, of the blocks equal to this one.
    """

    def __init__(self, ids: np.ndarray, largest: int):
        n = len(ids)
        self.order = np.argsort(ids, kind="stable").astype(np.int32)
        rank = np.empty(n, np.int32)
        slots, keys = np.arange(n, dtype=np.int64), ids[self.order]
        self.ranks: list[np.ndarray] = []
        size = 1
        while True:
            # slots of the array that were sorted again, in order, and what they were sorted by
            new = np.ones(len(slots), bool)
            new[1:] = keys[1:] != keys[:-1]
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            rank[self.order[slots]] = slots[first][group]
            self.ranks.append(rank.copy())
            if size >= largest:
                break
            more = np.diff(np.append(first, len(slots)))[group] > 1
            slots = slots[more]
            if not len(slots):
                break
            at = self.order[slots].astype(np.int64)
            keys = rank[at].astype(np.int64) * n + rank[at + size]
            by = np.argsort(keys, kind="stable")
            self.order[slots], keys = at[by], keys[by]
            size *= 2

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are equal; a < b."""
        return self._extent(a, b, 0, 1)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are equal; a < b."""
        return self._extent(a, b, 1, -1)

    def _extent(self, a, b, back, sign) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[k], 1 << k
            live = np.arange(len(a))
            while len(live):
                x, y = a[live] + sign * out[live] - back * step, b[live] + sign * out[live] - back * step
                inside = x >= 0
                live = live[inside]
                live = live[rank[x[inside]] == rank[y[inside]]]
                out[live] += step
                if k < len(self.ranks) - 1:       # only the largest block can fit more than once
                    break
        return out


class Wavelets:
    """A wavelet matrix over a permutation of 0 .. n - 1."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([np.zeros(1, np.int32), np.cumsum(one, dtype=np.int32)]))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in the slots low .. high - 1 are below x."""
        low, high, out = low.astype(np.int64), high.astype(np.int64), np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            a, b = self.ones[level][low], self.ones[level][high]
            up = (x >> bit & 1).astype(bool)
            out += np.where(up, high - low - b + a, 0)
            low = np.where(up, self.zeros[level] + a, low - a)
            high = np.where(up, self.zeros[level] + b, high - b)
        return np.where(x >= 1 << self.bits, out + high - low, out)

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank k (from 0) among those in the slots low .. high - 1."""
        low, high, k, out = low.astype(np.int64), high.astype(np.int64), k.copy(), np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            a, b = self.ones[level][low], self.ones[level][high]
            few = high - low - b + a
            up = k >= few
            k -= np.where(up, few, 0)
            out |= up.astype(np.int64) << bit
            low = np.where(up, self.zeros[level] + a, low - a)
            high = np.where(up, self.zeros[level] + b, high - b)
        return out


def _candidates(blocks: Blocks, tree: Wavelets, level: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs that the aligned blocks of 2 ** level words propose."""
    size = 1 << level
    rank = blocks.ranks[level]
    at = np.arange(0, n, size)
    low = rank[at].astype(np.int64)
    high = low + np.bincount(rank, minlength=n)[low]
    several = high - low > 1
    at, low, high = at[several], low[several], high[several]
    near, far = at + -(-(2 * size - 1) // 3), at + -(-(4 * size - 1) // 3)      # first place, and first beyond
    before = tree.below(low, high, near)
    places = []
    for k in range(3):
        there = before + k < high - low
        place = np.full(len(at), 1 << 62)
        place[there] = tree.kth(low[there], high[there], before[there] + k)
        places.append(place)
        if k == 0:
            hit = place < far
            at, low, high, near, far, before, places = at[hit], low[hit], high[hit], near[hit], far[hit], before[hit], [place[hit]]
    one, two, three = places
    many = three < far
    pair = (two < far) & ~many
    i, j, step = at[many], one[many], (two - one)[many]
    period = j - i + blocks.ahead(j, j + step) - blocks.ahead(i, i + step)
    fits = (period >= (near - at)[many]) & (period < (far - at)[many])
    return (np.concatenate([at[~many], at[pair], i[fits]]),
            np.concatenate([(one - at)[~many], (two - at)[pair], period[fits]]))


def runs(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period, in texts of at most ``longest``
    words; ``ids`` as for ``Blocks``."""
    n = len(ids)
    most = longest // LEAST_TIMES                                  # the largest period
    blocks = Blocks(ids, max(2, (3 * most + 1) // 2))
    found = []
    if most and len(blocks.ranks) > 1:
        tree = Wavelets(blocks.order)
        for level in range(1, len(blocks.ranks)):
            at, period = _candidates(blocks, tree, level, n)
            if not len(at):
                continue
            start = at - blocks.behind(at, at + period)
            length = at + period + blocks.ahead(at, at + period) - start
            long = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
            found.append(np.stack([start, length, period], axis=1)[long])
    if not found:
        return (np.empty(0, np.int64),) * 3
    all_ = np.unique(np.concatenate(found), axis=0)                # by start, length, period
    smallest = np.ones(len(all_), bool)
    smallest[1:] = (all_[1:, :2] != all_[:-1, :2]).any(1)
    all_ = all_[smallest]
    all_ = all_[np.lexsort((all_[:, 2], all_[:, 0]))]
    return all_[:, 0], all_[:, 1], all_[:, 2]


def _chunk(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as words."""
    known: dict[bytes, int] = {}
    number = len(texts)                                            # separators come first
    flat: list[int] = []
    starts = []
    for t, words in enumerate(texts):
        starts.append(len(flat))
        flat += [known.setdefault(w, number + len(known)) for w in words]
        flat.append(t)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    start, length, period = runs(np.array(flat, np.int64), max(map(len, texts)))
    of = np.searchsorted(np.array(starts), start, side="right") - 1
    for t, s, n, p in zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()):
        out[t].append((s - starts[t], n, p))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that repeat an earlier period of a run."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(edge[:-1]).tolist()) if not inside]


def find(docs: DataFrame, text: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period, by start and period) and
    ``collapsed`` (the words left when each run is cut to its first period, joined by one space)."""
    docs = docs.drop("n_words", "runs", "collapsed")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

    def done(part, texts):
        found = _chunk(texts)
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array([len(w) for w in texts], pa.int64()),
             pa.array([[dict(zip(RUN.names, r)) for r in f] for f in found], kind),
             pa.array([b" ".join(collapse(w, f)).decode() for w, f in zip(texts, found)], pa.string())],
            names=[*part.schema.names, "n_words", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            first, texts, words = 0, [], 0
            for i, t in enumerate(column):
                t = t.as_py()
                texts.append((t or "").encode().split())       # splits on the white space that WORD excludes
                words += len(texts[-1]) + 1
                if words >= chunk_words or i == len(column) - 1:
                    yield done(batch.slice(first, i + 1 - first), texts)
                    first, texts, words = i + 1, [], 0
    return docs.mapInArrow(run, schema)
