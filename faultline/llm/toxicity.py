"""Toxicity: a bidirectional gated recurrent network with attention pooling, over characters and words.

A text is lower-cased and cut at ASCII punctuation and white space; words of more than PIECE bytes are
cut into pieces of that many bytes.  A piece's input has two parts: the state, pooled by attention, of a
bidirectional GRU over its bytes, and the row of an embedding table (pieces that are common in the
training sample have rows of their own, all others share one).  A second bidirectional GRU with
attention pooling reads windows of WINDOW pieces and gives one logit a window.  Windows overlap by
half, the last one ends with the text, and all are scored; a text has the score of its highest window,
put through a logistic curve fitted on texts that the network was not trained on.

The network is trained in numpy, by Adam steps over batches of windows that bear the label of their
text, half from each class; after a first round those windows of toxic texts that score highest.  The sample is bounded: at most ``max_rows`` labelled texts a class and
``max_windows`` windows a text, both chosen by hashes; a quarter of the texts calibrates, and is scored
whole.  Only labels and texts are learnt from.  Scoring covers every text and all of its windows; a task
works through a text in blocks of windows and remembers the inputs of at most KEEP pieces.

Defined cases: a null text, and one without words, is one window of padding; labels other than 0 and 1, and labels
without a text, are left out; of repeated labels the lowest counts, of several texts of an id the one with
the least hash; without training labels of both kinds every text has the score 0; a null id is never
labelled; an empty table gives an empty result; other columns are passed through, old columns of the
added names are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.quality import platt

PIECE = 16
WINDOW = 24
STRIDE = 12
MAX_ROWS = 2000
MAX_WINDOWS = 24
ROUNDS = 8
STEPS = 80         # per round
BATCH = 128
RATE = 8e-3

CHARS = 8          # byte embedding
CHAR_STATE = 12    # per direction
WORDS = 8          # word embedding
STATE = 12         # per direction
VOCABULARY = 4096
KEEP = 200_000
BLOCK = 2048       # windows scored at a time

_SPLIT = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * 66)


def pieces(text: str | None) -> list[bytes]:
    words = (text or "").lower().encode().translate(_SPLIT).split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def window_starts(n: int) -> np.ndarray:
    """Where the windows of a text of n pieces start."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


# ---------------------------------------------------------------------------- the network
# Arrays are [step, unit, row], so that every step works on long contiguous rows.
def gru(inputs: np.ndarray, u: np.ndarray, keep: bool = False):
    """States [step, unit, row] for input projections [step, 3 * unit, row]; gates are update, reset,
    candidate.  ``keep``: also what the backward pass needs."""
    steps, _, n = inputs.shape
    h = u.shape[0]
    ut = np.ascontiguousarray(u.T)
    states = np.empty((steps, h, n), u.dtype)
    now, cache = np.zeros((h, n), u.dtype), []
    for t in range(steps):
        g = ut @ now
        gates = g[:2 * h] + inputs[t, :2 * h]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:h], gates[h:]
        c = r * g[2 * h:]
        c += inputs[t, 2 * h:]
        np.tanh(c, out=c)
        if keep:
            cache.append((now, z, r, c, g[2 * h:]))
        now = np.subtract(now, c, out=states[t])
        now *= z
        now += c
    return states, cache


def gru_back(grad: np.ndarray, u: np.ndarray, cache) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input projections and of u, for gradients of the states."""
    steps, h, n = grad.shape
    out, du, d = np.empty((steps, 3 * h, n), u.dtype), np.zeros_like(u), np.zeros((h, n), u.dtype)
    for t in range(steps - 1, -1, -1):
        before, z, r, c, gc = cache[t]
        d = d + grad[t]
        dc = d * (1 - z) * (1 - c * c)
        out[t, :h], out[t, h:2 * h], out[t, 2 * h:] = d * (before - c) * z * (1 - z), dc * gc * r * (1 - r), dc
        dg = np.concatenate([out[t, :2 * h], dc * r])
        du += before @ dg.T
        d = d * z + u @ dg
    return out, du


def pool(states: np.ndarray, there: np.ndarray, v: np.ndarray):
    """Attention pooling of [step, unit, row] over the steps that are there: [unit, row]."""
    e = np.where(there, v @ states, np.float32(-1e9))
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    return np.einsum("tn,thn->hn", a, states), a


def pool_back(grad, pooled, states, a, v):
    """Gradients of the states and of v."""
    de = a * (np.einsum("hn,thn->tn", grad, states) - (grad * pooled).sum(0))
    return a[:, None, :] * grad + de[:, None, :] * v[:, None], np.einsum("tn,thn->h", de, states)


class Layer:
    """A bidirectional GRU with attention pooling, by its parameters ``name``_uf, _ub and _v.

    Inputs are rows of a table of projections [number, 6 * unit], given by their numbers [step, row]."""

    def __init__(self, p: dict[str, np.ndarray], name: str):
        self.p, self.name = p, name

    def forward(self, table, numbers, there, keep=False):
        p, k = self.p, self.name
        inputs = np.ascontiguousarray(table[numbers].transpose(0, 2, 1))
        half = inputs.shape[1] // 2
        f, fc = gru(inputs[:, :half], p[k + "_uf"], keep)
        b, bc = gru(inputs[::-1, half:], p[k + "_ub"], keep)
        states = np.concatenate([f, b[::-1]], axis=1)
        pooled, a = pool(states, there, p[k + "_v"])
        if keep:
            self.kept = numbers, states, a, pooled, fc, bc
        return pooled

    def backward(self, grad, grads, n):
        """Gradients of the first n rows of the table."""
        p, k = self.p, self.name
        numbers, states, a, pooled, fc, bc = self.kept
        d, grads[k + "_v"] = pool_back(grad, pooled, states, a, p[k + "_v"])
        h = d.shape[1] // 2
        df, grads[k + "_uf"] = gru_back(d[:, :h], p[k + "_uf"], fc)
        db, grads[k + "_ub"] = gru_back(d[::-1, h:], p[k + "_ub"], bc)
        both = np.concatenate([df, db[::-1]], axis=1).transpose(0, 2, 1)
        return added(numbers.ravel(), both.reshape(-1, both.shape[2]), n)


def added(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by row number, for n rows."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.diff(rows[order].astype(np.int64), prepend=-1))
    out[rows[order][first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def initial(words: int, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def draw(*shape, scale):
        return (scale * rng.standard_normal(shape)).astype(np.float32)
    x = WORDS + 2 * CHAR_STATE
    return {"bytes": draw(256, CHARS, scale=0.5), "c_w": draw(CHARS, 6 * CHAR_STATE, scale=CHARS ** -0.5), "c_b": np.zeros(6 * CHAR_STATE, np.float32),
            "c_uf": draw(CHAR_STATE, 3 * CHAR_STATE, scale=CHAR_STATE ** -0.5), "c_ub": draw(CHAR_STATE, 3 * CHAR_STATE, scale=CHAR_STATE ** -0.5),
            "c_v": draw(2 * CHAR_STATE, scale=0.1), "words": draw(words, WORDS, scale=0.1),
            "w_w": draw(x, 6 * STATE, scale=x ** -0.5), "w_b": np.zeros(6 * STATE, np.float32),
            "w_uf": draw(STATE, 3 * STATE, scale=STATE ** -0.5), "w_ub": draw(STATE, 3 * STATE, scale=STATE ** -0.5),
            "w_v": draw(2 * STATE, scale=0.1), "out": draw(2 * STATE, scale=0.3), "bias": np.zeros(1, np.float32)}


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes [step, row], zero beyond a word's end, and which of them are there; the words need lengths
    of 1 to PIECE that round up to the same multiple of four."""
    steps = -(-max(map(len, words)) // 4) * 4
    flat = np.frombuffer(b"".join(w.ljust(steps, b"\0") for w in words), np.uint8).reshape(len(words), steps).T
    return flat, flat > 0


def by_length(words: list[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault((len(w) + 3) // 4, []).append(i)
    return out


def word_inputs(p: dict[str, np.ndarray], words: list[bytes], rows: np.ndarray, keep: bool = False):
    """The input [word, unit] of each of some pieces (the empty one is padding, without characters), and
    the layers for the backward pass."""
    x = np.zeros((len(words), WORDS + 2 * CHAR_STATE), np.float32)
    x[:, :WORDS] = p["words"][rows]
    table = p["bytes"] @ p["c_w"] + p["c_b"]
    layers = []
    for size, at in by_length(words).items():
        if size:
            codes, there = spell([words[i] for i in at])
            layer = Layer(p, "c")
            x[at, WORDS:] = layer.forward(table, codes, there, keep).T
            layers.append((at, layer))
    return x, layers


def train_step(p, words, rows, tokens, y):
    """Loss and gradients for windows ``tokens`` [row, step] of numbers of ``words``; 0 is padding."""
    x, layers = word_inputs(p, words, rows, True)
    proj = x @ p["w_w"] + p["w_b"]
    top = Layer(p, "w")
    at = tokens.T
    there = at > 0
    there[0] |= ~there.any(0)
    pooled = top.forward(proj, at, there, True)
    prob = 0.5 * np.tanh(0.5 * (p["out"] @ pooled + p["bias"])) + 0.5
    d = ((prob - y) / len(y)).astype(p["out"].dtype)
    grads = {"out": pooled @ d, "bias": d.sum(keepdims=True)}
    dproj = top.backward(p["out"][:, None] * d, grads, len(proj))
    grads["w_w"], grads["w_b"] = x.T @ dproj, dproj.sum(0)
    dx = dproj @ p["w_w"].T
    grads["words"] = added(rows, dx[:, :WORDS], len(p["words"]))
    dtable = 0
    for k in ("c_uf", "c_ub", "c_v"):
        grads[k] = np.zeros_like(p[k])
    for at_, layer in layers:
        part: dict[str, np.ndarray] = {}
        dtable = dtable + layer.backward(dx[at_, WORDS:].T, part, 256)
        for k, g in part.items():
            grads[k] += g
    grads["bytes"], grads["c_w"], grads["c_b"] = dtable @ p["c_w"].T, p["bytes"].T @ dtable, dtable.sum(0)
    loss = -np.mean(np.where(y > 0, np.log(prob + 1e-9), np.log(1 - prob + 1e-9)))
    return loss, grads


def project(p: dict[str, np.ndarray], words: list[bytes], rows: np.ndarray, block: int = 4096) -> np.ndarray:
    """The input projections of pieces."""
    out = np.empty((len(words), 6 * STATE), np.float32)
    for i in range(0, len(words), block):
        out[i:i + block] = word_inputs(p, words[i:i + block], rows[i:i + block])[0] @ p["w_w"] + p["w_b"]
    return out


def window_logits(p: dict[str, np.ndarray], table: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """One logit a window of piece numbers [row, step]; number 0 is padding."""
    out = np.empty(len(tokens), np.float32)
    top = Layer(p, "w")
    for i in range(0, len(tokens), BLOCK):
        at = np.ascontiguousarray(tokens[i:i + BLOCK].T)
        there = at > 0
        there[0] |= ~there.any(0)
        out[i:i + BLOCK] = p["out"] @ top.forward(table, at, there) + p["bias"]
    return out


def train(windows: list[list[bytes]], labels: list[int], rounds: int = ROUNDS, steps: int = STEPS, batch: int = BATCH,
          rate: float = RATE, seed: int = 3) -> tuple[dict[str, np.ndarray], dict[bytes, int]]:
    """Parameters and vocabulary, from the sampled windows (pieces joined by spaces) of labelled texts of
    both classes.

    Most windows of a toxic text are harmless.  The first round draws from all windows; each later one
    scores all windows first and draws, for toxic texts, from the highest eighth of a text's windows, and
    for others every second time."""
    number: dict[bytes, int] = {b"": 0}
    tokens = np.zeros((sum(map(len, windows)), WINDOW), np.int32)
    first = np.concatenate([[0], np.cumsum([len(doc) for doc in windows])]).tolist()
    in_texts = Counter()
    for doc, at in zip(windows, first):
        for r, x in enumerate(doc, at):
            x = x.split()
            tokens[r, :len(x)] = [number.setdefault(w, len(number)) for w in x]
        in_texts.update(np.unique(tokens[at:at + len(doc)]).tolist())
    words = list(number)
    del number, in_texts[0]
    least = 3 if len(windows) >= 30 else 2
    common = sorted((i for i, c in in_texts.items() if c >= least), key=lambda i: (-in_texts[i], words[i]))[:VOCABULARY - 1]
    rows = np.zeros(len(words), np.int64)                          # row 0: all others
    rows[common] = np.arange(1, len(common) + 1)
    p = initial(len(common) + 1)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    rng = np.random.default_rng(seed)
    side = [[i for i, y in enumerate(labels) if y == c] for c in (0, 1)]
    best = [range(a, b) for a, b in zip(first, first[1:])]
    for step in range(1, rounds * steps + 1):
        if step % steps == 1 and step > 1:
            z = window_logits(p, project(p, words, rows), tokens)
            best = [(a + np.argsort(-z[a:b], kind="stable")[:-((a - b) // 8)]).tolist() for a, b in zip(first, first[1:])]
        chosen = []
        for c in (0, 1):
            for i in rng.choice(side[c], batch // 2):
                some = best[i] if c or rng.random() < 0.5 else range(first[i], first[i + 1])
                chosen.append((some[rng.integers(len(some))], c))
        some, here = np.unique(np.append(0, tokens[[i for i, _ in chosen]]), return_inverse=True)
        _, grads = train_step(p, [words[i] for i in some], rows[some], here[1:].reshape(-1, WINDOW), np.array([c for _, c in chosen], np.float32))
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        now = rate * (1 - 0.9 * step / (rounds * steps))
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            p[k] -= (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        p["words"] *= 1 - now * 0.1
    return p, {words[i]: n for n, i in enumerate(common, 1)}


class Scorer:
    """Window logits with a memory of the input projections of pieces."""

    def __init__(self, p: dict[str, np.ndarray], vocabulary: dict[bytes, int], keep: int = KEEP):
        self.p, self.vocabulary, self.keep = p, vocabulary, keep
        self._forget()

    def _forget(self):
        self.known: dict[bytes, int] = {b"": 0}
        self.table = np.zeros((1024, 6 * STATE), np.float32)
        self.table[0] = self._project([b""])[0]

    def _project(self, words: list[bytes]) -> np.ndarray:
        return project(self.p, words, np.array([self.vocabulary.get(w, 0) for w in words]))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Rows of the table; call once per block, the rows hold until the next call."""
        if len(self.known) > self.keep:
            self._forget()
        known, before = self.known, len(self.known)
        new = sorted(set(words).difference(known))
        known.update(zip(new, range(before, before + len(new))))
        while len(self.table) < len(known):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if new:
            self.table[before:len(known)] = self._project(new)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def highest(self, texts: list[str | None]) -> list[tuple[float, int, int]]:
        """(logit, first piece, windows) of the highest window of each text.

        Texts are cut into blocks of BLOCK windows, and short ones share a block."""
        out: list[tuple[float, int, int]] = [(-np.inf, 0, 0)] * len(texts)
        waiting: list[tuple[int, list[bytes], int, np.ndarray]] = []

        def flush():
            flat = self.numbers(list(chain.from_iterable(x[1] for x in waiting)))
            tokens, place, r = np.zeros((sum(len(x[3]) for x in waiting), WINDOW), np.int64), 0, 0
            for _, words, _, starts in waiting:
                k = min(WINDOW, len(words))
                tokens[r:r + len(starts), :k] = flat[place + starts[:, None] + np.arange(k)]
                place, r = place + len(words), r + len(starts)
            got, r = window_logits(self.p, self.table, tokens), 0
            for i, _, first, starts in waiting:
                best = int(got[r:r + len(starts)].argmax())
                logit, at, n = out[i]
                if got[r + best] > logit:
                    logit, at = float(got[r + best]), first + int(starts[best])
                out[i], r = (logit, at, n + len(starts)), r + len(starts)
            waiting.clear()

        rows = 0
        for i, t in enumerate(texts):
            words = pieces(t)
            starts = window_starts(len(words))
            for a in range(0, len(starts), BLOCK):
                part = starts[a:a + BLOCK]
                waiting.append((i, words[part[0]:part[-1] + WINDOW], int(part[0]), part - part[0]))
                rows += len(part)
                if rows >= BLOCK:
                    flush()
                    rows = 0
        if waiting:
            flush()
        return out


# ---------------------------------------------------------------------------- Spark
def _sampled(text: str | None, most: int, salt: int) -> list[bytes]:
    """At most ``most`` windows of a text, chosen by hashes of their places, as pieces joined by spaces."""
    words = pieces(text)
    starts = window_starts(len(words))
    if len(starts) > most:
        starts = sorted(starts.tolist(), key=lambda s: zlib.crc32(b"%d:%d" % (salt, s)))[:most]
    return [b" ".join(words[s:s + WINDOW]) for s in starts]


class Model:
    """Parameters, vocabulary and the logistic curve from a text's logit to its score."""

    def __init__(self, p, vocabulary, slope=1.0, offset=0.0):
        self.p, self.vocabulary, self.slope, self.offset = p, vocabulary, slope, offset

    def score(self, logit):
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(logit) + self.offset, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_ROWS,
        max_windows: int = MAX_WINDOWS, rounds: int = ROUNDS) -> Model | None:
    """A calibrated model from the labelled texts, or None without labels of both kinds."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("_y")))
    # at most max_rows ids a class, so the join may broadcast them
    ids = [known.filter(F.col("_y") == c).orderBy(F.xxhash64("_id", F.lit(23)), "_id").limit(max_rows) for c in (0, 1)]
    chosen = ids[0].unionByName(ids[1]).withColumn("_check", F.pmod(F.xxhash64("_id", F.lit(29)), F.lit(4)) == 0)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = rows.select(F.col("_id").cast("long"), "_y", "_check", F.xxhash64("_text").alias("_hash"), "_text")

    def once(make, kind):
        """One row an id, that of the text with the least hash: within tasks first, so that an id of very
        many rows sends one row a task."""
        schema = T.StructType([*rows.schema.fields[:4], T.StructField("_made", kind)])

        def run(batches):
            best: dict[int, tuple] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    if r["_id"] not in best or r["_hash"] < best[r["_id"]][3]:
                        best[r["_id"]] = r["_id"], r["_y"], r["_check"], r["_hash"], make(r["_id"], r["_text"])
            made = pa.list_(pa.binary()) if isinstance(kind, T.ArrayType) else pa.float64()
            if best:
                cols = list(zip(*best.values()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), made])], names=schema.names)
        return run, schema

    def collected(part, make, kind):
        run, schema = once(make, kind)
        got = part.mapInArrow(run, schema).groupBy("_id").agg(F.min_by(F.struct("_y", "_made"), "_hash").alias("r")).select("_id", "r.*")
        got = got.toArrow().sort_by("_id")
        return got["_made"].to_pylist(), got["_y"].to_pylist()

    windows, y = collected(rows.filter("not _check"), lambda i, t: _sampled(t, max_windows, i), T.ArrayType(T.BinaryType()))
    if len(set(y)) < 2:
        return None
    p, vocabulary = train(windows, y, rounds)
    del windows
    pa.default_memory_pool().release_unused()
    shared = docs.sparkSession.sparkContext.broadcast((p, vocabulary))
    logits, y = collected(rows.filter("_check"), _logit_of(shared), T.DoubleType())
    if len(set(y)) < 2:
        logits, y = collected(rows, _logit_of(shared), T.DoubleType())
    slope, offset = platt(np.array(logits), np.array(y, np.float64))
    return Model(p, vocabulary, slope, offset)


def _logit_of(shared):
    held: list[Scorer] = []

    def logit(_, text):
        if not held:
            held.append(Scorer(*shared.value))
        return held[0].highest([text])[0][0]
    return logit


def assess(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``windows``, how many were scored."""
    docs = docs.drop("score", "windows")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("windows", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.p, model.vocabulary, model.slope, model.offset))

    def run(batches):
        model = shared.value and Model(*shared.value)
        scorer = model and Scorer(model.p, model.vocabulary)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            if model:
                got = scorer.highest(texts)
                scores = model.score([x[0] for x in got])
            else:
                got, scores = [(0.0, 0, 0)] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([x[2] for x in got], pa.int64())],
                                             names=[*batch.schema.names, "score", "windows"])
    return docs.mapInArrow(run, schema)
