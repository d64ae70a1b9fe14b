"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts with counts from the training documents: for each position
of a token, the contexts of 0 to ``ORDER`` bytes before it (tokens start with a marker, and no
context reaches into the token before) and the byte that followed.  A byte is coded in the longest
context that was seen; if it never followed there, an escape is coded and the next shorter context
is asked, with the symbols of the longer one excluded from its counts.  Escapes are estimated by
method D (half a count of every symbol left goes to the escape), and after order 0 the bytes that
were never seen share the rest.  The code length of a text is that of its tokens, each closed by a
white-space symbol, and of its end; it is a proper distribution over sequences of tokens.

A text is coded by this pretrained model or adaptively: the tokens that the document has had so
far, in context of the token before (order 1) or without (order 0), with escapes by method C to
the trie for tokens that are new in it.  The score is the mean of the three probabilities, which
costs at most log10(3) over the best of them.

Because contexts end at token borders, a token has one code length wherever it stands.  The
corpus is therefore never scored byte by byte: tokens are counted (a shuffle that grows with the
corpus), each different token is scored once, and documents, reduced to (chunk, token, postings),
are joined with the tokens by a shuffle.  The trie keeps every node and grows with the corpus.
Contexts of up to ``BASE`` bytes have 256^3 nodes at most, whatever the corpus, and are broadcast;
longer ones are dealt by their last ``BASE + 1`` bytes, and with them the vocabulary's grams, reduced
to (chunk, gram, postings), so that all contexts that a gram may be coded in are in its partition.

Defined cases: a null text is empty and consists of its end; a null doc_id counts for training;
repeated rows are scored one by one; without training documents all bytes are equally likely; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import folded_words, saved

ORDER = 5
#: Longest contexts whose nodes are few by the alphabet alone.
BASE = 2
HOLD_OUT_MOD, HOLD_OUT_REST = 7, 2
#: Tokens of a chunk of documents, and of a chunk of the vocabulary.
CHUNK_TOKENS, CHUNK_DOCS, CHUNK_WORDS = 2_000_000, 60_000, 100_000
#: Nodes that are combined before they are sent or kept.
COMBINE = 3_000_000
#: Tokens whose adaptive codes are worked out at once.
SETTLE_TOKENS = 300_000

MARK = 0x20
#: The end of a text is the empty token.
END = b""


def _words(text: str | None) -> list[bytes]:
    return [*folded_words(text), END]


def _chunk_id(task: int, k: int) -> int:
    return task << 24 | k


def _count_tokens(batches):
    """Worker over (doc_id, text, held_out): (token, n), n counting training documents only; a
    token known from held-out texts alone counts 0."""
    def emit():
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                          names=["token", "n"])
    found, size = Counter(), 0
    for batch in batches:
        for text, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = _words(text)
            found.update(dict.fromkeys(words, 0) if held else words)
            size += len(words)
            if size >= CHUNK_TOKENS:
                yield emit()
                found, size = Counter(), 0
    if found:
        yield emit()


def _by(key: np.ndarray) -> np.ndarray:
    """Positions ordered by key, then position."""
    n = len(key)
    bits = max(1, (n - 1).bit_length())
    if int(key.max(initial=0)).bit_length() + bits < 63:
        return np.sort(key << bits | np.arange(n)) & ((1 << bits) - 1)
    return np.argsort(key, kind="stable")


def _rank(order: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each position: the number of its group and of earlier positions in it."""
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if len(order) else np.empty(0, bool)
    number = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    group, rank = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    group[order], rank[order] = number, np.arange(len(order)) - start[number]
    return group, rank


def adaptive_lengths(token: np.ndarray, doc: np.ndarray, n_docs: int):
    """Two adaptive codes over the tokens of documents, in order, without the cost of new tokens.

    Order 0 codes a token by its count in the document so far, or an escape (method C); order 1
    first asks what followed the token before it.  A token that is new in its document is left to
    the trie.  Returns the sums of log10 by document of either order, and the pairs (doc, token)
    with their counts."""
    by_pair = _by(doc * (int(token.max(initial=0)) + 1) + token)
    pair_key = doc * (int(token.max(initial=0)) + 1) + token
    pair, seen = _rank(by_pair, pair_key)
    new = seen == 0
    first_of_doc = np.searchsorted(doc, np.arange(n_docs))
    at = np.arange(len(token)) - first_of_doc[doc]
    known = np.cumsum(new) - new
    known = known - known[first_of_doc[doc]]           # different tokens so far
    with np.errstate(divide="ignore"):
        order0 = np.where(at == 0, 0.0, np.log10(np.where(new, known, seen) / np.maximum(at + known, 1)))
    # order 1: contexts are earlier tokens of the document
    inside = np.flatnonzero(at > 0)
    before = pair[inside - 1]
    uses = seen[inside - 1]                            # times the context was followed before
    key = before * (int(token.max(initial=0)) + 1) + token[inside]
    bigram, again = _rank(_by(key), key)
    fresh = again == 0
    by_context = _by(before)
    _, place = _rank(by_context, before)
    run = np.cumsum(fresh[by_context]) - fresh[by_context]
    branches = np.empty(len(inside), np.int64)         # different followers so far
    branches[by_context] = run - np.repeat(run[place[by_context] == 0], np.bincount(before[by_context])[np.unique(before)]) if len(inside) else run
    order1 = order0.copy()
    asked = uses > 0
    total = np.maximum(uses + branches, 1)
    order1[inside] = np.where(~asked, order0[inside], np.where(
        fresh, order0[inside] + np.log10(np.maximum(branches, 1) / total), np.log10(np.maximum(again, 1) / total)))
    lead = by_pair[seen[by_pair] == 0]
    return (np.bincount(doc, order0, n_docs), np.bincount(doc, order1, n_docs),
            doc[lead], token[lead], np.bincount(pair)[pair[lead]] if len(lead) else np.empty(0, np.int64))


POSTING = [("doc", "<u2"), ("n", "u1")]
HEAD = [("doc_id", "<i8"), ("named", "?"), ("held_out", "?"), ("n_tokens", "<i8"), ("order0", "<f8"), ("order1", "<f8")]


def _document_chunks(batches):
    """Worker over (doc_id, text, held_out): (chunk, token, postings), and a row per chunk with its
    documents in place of postings, under a token that no word is.  A posting is a document's
    number and a count of 1 to 255; 0 adds 255 to it."""
    from pyspark import TaskContext

    task, k = TaskContext.get().partitionId(), 0
    ids, sequence, docs, heads, pairs = {}, [], [], [], []

    def settle():
        """Reduce the documents read since the last call to pairs."""
        done = sum(len(p[0]) for p in heads)
        if not sequence:
            return
        token = np.fromiter(sequence, np.int64, len(sequence))
        sizes = np.fromiter((len_ for _, _, len_ in docs), np.int64, len(docs))
        doc = np.repeat(np.arange(len(docs)), sizes)
        zero, one, where, what, count = adaptive_lengths(token, doc, len(docs))
        pairs.append((where + done, what, count))
        heads.append(([d[0] for d in docs], [d[1] for d in docs], sizes, zero, one))
        sequence.clear()
        docs.clear()

    def flush():
        settle()
        tokens = list(ids)
        doc, token, count = (np.concatenate([p[i] for p in pairs]) for i in range(3))
        more = (count - 1) // 255 + 1
        last = np.cumsum(more) - 1
        packed = np.zeros(int(more.sum()), POSTING)
        packed["doc"] = np.repeat(doc, more)
        packed["n"][last] = count - 255 * (more - 1)
        token = np.repeat(token, more)
        order = np.argsort(token, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(token, minlength=len(tokens)))]) * packed.itemsize
        chunk = _chunk_id(task, k)
        postings = pa.Array.from_buffers(pa.binary(), len(tokens), [
            None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(packed[order].tobytes())])
        head = np.zeros(doc.max() + 1, HEAD)
        ids_ = [i for h in heads for i in h[0]]
        head["doc_id"], head["named"] = [i or 0 for i in ids_], [i is not None for i in ids_]
        for k_, name in enumerate(("held_out", "n_tokens", "order0", "order1"), 1):
            head[name] = np.concatenate([np.asarray(h[k_]) for h in heads])
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * (len(tokens) + 1), pa.int64()), pa.array([*tokens, b" %d" % chunk], pa.binary()),
             pa.concat_arrays([postings, pa.array([head.tobytes()], pa.binary())])], names=["chunk", "token", "postings"])
    read, size, count = 0, 0, 0
    for batch in batches:
        for doc_id, text, held in zip(*(c.to_pylist() for c in batch.columns)):
            words = _words(text)
            sequence.extend([ids.setdefault(w, len(ids)) for w in words])
            docs.append((doc_id, held, len(words)))
            read, size, count = read + len(words), size + len(words), count + 1
            if read >= SETTLE_TOKENS:
                settle()
                read = 0
            if size >= CHUNK_TOKENS or count >= CHUNK_DOCS:
                yield flush()
                ids, k, read, size, count = {}, k + 1, 0, 0, 0
                heads.clear()
                pairs.clear()
    if count:
        yield flush()


def _grams(tokens: list[bytes], order: int):
    """Of each symbol of each token: token number, symbol, orders available, and its contexts of
    0 to ``order`` bytes as integers."""
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    stream = np.frombuffer(b"".join([b" " + t + b" " for t in tokens]), np.uint8).astype(np.int64)
    start = np.cumsum(n + 2) - (n + 2)
    symbol = np.ones(len(stream), bool)
    symbol[start] = False
    at = np.flatnonzero(symbol)
    token = np.repeat(np.arange(len(tokens)), n + 1)
    have = np.minimum(at - start[token], order)
    contexts, context = [np.zeros(len(at), np.int64)], np.zeros(len(at), np.int64)
    for k in range(1, order + 1):
        context = context | (stream[np.maximum(at - k, 0)] << (8 * (k - 1)))
        contexts.append(context)
    return token, stream[at], have, contexts


def _key(order, context, symbol):
    return (order << 56) | (context << 8) | symbol


def _combine(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(key)
    key, n = key[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def _word_chunks(batches):
    """(tokens, c) of up to about CHUNK_WORDS rows of (token, c) each."""
    tokens, c = [], []
    for batch in batches:
        tokens += batch.column(0).to_pylist()
        c.append(batch.column(1).to_numpy())
        if len(tokens) >= CHUNK_WORDS:
            yield tokens, np.concatenate(c)
            tokens, c = [], []
    if tokens:
        yield tokens, np.concatenate(c)


def _node_counts(order: int):
    """Worker over (token, c): (key, n), the trie nodes that the training tokens pass."""
    def run(batches):
        now = np.empty(0, np.int64), np.empty(0, np.int64)
        for tokens, c in _word_chunks(batches):
            token, symbol, have, contexts = _grams(tokens, order)
            keys, counts = [now[0]], [now[1]]
            for k, context in enumerate(contexts):
                some = have >= k
                keys.append(_key(k, context[some], symbol[some]))
                counts.append(c[token[some]])
            now = _combine(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(now[0]), pa.array(now[1])], names=["key", "n"])
    return run


@dataclass
class Order:
    """The trie's contexts of one length: nodes (context, symbol) with counts, and per context the
    count and number of its symbols, and of those of the next shorter context that did not follow
    it, which is what an escape from here meets.  All sorted by key."""
    node: np.ndarray
    count: np.ndarray
    context: np.ndarray
    total: np.ndarray
    symbols: np.ndarray
    rest_total: np.ndarray
    rest_symbols: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``wanted`` in sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def build_orders(key: np.ndarray, n: np.ndarray, order: int, base: list[Order] | None = None) -> list[Order]:
    """The orders 0 to ``order`` of a node table (key, n), of which ``base`` are built already."""
    out: list[Order] = list(base or ())
    for k in range(len(out), order + 1):
        own = (key >> 56) == k
        node, count = key[own] & ((1 << 56) - 1), n[own]
        by = np.argsort(node)
        node, count = node[by], count[by]
        first = np.flatnonzero(np.concatenate([[True], (node[1:] >> 8) != (node[:-1] >> 8)])) if len(node) else np.empty(0, np.int64)
        context = node[first] >> 8
        total, symbols = np.add.reduceat(count, first) if len(node) else count, np.diff(np.append(first, len(node)))
        rest_total, rest_symbols = np.zeros(len(context), np.int64), np.zeros(len(context), np.int64)
        if k and len(node):
            shorter = out[-1]
            # without its oldest byte, a node is one of the shorter context
            at, _ = _find(shorter.node, node & ((1 << (8 * k)) - 1))
            up, _ = _find(shorter.context, context & ((1 << (8 * (k - 1))) - 1))
            rest_total = shorter.total[up] - np.add.reduceat(shorter.count[at], first)
            rest_symbols = shorter.symbols[up] - symbols
        out.append(Order(node, count, context, total, symbols, rest_total, rest_symbols))
    return out


def base_orders(vocabulary: DataFrame, order: int = ORDER) -> list[Order]:
    """The trie's orders up to ``BASE``; their size is bounded by the alphabet."""
    top = min(order, BASE)
    nodes = (vocabulary.filter("c > 0").select("token", "c").mapInArrow(_node_counts(top), "key long, n long")
             .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    return build_orders(nodes["key"].to_numpy(), nodes["n"].to_numpy(), top)


def long_orders(gram: np.ndarray, n: np.ndarray, order: int, base: list[Order]) -> list[Order]:
    """``base`` and the orders above it.  (gram, n) are the nodes of longest context; without its
    oldest bytes each counts for a node of every shorter order."""
    have, node = gram >> 56, gram & ((1 << 56) - 1)
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(len(base), order + 1):
        some = have >= k
        key, count = _combine([k << 56 | node[some] & ((1 << (8 * k + 8)) - 1)], [n[some]])
        keys.append(key)
        counts.append(count)
    return build_orders(np.concatenate(keys), np.concatenate(counts), order, base)


def gram_lengths(orders: list[Order], gram: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram: a symbol in its longest possible context."""
    have, bytes_, symbol = gram >> 56, (gram & ((1 << 56) - 1)) >> 8, gram & 255
    out, open_ = np.zeros(len(gram)), np.ones(len(gram), bool)
    fresh = np.ones(len(gram), bool)                   # no context was seen so far, nothing is excluded
    left_total, left_symbols = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
    for k in range(len(orders) - 1, -1, -1):
        o = orders[k]
        rows = np.flatnonzero(open_ & (have >= k))
        context = bytes_[rows] & ((1 << (8 * k)) - 1)
        at, seen = _find(o.context, context)
        rows, context, at = rows[seen], context[seen], at[seen]
        where, known = _find(o.node, context << 8 | symbol[rows])
        first = fresh[rows]
        total = 2 * np.where(first, o.total[at], left_total[rows])
        left = np.where(first, o.symbols[at], left_symbols[rows])
        hit = rows[known]
        out[hit] += np.log10((2 * o.count[where[known]] - 1) / total[known])
        open_[hit] = False
        miss, at, left, total = rows[~known], at[~known], left[~known], total[~known]
        # with nothing left to follow, the escape is certain
        some = left > 0
        out[miss[some]] += np.log10(left[some] / total[some])
        left_total[miss], left_symbols[miss], fresh[miss] = o.rest_total[at], o.rest_symbols[at], False
    # never seen at all: an equal share among the bytes that order 0 does not know
    out[open_] -= np.log10(256 - len(orders[0].node))
    return out


PIECES = "at long, key long, n long, chunk long, postings binary"


def _vocabulary_chunks(shared, order: int):
    """Worker over (token, c): rows of PIECES, dealt by ``at``.

    Grams of more than BASE bytes of context are postings (chunk, gram, numbers of tokens) and, from
    training tokens, nodes (gram, n) without a chunk.  A chunk's tokens, their counts and the code
    lengths of their shorter grams are one row without a key."""
    from pyspark import TaskContext

    deal = (1 << (8 * (BASE + 1))) - 1

    def nodes(key, n):
        none = pa.nulls(len(key), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(key >> 8 & deal), pa.array(key), pa.array(n), none, pa.nulls(len(key), pa.binary())],
                                          names=["at", "key", "n", "chunk", "postings"])

    def run(batches):
        base = [Order(*arrays) for arrays in shared.value]
        task, now = TaskContext.get().partitionId(), (np.empty(0, np.int64), np.empty(0, np.int64))
        for k, (tokens, c) in enumerate(_word_chunks(batches)):
            chunk = _chunk_id(task, k)
            token, symbol, have, contexts = _grams(tokens, order)
            key = _key(have, np.choose(have, contexts), symbol)
            short = have <= BASE
            gram, at = np.unique(key[short], return_inverse=True)
            start = np.bincount(token[short], gram_lengths(base, gram)[at], len(tokens))
            key, token = key[~short], token[~short]
            by = np.argsort(key, kind="stable")
            key, token = key[by], token[by]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            gram = key[first]
            postings = pa.Array.from_buffers(pa.binary(), len(gram), [
                None, pa.py_buffer((np.append(first, len(key)) * 4).astype(np.int32).tobytes()), pa.py_buffer(token.astype("<u4").tobytes())])
            heading = b"".join([len(tokens).to_bytes(8, "little"), c.astype("<i8").tobytes(), start.astype("<f8").tobytes(), b" ".join(tokens)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(gram >> 8 & deal, -1 - chunk)), pa.array([*gram, None], pa.int64()),
                 pa.nulls(len(gram) + 1, pa.int64()), pa.array(np.full(len(gram) + 1, chunk)),
                 pa.concat_arrays([postings, pa.array([heading], pa.binary())])], names=["at", "key", "n", "chunk", "postings"])
            if len(gram):
                n = np.add.reduceat(c[token], first)
                now = _combine([now[0], gram[n > 0]], [now[1], n[n > 0]])
            if len(now[0]) >= COMBINE:
                yield nodes(*now)
                now = np.empty(0, np.int64), np.empty(0, np.int64)
        yield nodes(*now)
    return run


def _gram_lengths(shared, order: int):
    """Worker over (key, n, chunk, postings) of some contexts, their nodes first: (chunk, log10p,
    postings).  Only the nodes are held; a chunk's heading passes through."""
    def run(batches):
        base = [Order(*arrays) for arrays in shared.value]
        keys, counts, size, orders = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0, None
        for batch in batches:
            nodes = batch.num_rows - batch.column(1).null_count
            if nodes:
                keys.append(batch.column(0).slice(0, nodes).to_numpy())
                counts.append(batch.column(1).slice(0, nodes).to_numpy())
                size += nodes
                if size >= COMBINE + 2 * len(keys[0]):
                    key, n = _combine(keys, counts)
                    keys, counts, size = [key], [n], len(key)
            if nodes == batch.num_rows:
                continue
            if orders is None:
                orders = long_orders(*_combine(keys, counts), order, base)
                keys = counts = None
            asked = batch.slice(nodes)
            heading = asked.column(0).is_null().to_numpy(zero_copy_only=False)
            gram, at = np.unique(asked.column(0).fill_null(0).to_numpy(), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [asked.column(2), pa.array(gram_lengths(orders, gram)[at], mask=heading), asked.column(3)],
                names=["chunk", "log10p", "postings"])
    return run


def _sum_vocabulary(batches):
    """Worker over (chunk, log10p, postings) sorted by chunk: (token, c, log10p).  A row without
    log10p is the chunk's heading."""
    def close():
        n = int.from_bytes(heading[:8], "little")
        score = np.frombuffer(heading, "<f8", n, 8 + 8 * n) + np.bincount(
            np.concatenate(where), np.concatenate(what), n)
        return pa.RecordBatch.from_arrays([pa.array(heading[8 + 16 * n:].split(b" "), pa.binary()),
                                           pa.array(np.frombuffer(heading, "<i8", n, 8)), pa.array(score)],
                                          names=["token", "c", "log10p"])
    now, heading, where, what = None, None, [], []
    for batch in batches:
        chunk, value = batch.column(0).to_numpy(), batch.column(1).fill_null(0.0).to_numpy()
        headings = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        for lo, hi in _runs(chunk):
            if chunk[lo] != now:
                if now is not None:
                    yield close()
                now, heading, where, what = chunk[lo], None, [np.empty(0, np.int64)], [np.empty(0)]
            lists = batch.column(2).slice(lo, hi - lo).to_pylist()
            for i in np.flatnonzero(headings[lo:hi]):
                heading, lists[i] = lists[i], b""
            where.append(np.frombuffer(b"".join(lists), "<u4").astype(np.int64))
            what.append(np.repeat(value[lo:hi], np.array([len(p) for p in lists]) // 4))
    if now is not None:
        yield close()


def token_lengths(vocabulary: DataFrame, order: int = ORDER) -> DataFrame:
    """(token, c) with log10p, the sum over the token's symbols."""
    # as plain arrays, which executors read without this package
    shared = vocabulary.sparkSession.sparkContext.broadcast([tuple(vars(o).values()) for o in base_orders(vocabulary, order)])
    return (vocabulary.mapInArrow(_vocabulary_chunks(shared, order), PIECES)
            .repartition("at").select("key", "n", "chunk", "postings").sortWithinPartitions(F.col("n").isNull())
            .mapInArrow(_gram_lengths(shared, order), "chunk long, log10p double, postings binary")
            .repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(_sum_vocabulary, "token binary, c long, log10p double"))


def _runs(keys: np.ndarray):
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]) if len(keys) else ()


def _sum_documents(batches):
    """Worker over (chunk, c, log10p, postings) sorted by chunk: one row per document.  A row that
    met no token of the vocabulary holds the chunk's documents."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "log10_counts", "pretrained", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def close():
        known, counts, fixed, once = (x[:len(head)] for x in sums)
        three = np.stack([fixed, head["order0"] + once, head["order1"] + once])
        top = three.max(axis=0)
        mean = top + np.log10((10.0 ** (three - top)).sum(axis=0) / 3)
        return pa.RecordBatch.from_arrays([pa.array(head["doc_id"], pa.int64(), mask=~head["named"])] + [pa.array(x, t) for x, t in zip(
            [head["held_out"], head["n_tokens"], known.round().astype(np.int64), counts, fixed, mean], kinds[1:])],
            names=names)
    now, head, sums = None, None, None
    for batch in batches:
        chunk, c = batch.column(0).to_numpy(), batch.column(1).fill_null(0).to_numpy()
        length, heading = batch.column(2).fill_null(0.0).to_numpy(), batch.column(1).is_null().to_numpy(zero_copy_only=False)
        for lo, hi in _runs(chunk):
            if chunk[lo] != now:
                if now is not None:
                    yield close()
                now, head, sums = chunk[lo], None, np.zeros((4, 1 << 16))
            lists = batch.column(3).slice(lo, hi - lo).to_pylist()
            for i in np.flatnonzero(heading[lo:hi]):
                head, lists[i] = np.frombuffer(lists[i], HEAD), b""
            packed = np.frombuffer(b"".join(lists), POSTING)
            size = np.array([len(p) for p in lists]) // packed.itemsize
            doc, n = packed["doc"].astype(np.int64), packed["n"].astype(np.float64)
            once, n = n > 0, np.where(n > 0, n, 255.0)
            value = np.repeat(length[lo:hi], size)
            for row, what in enumerate((n * np.repeat(c[lo:hi] > 0, size), n * np.repeat(np.log10(c[lo:hi] + 1.0), size),
                                        n * value, once * value)):
                sums[row] += np.bincount(doc, what, 1 << 16)
    if now is not None:
        yield close()


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    if not 1 <= order <= 5:
        raise ValueError("order must be 1 to 5: a context and its symbol share 48 bits of a key")
    held = F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(HOLD_OUT_MOD)) == HOLD_OUT_REST
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), held.alias("held_out"))
    counted = saved(rows.mapInArrow(_count_tokens, "token binary, n long")
                    .groupBy("token").agg(F.sum("n").alias("c")), "ppm-counts")
    totals = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n"),
                         F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0)).alias("v")).first()
    vocabulary = token_lengths(counted, order)
    postings = rows.mapInArrow(_document_chunks, "chunk long, token binary, postings binary")
    summed = (postings.join(vocabulary, "token", "left").select("chunk", "c", "log10p", "postings")
              .repartition("chunk").sortWithinPartitions("chunk")
              .mapInArrow(_sum_documents, "doc_id long, held_out boolean, n_tokens long, n_known long, log10_counts double, "
                           "pretrained double, score double"))
    share = float(np.log10(totals["n"] + totals["v"] + 1))
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals["n"]).cast("long").alias("train_tokens"),
                         (F.col("log10_counts") - F.col("n_tokens") * F.lit(share)).alias("base_score"), "score",
                         F.col("pretrained").alias("pretrained_score"))
