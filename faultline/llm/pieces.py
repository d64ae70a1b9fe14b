"""SentencePiece encoding and decoding as shortest paths through weighted transducers.

The model file is compiled into three machines: the normaliser (identity, white space escaped,
a dummy prefix), the pieces (a trie whose arcs spell pieces, weighted with their negative score)
and the byte fallback (a character without a piece is spelled by its bytes).  An input is
composed with them into a lattice of positions; the segmentation is the path of least weight in
the tropical semiring (sum along a path, least over paths).

For a merge model (BPE) the pieces' scores rank merges and are no lengths of a path.  There the
bigram machine carries the merges: an arc may follow another only if merging the two pieces'
characters gives back exactly these two pieces, otherwise the transition has infinite weight.
A string has one segmentation whose adjacent pieces all pass, the one that the merges give, and
so does each of its prefixes: one finite path reaches each position.  For a unigram model all
transitions are free and the scores decide.

No piece reaches from a character into the white space behind it, so texts are composed word by
word and a word's path is kept for its next occurrence (a bounded memory per task).

Defined cases: a null or empty text has no ids; a model that cannot be cut at white space (some
piece spans it) is composed over whole texts; ids of control pieces decode to nothing, of the
unknown piece to its surface; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from faultline.llm.common import worker_memory

SPACE = "▁"
# fixed values of the model file: piece types, model types, the unknown piece's surface
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
UNKNOWN_SURFACE = " ⁇ "
#: Words whose paths a worker remembers in each of two generations (some 250 bytes a word), the longest
#: word worth remembering, and the tested bigrams remembered (some 130 bytes each).
KEEP_WORDS, KEEP_CHARS, KEEP_BIGRAMS = 220_000, 48, 500_000
#: Texts encoded at a time: their ids are the largest thing that a task holds.
TOGETHER = 500
INFINITE = float("inf")


def _fields(data: bytes):
    """(number, value) of a serialised message's fields."""
    i = 0

    def varint():
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while i < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[i:i + size]
            i += size


@dataclass
class Machines:
    """The compiled model.  ``memory`` holds words' paths, ``allowed`` bigrams already tested."""
    pieces: list[str]
    weight: list[float]
    kind: list[int]
    merges: bool
    prefix: bool
    squeeze: bool
    by_word: bool = True
    trie: dict = field(default_factory=dict)
    ids: dict = field(default_factory=dict)
    byte_ids: dict = field(default_factory=dict)
    byte_values: dict = field(default_factory=dict)
    length: list = field(default_factory=list)
    pairs: set = field(default_factory=set)            # neighbouring characters inside pieces
    unknown: int = 0
    far: float = 0.0
    by_line: bool = False
    line_end: list = field(default_factory=list)
    memory: dict = field(default_factory=dict)
    older: dict = field(default_factory=dict)
    allowed: dict = field(default_factory=dict)

    # normaliser -------------------------------------------------------------------------------
    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    # bigrams ----------------------------------------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """Characters merged best score first, leftmost first among equals: what a bigram must
        survive.  Candidates wait in a heap; one whose parts have changed meanwhile is passed over."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def propose(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            piece = self.ids.get(both)
            if piece is not None and self.weight[piece] < INFINITE:
                heapq.heappush(heap, (self.weight[piece], i, both))
        for i in range(len(parts) - 1):
            propose(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                propose(i, after[i])
            if before[i] >= 0:
                propose(before[i], i)
        return [x for x in parts if x is not None]

    def follows(self, last: int, piece: int) -> bool:
        """Whether the bigram machine has the transition; -1 is the byte fallback of a character."""
        if last < 0 or piece < 0:
            return True
        key = last << 32 | piece
        ok = self.allowed.get(key)
        if ok is None:
            a, b = self.pieces[last], self.pieces[piece]
            if len(self.allowed) >= KEEP_BIGRAMS:
                self.allowed.clear()
            ok = self.allowed[key] = self.merged(a + b) == [a, b]
        return ok

    # composition ------------------------------------------------------------------------------
    def path(self, text: str) -> list[int]:
        """Ids along the least path of the lattice of ``text``, which is normalised."""
        return self._finite_path(text) if self.merges else self._least_path(text)

    def _least_path(self, text: str) -> list[int]:
        """Positions in order, each with its least weight and the arc that gives it."""
        n = len(text)
        cost, last, back = [INFINITE] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            here, node, j, single = cost[i], self.trie, i, False
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                piece = node.get(0)
                if piece is not None:
                    single = single or j == i + 1
                    if here + self.weight[piece] < cost[j]:
                        cost[j], last[j], back[j] = here + self.weight[piece], piece, i
            # dearer than any piece: taken only where no piece spells the character
            if not single and here + self.far < cost[i + 1]:
                cost[i + 1], last[i + 1], back[i + 1] = here + self.far, -1, i
        out, j = [], n
        while j > 0:
            i = back[j]
            out.extend((last[j],) if last[j] >= 0 else reversed(self.spell(text[i:j])))
            j = i
        return out[::-1]

    def _finite_path(self, text: str) -> list[int]:
        """With merges one path alone is finite, so it is the least: depth first, longest arcs
        first; a (position, piece) that led nowhere is not entered again."""
        n, trie, allowed, length = len(text), self.trie, self.allowed, self.length
        taken, pos, before, dead, options = [], 0, -1, None, []
        while pos < n:
            if len(options) == len(taken):             # arcs that leave this position
                node, j, arcs = trie, pos, []
                while j < n:
                    node = node.get(text[j])
                    if node is None:
                        break
                    j += 1
                    piece = node.get(0)
                    if piece is not None:
                        arcs.append(piece)
                if not arcs or length[arcs[0]] > 1:
                    arcs.insert(0, -1)
                options.append(arcs)
            arcs = options[-1]
            while arcs:
                piece = arcs.pop()
                if before >= 0 and piece >= 0:
                    ok = allowed.get(before << 32 | piece)
                    if not (self.follows(before, piece) if ok is None else ok):
                        continue
                to = pos + (length[piece] if piece >= 0 else 1)
                if dead is None or (to, piece) not in dead:
                    taken.append(piece)
                    pos, before = to, piece
                    break
            else:
                dead = dead or set()
                dead.add((pos, before))
                options.pop()
                pos -= length[before] if taken.pop() >= 0 else 1
                before = taken[-1] if taken else -1
        if -1 not in taken:
            return taken
        out, pos = [], 0
        for piece in taken:
            out.extend((piece,) if piece >= 0 else self.spell(text[pos]))
            pos += length[piece] if piece >= 0 else 1
        return out

    def spell(self, char: str) -> list[int]:
        found = [self.byte_ids.get(b) for b in char.encode()]
        return [self.unknown] if None in found else found

    def word(self, word: str) -> list[int]:
        """Ids of a normalised word: those of its parts between the places that no piece spans."""
        ids = self.known(word)
        if ids is None:
            pairs = self.pairs
            cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in pairs]
            if cuts:
                ids = []
                for lo, hi in zip([0, *cuts], [*cuts, len(word)]):
                    part = word[lo:hi]
                    found = self.known(part)
                    ids += self.keep(part, self.uncut(part)) if found is None else found
            else:
                ids = self.uncut(word)
            self.keep(word, ids)
        return ids

    def uncut(self, part: str) -> list[int]:
        if self.merges and part.startswith(SPACE + SPACE):
            # runs of white space tie among their pieces; the merges themselves settle ties
            return [x for p in self.merged(part) for x in ((self.ids[p],) if p in self.ids else self.spell(p))]
        return self.path(part)

    def known(self, word: str) -> list[int] | None:
        """Ids remembered in two generations of bounded size."""
        ids = self.memory.get(word)
        if ids is None and (ids := self.older.get(word)) is not None:
            self.keep(word, ids)
        return ids

    def keep(self, word: str, ids: list[int]) -> list[int]:
        if len(word) <= KEEP_CHARS:
            if len(self.memory) >= KEEP_WORDS:
                self.older, self.memory = self.memory, {}
            self.memory[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        body = self.normalise(text)
        if not self.by_word:
            return self.path(body)
        out: list[int] = []
        known, word = self.memory.get, self.word
        for n, line in enumerate(body.split("\n") if self.by_line else [body]):
            if n:
                out += self.line_end
            for w in ([SPACE + x for x in line[1:].split(SPACE)] if line[:1] == SPACE and SPACE + SPACE not in line
                      and line[-1] != SPACE else WORDS.findall(line)):
                out += known(w) or word(w)
            known = self.memory.get
        return out

    def decode(self, ids) -> str:
        """The text spelled by ids; the dummy prefix and control pieces leave nothing."""
        out, kinds = bytearray(), self.kind
        for x in ids:
            if kinds[x] == BYTE:
                out.append(self.byte_values[x])
            elif kinds[x] == UNKNOWN:
                out += UNKNOWN_SURFACE.encode()
            elif kinds[x] != CONTROL:
                out += self.pieces[x].encode()
        text = out.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


#: White space belongs to the word behind it.
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def compile_model(data: bytes) -> Machines:
    """The machines of a model file's bytes."""
    pieces, scores, kinds, model, prefix, squeeze = [], [], [], UNIGRAM, True, True
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own[1].decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kinds.append(own.get(3, NORMAL))
        elif number == 2:
            model = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(_fields(value))
            if own.get(2):
                raise ValueError("the model has a character map; only the identity normaliser is compiled")
            prefix, squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
    m = Machines(pieces, [-s for s in scores], kinds, model == MERGES, prefix, squeeze)
    for i, (piece, kind) in enumerate(zip(pieces, kinds)):
        if kind in (NORMAL, USER):
            m.ids[piece] = i
            node = m.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[0] = i
        elif kind == BYTE:
            m.byte_ids[int(piece[3:5], 16)] = i
            m.byte_values[i] = int(piece[3:5], 16)
        elif kind == UNKNOWN:
            m.unknown = i
    m.far = 10.0 + max((w for w, k in zip(m.weight, kinds) if k == NORMAL), default=0.0)
    m.length = [len(p) for p in pieces]
    m.pairs = {p[i:i + 2] for p in m.ids for i in range(len(p) - 1)}
    m.by_word = not any(SPACE in p.lstrip(SPACE) for p in m.ids)
    # a line end that no piece holds is spelled alone, whatever its neighbours
    m.by_line = not any("\n" in p for p in m.ids)
    m.line_end = m.spell("\n") if m.by_line else []
    return m


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids",
           round_trip: str | None = "round_trip") -> DataFrame:
    """``docs`` with the ids of each text (array of int) and, if named, whether decoding them
    gives the text back.  The model file is read where the query is built; executors get its bytes."""
    with open(model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    docs = docs.drop(ids, *([round_trip] if round_trip else []))  # old columns of these names are replaced
    extra = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if round_trip:
        extra.append(T.StructField(round_trip, T.BooleanType()))
    schema = T.StructType([*docs.schema.fields, *extra])

    def run(batches):
        machines = worker_memory("pieces", shared.value, lambda: compile_model(shared.value))
        for whole in batches:
            for k in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(k, TOGETHER)
                flat, ends, same = array("i"), [0], []
                for t in batch.column(batch.schema.get_field_index(text)):
                    t = t.as_py()
                    x = machines.encode(t)
                    flat.extend(x)
                    ends.append(len(flat))
                    if round_trip:
                        same.append(machines.decode(x) == (machines.normalise(t or "")[machines.prefix:].replace(SPACE, " ")))
                found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)]))
                columns = [*batch.columns, found] + ([pa.array(same, pa.bool_())] if round_trip else [])
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *[f.name for f in extra]])
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the text that the ids spell; null ids spell null."""
    with open(model_path, "rb") as f:
        shared = rows.sparkSession.sparkContext.broadcast(f.read())
    rows = rows.drop(text)
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        machines = worker_memory("pieces", shared.value, lambda: compile_model(shared.value))
        for batch in batches:
            found = [None if x.as_py() is None else machines.decode(x.as_py())
                     for x in batch.column(batch.schema.get_field_index(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             names=[*batch.schema.names, text])
    return rows.mapInArrow(run, schema)
