"""Token ids in seekable Zstandard files.

A file is a run of Zstandard frames and skippable frames that any Zstandard decoder reads:

    header (skippable) | one frame per document | document index (skippable) | seek table (skippable)

Each document's ids, little-endian unsigned 32-bit with the end id, are an independent frame.  The
seek table has the sizes and the XXH64 checksum of every frame, so that a reader fetches the table
and the index, then only the bytes of the documents asked for, and proves them.

Documents are written in ascending doc_id order: a range partition of the rows, sorted, is a run
of files whose names sort the same way.  Offsets over all files come from the files' totals.

Defined cases: a null or empty text is the end id alone; null ids sort first; equal ids follow
one another, ordered by a hash of their text; an empty table writes no file.
"""

from __future__ import annotations

import json
import re
import string
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import open_folder, put_file, saved, spread, worker_memory

# fixed values of the Zstandard seekable format
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 1 << 7
ENTRY, ENTRY_BYTES, FOOTER, FOOTER_BYTES = "<III", 12, "<IBI", 9

FILE_BYTES = 8 << 20
END_ID = 0
#: Words and runs of marks that a worker remembers in each of two generations, some 200 bytes each.
KEEP_WORDS = 300_000
#: Bytes of text whose words are looked up together, unless one text has more.
TEXT_BYTES = 8 << 20
#: Unknown words encoded as one text, and how the vocabulary spells a space before a word.
TOGETHER, SPACE_MARK = 500, "Ġ"


# fixed values: the white space of the pre-tokenizer's patterns, and what is no single gap
GAPS = " \n"
UNUSUAL = ("  ", "\n\n", " \n", "\n ", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u1680",
           *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")


#: Words that are one pre-token, whatever the age of the pre-tokenizer's tables: Latin letters only.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
LETTER_LIST = pa.array(filter(LETTERS, map(chr, range(0x250))), pa.large_string())


class Encoder:
    """Ids of texts as bytes, by a byte-level tokenizer whose pre-tokens never reach from a word
    into the single space or line end before the next word.  Words repeat, within some texts and
    beyond them: each different word of a few texts is looked up once, and its ids are remembered
    in two generations of bounded size, so that words in use stay.  Words not known yet are encoded many at
    a time, as one text in which their first tokens tell them apart.  A word of letters is a pre-token
    by itself, so such words are handed over in the vocabulary's own spelling of bytes, cut at blanks, which
    spares the pre-tokenizer's patterns; marks behind a letter at a word's end are a pre-token too
    and are looked up by themselves.  Texts with any other white space are encoded whole."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.by_blank = Tokenizer.from_str(tokenizer_json)
        self.by_blank.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]      # bytes that spell themselves; the rest follow U+0100
        rest = iter(range(256, 512))
        self.spelling = {b: b if b in printable else next(rest) for b in range(256)}
        self.spelling[32] = f" {SPACE_MARK}"
        #: ids by part of a text: a word behind a space, a line end and its first word, or (after
        #: a space, as no word is) marks behind a letter
        self.fresh: dict[str, bytes] = {"": b""}
        self.stale: dict[str, bytes] = {}
        self.line_end = self._whole(["\n"])[0]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.opens[i] = piece.startswith(SPACE_MARK)
        # apostrophes open contractions, and no mark may be cut off an added token
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = "".join(set(string.punctuation).difference("'_", added))
        self.ends = np.zeros(len(self.opens), bool)
        self.ends[np.frombuffer(self.line_end, "<u4")] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str], spaced: bool, letters: bool = False):
        """(word, ids) of words without white space, each behind a space or at the start of a line."""
        tokenizer = self.by_blank if letters else self.tokenizer
        for lo in range(0, len(words), TOGETHER):
            some = words[lo:lo + TOGETHER]
            text = " " + " ".join(some) if spaced else "\n".join(some)
            if letters:
                text = text.encode().decode("latin-1").translate(self.spelling)
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            if spaced:
                start = np.flatnonzero(self.opens[ids])
                stop = np.append(start[1:], len(ids))
            else:
                cut = np.flatnonzero(self.ends[ids])
                start, stop = np.concatenate([[0], cut + 1]), np.append(cut, len(ids))
            if len(start) != len(some):
                raise ValueError("the tokenizer joins words over white space")
            data = ids.tobytes()
            yield from ((w, data[4 * i:4 * j]) for w, i, j in zip(some, start.tolist(), stop.tolist()))

    def _learn(self, parts: list[str]) -> None:
        kinds = {"simple": [], "other": [], "\n": [], " ": []}
        for p in parts:
            kinds[p[0] if p[0] in GAPS else "simple" if LETTERS(p) else "other"].append(p)
        self.fresh.update(self._together(kinds["simple"], True, True))
        self.fresh.update(self._together(kinds["other"], True))
        heads = self._together([p[1:] for p in kinds["\n"]], False)
        self.fresh.update(("\n" + w, self.line_end + ids) for w, ids in heads)
        self.fresh.update(zip(kinds[" "], self._whole([p[1:] for p in kinds[" "]])))

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts."""
        if len(self.fresh) > KEEP_WORDS:
            self.stale, self.fresh = self.fresh, {"": b""}
        fresh, stale = self.fresh, self.stale
        found = list(map(fresh.get, parts))
        unknown = [k for k, ids in enumerate(found) if ids is None]
        missing = []
        for k in unknown:
            part = parts[k]
            if part in stale:
                fresh[part] = stale[part]
            else:
                missing.append(part)
        self._learn(missing)
        for k in unknown:
            found[k] = fresh[parts[k]]
        return found

    def _parts(self, words: pa.Array) -> pa.DictionaryArray:
        """The part before the marks of each word, then the marks behind a letter of each word, empty if none."""
        stems = pc.ascii_rtrim(words, self.marks)
        cut = pc.and_(pc.less(pc.binary_length(stems), pc.binary_length(words)),
                      pc.is_in(pc.utf8_slice_codeunits(stems, -1), value_set=LETTER_LIST))
        ends = zip(_strings(words.filter(cut)), pc.utf8_length(stems.filter(cut)).to_numpy().tolist())
        marks = pc.replace_with_mask(pa.repeat(pa.scalar("", pa.large_string()), len(words)), cut,
                                     pa.array([" " + w[n:] for w, n in ends], pa.large_string()))
        return pa.concat_arrays([pc.if_else(cut, stems, words), marks]).dictionary_encode()

    def _by_word(self, texts: list[str]) -> list[bytes]:
        cut = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        words = cut.flatten().dictionary_encode()
        parts = self._parts(words.dictionary)
        ids = self._ids(_strings(parts.dictionary))
        # the ids of both parts of all words in turn: a part takes n ids of all ids, from first on
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = parts.indices.to_numpy().reshape(2, -1).T[words.indices.to_numpy()].ravel()
        n, first = size[at], (np.cumsum(size) - size)[at]
        stop = np.cumsum(n)
        picked = np.repeat(first - (stop - n), n)
        picked += np.arange(len(picked))
        data = np.frombuffer(b"".join(ids), "<u4")[picked].tobytes()
        edges = (4 * np.concatenate([[0], stop])[2 * cut.offsets.to_numpy().astype(np.int64)]).tolist()
        return [data[i + len(self.line_end):j] for i, j in zip(edges, edges[1:])]

    def payloads(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        usual = [bool(t) and t[0] not in GAPS and t[-1] not in GAPS and not any(g in t for g in UNUSUAL) for t in texts]
        by_word = [t for t, u in zip(texts, usual) if u]
        cut = iter(self._by_word(by_word) if by_word else [])
        whole = iter(self._whole([t for t, u in zip(texts, usual) if not u]))
        return [next(cut if u else whole) for u in usual]


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _runs(texts: pa.Array, most: int = TEXT_BYTES):
    """(start, number) of neighbouring rows that hold about ``most`` bytes or are one row."""
    end = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(end):
        before = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, before + most, "right")))
        yield start, stop - start
        start = stop


def _skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


def build_file(documents: list[tuple[int | None, bytes]], meta: dict) -> bytes:
    """A whole file of (doc_id, payload), in the order given."""
    zip_ = zstandard.ZstdCompressor(level=3, write_checksum=True)
    body, table = bytearray(), bytearray()

    def add(frame: bytes, plain: bytes):
        body.extend(frame)
        table.extend(struct.pack(ENTRY, len(frame), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
    add(_skippable(SKIPPABLE, json.dumps(meta, sort_keys=True).encode()), b"")
    for _, payload in documents:
        add(zip_.compress(payload), payload)
    index = b"".join(struct.pack("<?q", i is not None, i or 0) for i, _ in documents)
    add(_skippable(SKIPPABLE, index), b"")
    n = len(documents) + 2
    return bytes(body) + _skippable(SEEK_TABLE, bytes(table) + struct.pack(FOOTER, n, CHECKSUMS, SEEKABLE))


class TokenFile:
    """Random access to a file: reads the seek table and the index, then frames on demand."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flags, magic = struct.unpack(FOOTER, self._read(size - FOOTER_BYTES, FOOTER_BYTES))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("not a seekable Zstandard file with checksums")
        start = size - FOOTER_BYTES - n * ENTRY_BYTES
        head = struct.unpack("<II", self._read(start - 8, 8))
        if head != (SEEK_TABLE, n * ENTRY_BYTES + FOOTER_BYTES):
            raise ValueError("the seek table's frame does not match its entries")
        table = np.frombuffer(self._read(start, n * ENTRY_BYTES), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.plain, self.checks = table[:, 0], table[:, 1], table[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        if self.offsets[-1] != start - 8:
            raise ValueError("the frames do not fill the file")
        self.meta = json.loads(self._read(8, int(self.sizes[0]) - 8))
        index = self._read(int(self.offsets[n - 1]) + 8, int(self.sizes[n - 1]) - 8)
        self.doc_ids = [i if known else None for known, i in struct.iter_unpack("<?q", index)]
        self.unzip = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(n)
        if len(data) != n:
            raise ValueError("the file is cut short")
        return data

    def _frame(self, k: int, data: bytes) -> bytes:
        plain = self.unzip.decompress(data, max_output_size=int(self.plain[k]))
        if len(plain) != self.plain[k] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} fails its checksum")
        return plain

    def document(self, position: int) -> bytes:
        """The ids of one document; no other frame is read."""
        k = position + 1
        return self._frame(k, self._read(int(self.offsets[k]), int(self.sizes[k])))

    def documents(self):
        """All payloads in order; reads the file once."""
        data = self._read(0, int(self.offsets[-1]))
        for k in range(1, len(self.sizes) - 1):
            yield self._frame(k, data[self.offsets[k]:self.offsets[k + 1]])


def write(docs: DataFrame, folder: str, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
          end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the documents' ids into ``folder``; returns its files (name, part, seq, n_docs,
    n_tokens, start), where start counts the ids of all files before."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    end = struct.pack("<I", end_id)

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_memory("token encoder", shared.value, lambda: Encoder(shared.value))
        part, seq = TaskContext.get().partitionId(), 0
        held, size, meta = [], 0, {"format": "token ids", "dtype": "<u4", "end": end_id}

        def flush():
            name = f"{part:08d}-{seq:06d}.tok.zst"
            put_file(folder, name, build_file(held, meta))
            return pa.RecordBatch.from_pylist([{"name": name, "part": part, "seq": seq, "n_docs": len(held),
                                                "n_tokens": size // 4}], schema=made)
        for batch in batches:
            for k, n in _runs(batch.column(1)):
                some = batch.slice(k, n)
                for i, payload in zip(some.column(0).to_pylist(), encoder.payloads(some.column(1).to_pylist())):
                    held.append((i, payload + end))
                    size += len(payload) + 4
                    if size >= 4 * file_bytes:
                        yield flush()
                        held, size, seq = [], 0, seq + 1
        if held:
            yield flush()
    made = pa.schema([("name", pa.string()), ("part", pa.int32()), ("seq", pa.int32()),
                      ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    files = saved(ordered.mapInArrow(run, "name string, part int, seq int, n_docs long, n_tokens long"), "token-files")
    # offsets in two steps: over the parts (as many as shuffle partitions), then inside each part
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (files.join(parts.select("part", "before"), "part")
            .withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("before"))


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids as stored, binary."""
    def run(batches):
        store, base = open_folder(folder)
        for batch in batches:
            for name, start in zip(*(batch.column(c).to_pylist() for c in ("name", "start"))):
                with store.open_input_file(f"{base}/{name}") as source:
                    f = TokenFile(source)
                    payloads = list(f.documents())
                n = np.array([len(p) // 4 for p in payloads], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n),
                     pa.array(payloads, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
    total = 4 * (files.agg(F.sum("n_tokens")).first()[0] or 0)
    return spread(files.select("name", "start"), total).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def lookup(folder: str, names: list[str], wanted: set) -> dict:
    """doc_id -> ids (list of int) of the wanted documents in the named files; reads their frames only."""
    store, base = open_folder(folder)
    out = {}
    for name in names:
        with store.open_input_file(f"{base}/{name}") as source:
            f = TokenFile(source)
            for k, i in enumerate(f.doc_ids):
                if i in wanted:
                    out[i] = np.frombuffer(f.document(k), "<u4").tolist()
    return out
