"""Token-id files of patched frame-of-reference blocks.

A block of ids keeps its minimum once and each id as the distance from it, packed at a width that a
percentile of these distances chooses.  Distances that need more bits are exceptions: their places
and values follow in two lists and patch the unpacked block.  A file is the blocks one after another
and a foot: where each block begins, which documents there are, and how many ids each has.  So any
stretch of ids is found by the index of blocks and read by its range.

Files hold ranges of ``doc_id`` in ascending order.  Tasks write under fresh names, which become known
only through the rows of the task that succeeded.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderflow.llm.bpe import batches
from orderflow.llm.common import documents, offsets_of, ragged_take, shared_uri, string_buffers
from orderflow.session import stage

BLOCK = 1024  # ids in a block
PERCENTILE = 95  # share of a block's distances that its width has room for
FILE_BYTES = 1 << 27  # bytes of text whose ids a file holds at most, about
SPREAD_BYTES = 1 << 22  # with less text than this for each shuffle partition there are fewer files
READ_BLOCKS = 512  # blocks read at once
MAGIC = b"PFOR0001"
_HEAD = np.dtype([("least", "<u4"), ("n", "<u2"), ("width", "u1"), ("spare", "u1"), ("exceptions", "<u2")])
SLICE = 1 << 18  # words encoded at once
KNOWN = 1 << 19  # words, and parts of words, whose ids a worker remembers
ENCODED = 1 << 19  # characters given to the library at once, whose encodings are far larger than their ids


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; 0 needs none."""
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1))).astype(np.int64) + 1, 0)


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """``ids`` as packed blocks; only the last one may hold fewer than ``BLOCK``."""
    n = len(ids)
    count = -(-n // BLOCK)
    grid = np.zeros(count * BLOCK, np.int64)
    grid[:n] = ids
    grid[n:] = grid[n - 1] if n else 0
    grid = grid.reshape(count, BLOCK)
    sizes = np.full(count, BLOCK)
    if n % BLOCK:
        sizes[-1] = n % BLOCK
    least = grid.min(1)
    away = grid - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)))
    widths = _bits(np.partition(away, rank, axis=1)[:, rank])
    kind = "<u2" if n and away.max() < 1 << 16 else "<u4"
    bits = 8 * np.dtype(kind).itemsize
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        values = away[rows]
        raw = np.unpackbits(values.astype(kind).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        packed = np.packbits(raw.reshape(len(rows), BLOCK, bits)[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")
        over = values >> width > 0
        for k, row in enumerate(rows):
            size = int(sizes[row])
            places = np.flatnonzero(over[k, :size])
            head = np.array([(least[row], size, width, 0, len(places))], _HEAD)
            body = packed[k, : -(-size * int(width) // 8)]
            out[row] = b"".join([head.tobytes(), body.tobytes(), places.astype("<u2").tobytes(), values[k, places].astype("<u4").tobytes()])
    return out


def unpack_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` of ``raw``, one after another."""
    heads = np.array([np.frombuffer(raw, _HEAD, 1, int(s))[0] for s in starts], _HEAD)
    out = np.zeros((len(starts), BLOCK), np.int64)
    for width in np.unique(heads["width"]):
        rows = np.flatnonzero(heads["width"] == width)
        size = BLOCK * int(width) // 8
        data = np.zeros((len(rows), size), np.uint8)
        for k, row in enumerate(rows):
            part = np.frombuffer(raw, np.uint8, -(-int(heads["n"][row]) * int(width) // 8), int(starts[row]) + _HEAD.itemsize)
            data[k, : len(part)] = part
        kind = np.dtype("<u2" if width <= 16 else "<u4")
        bits = np.zeros((len(rows), BLOCK, 8 * kind.itemsize), np.uint8)
        bits[:, :, :width] = np.unpackbits(data, axis=1, bitorder="little").reshape(len(rows), BLOCK, int(width))
        out[rows] = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view(kind)
    for k in np.flatnonzero(heads["exceptions"]):
        n = int(heads["exceptions"][k])
        at = int(starts[k]) + _HEAD.itemsize - (-int(heads["n"][k]) * int(heads["width"][k]) // 8)
        out[k, np.frombuffer(raw, "<u2", n, at)] = np.frombuffer(raw, "<u4", n, at + 2 * n)
    out += heads["least"].astype(np.int64)[:, None]
    keep = np.arange(BLOCK)[None] < heads["n"].astype(np.int64)[:, None]
    return out[keep]


class Writer:
    """Writes one file; ids are packed as blocks fill up, so memory does not grow with the file."""

    def __init__(self, out) -> None:
        self.out, self.at = out, len(MAGIC)
        self.starts: list[int] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 64 * BLOCK:
            self._pack(self.n_held // BLOCK * BLOCK)

    def _pack(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.int64)
        for block in pack_blocks(ids[:n]):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int]:
        """Documents and ids written."""
        self._pack(self.n_held)
        ids = np.array([0 if d is None else d for d in self.docs], "<i8")
        absent = np.array([d is None for d in self.docs], np.uint8)
        parts = [np.array([*self.starts, self.at], "<u8").tobytes(), ids.tobytes(), absent.tobytes(), np.array(self.sizes, "<u8").tobytes()]
        foot = json.dumps({"blocks": len(self.starts), "docs": len(self.docs)}).encode()
        for part in (*parts, foot, len(foot).to_bytes(4, "little"), MAGIC):
            self.out.write(part)
        self.out.close()
        return len(self.docs), sum(self.sizes)


class Reader:
    """Reads one file: its foot first, then only the blocks asked for."""

    def __init__(self, file) -> None:
        self.file = file
        end = file.size() - len(MAGIC) - 4
        tail = file.read_at(len(MAGIC) + 4, end)
        if tail[4:] != MAGIC or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of packed token ids")
        length = int.from_bytes(tail[:4], "little")
        foot = json.loads(file.read_at(length, end - length))
        blocks, docs = foot["blocks"], foot["docs"]
        size = 8 * (blocks + 1) + 17 * docs
        raw = file.read_at(size, end - length - size)
        self.starts = np.frombuffer(raw, "<u8", blocks + 1).astype(np.int64)
        ids, absent = np.frombuffer(raw, "<i8", docs, 8 * (blocks + 1)), np.frombuffer(raw, np.uint8, docs, 8 * (blocks + 1 + docs))
        self.docs = [None if gone else d for d, gone in zip(ids.tolist(), absent.tolist(), strict=True)]
        self.offsets = offsets_of(np.frombuffer(raw, "<u8", docs, 8 * (blocks + 1) + 9 * docs).astype(np.int64))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop`` of the file."""
        if stop <= start:
            return np.empty(0, np.int64)
        first, last = start // BLOCK, -(-stop // BLOCK)
        at = self.starts[first : last + 1]
        raw = self.file.read_at(int(at[-1] - at[0]), int(at[0]))
        return unpack_blocks(raw, at[:-1] - at[0])[start - first * BLOCK : stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """Runs of documents with their offsets in the file and their ids, some blocks at a time."""
        at, n = 0, len(self.docs)
        while at < n:
            stop = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + READ_BLOCKS * BLOCK, side="right")) - 1)
            yield self.docs[at:stop], self.offsets[at : stop + 1], self.ids(int(self.offsets[at]), int(self.offsets[stop]))
            at = stop


@lru_cache(maxsize=2)
def _library(spec: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Words:
    """The library's ids of words, each encoded once.

    The tokenizer drops white space, and no token, special string or composed character reaches across
    it.  Nor does one reach from letters to the marks after them.  So words without these marks are
    encoded, many in one text: plain ones parted by spaces, as their last token tells that it ends a
    word; others by a control character, whose id nothing else has.
    """

    MARK = "\u0001"
    PLAIN, MARKS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", ",.;:!?"  # letters that no normal form changes, and what may follow them
    JOINED = 2000  # words of one text

    def __init__(self, library: Tokenizer) -> None:
        self.library = library
        self.mark = library.encode(self.MARK, add_special_tokens=False).ids
        self.ends = np.array([(library.id_to_token(i) or "").endswith("</w>") for i in range(library.get_vocab_size())])
        self._forget()

    def _forget(self) -> None:
        self.parts: dict[str, int] = {"": 0}  # places of letters without marks, of marks, and of other words
        self.part_ids, self.part_offsets = np.empty(0, np.int32), np.zeros(2, np.int64)

    @staticmethod
    def check(library: Tokenizer) -> None:
        """Raise unless the tokenizer is as described."""

        def ids(text: str) -> list[int]:
            return library.encode(text, add_special_tokens=False).ids

        ok = ids("Words, \t\r\n more") == [*ids("words"), *ids(","), *ids("more")] and len(ids(Words.MARK)) == 1
        if not ok or not all((library.id_to_token(i) or "").endswith("</w>") for w in ("words", "é", Words.MARK) for i in ids(w)[-1:]):
            raise ValueError("the tokenizer does not cut words at white space and marks, or does not tell their ends")

    def _add_parts(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        if len(parts) != len(sizes):
            raise ValueError("words and their ids do not add up")
        self.parts.update(zip(parts, range(len(self.part_offsets) - 1, len(self.part_offsets) - 1 + len(parts)), strict=True))
        self.part_ids = np.concatenate([self.part_ids, ids.astype(np.int32)])
        self.part_offsets = np.concatenate([self.part_offsets, self.part_offsets[-1] + np.cumsum(sizes)])

    def _learn_parts(self, parts: list[str], between: str) -> None:
        texts = [parts[a : a + self.JOINED] for a in range(0, len(parts), self.JOINED)]
        joined = [between.join(t) for t in texts]
        held = offsets_of(np.array([len(t) for t in joined], np.int64))[:-1] // ENCODED
        cuts = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(joined)]
        found = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found += [np.array(own.ids, np.int32) for own in self.library.encode_batch_fast(joined[a:b], add_special_tokens=False)]
        if between == " ":
            sizes = [np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0) for ids in found]
        else:
            marks = [np.flatnonzero(ids == self.mark[0]) for ids in found]
            sizes = [np.diff(np.concatenate(([-1], at, [len(ids)]))) - 1 for ids, at in zip(found, marks, strict=True)]
            found = [np.delete(ids, at) for ids, at in zip(found, marks, strict=True)]
        if [len(n) for n in sizes] != [len(t) for t in texts]:
            raise ValueError("words and their ids do not add up")
        if found:
            self._add_parts(parts, np.concatenate(found), np.concatenate(sizes))

    def _learn_whole(self, parts: list[str]) -> None:
        for part in parts:
            ids = np.array(self.library.encode(part, add_special_tokens=False).ids, np.int64)
            self._add_parts([part], ids, np.array([len(ids)]))

    @staticmethod
    def _ends(words: pa.Array, heads: pa.Array) -> pa.Array:
        """What follows ``heads`` in the ``words`` that begin with them: the even ones of the stretches they cut the bytes into."""
        data, at = string_buffers(words)
        bounds = np.stack([at[:-1] + np.asarray(pc.binary_length(heads)), at[1:]], 1).ravel()
        cut = pa.LargeStringArray.from_buffers(max(2 * len(words) - 1, 0), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data))
        return cut.take(pa.array(np.arange(0, len(cut), 2)))

    def _places(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))

    def encode(self, words: pa.Array, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, one after another, and their number, of the ``word``-th of the distinct ``words`` each.

        Words are taken apart all at once; the ids of their parts are remembered.
        """
        if len(self.parts) > KNOWN:
            self._forget()
        words = pa.array(words, pa.string()) if isinstance(words, np.ndarray) else words
        letters = pc.ascii_rtrim(words, characters=self.MARKS)
        is_plain = pc.match_substring_regex(letters, self.PLAIN)
        plain = np.asarray(is_plain)
        place = np.zeros((len(words), 2), np.int64)  # of letters and of marks; the empty part is at 0
        marks = self._ends(words, letters).filter(is_plain).dictionary_encode()
        letters = pc.utf8_lower(letters.filter(is_plain)).dictionary_encode()
        heads, others, tails = (a.to_numpy(zero_copy_only=False).tolist() for a in (letters.dictionary, words.filter(pc.invert(is_plain)), marks.dictionary))
        for parts, between in ((heads, " "), ([w for w in others if self.MARK not in w], f" {self.MARK} ")):
            self._learn_parts([x for x in parts if x not in self.parts], between)
        whole = [*tails, *[w for w in others if self.MARK in w]]
        self._learn_whole([x for x in whole if x not in self.parts])
        for k, (parts, coded) in enumerate(((heads, letters), (tails, marks))):
            place[plain, k] = self._places(parts)[np.asarray(coded.indices)]
        place[~plain, 0] = self._places(others)
        ids, sizes = ragged_take(self.part_ids, self.part_offsets, place.ravel())
        return ragged_take(ids, offsets_of(sizes[::2] + sizes[1::2]), word)


@lru_cache(maxsize=1)
def _words(spec: str) -> Words:
    """Of this worker, which keeps what it has learnt from one task to the next."""
    return Words(_library(spec))


def write_files(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Encode ``docs`` into files in ascending order of ``doc_id``; returns a row per file: ``path``, ``file``, ``docs``, ``n``, ``start``.

    ``start`` is the number of ids in all files before.  Rows of one id, and those without one, which
    come first, keep the order they were read in.  Texts are put in order before they are encoded, so
    each is encoded once and its ids go straight into a file.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    Words.check(_library(spec))
    folder = shared_uri(spark, "token-ids")
    shared = spark.sparkContext.broadcast(spec)
    rows = documents(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // SPREAD_BYTES), -(-total // FILE_BYTES))
    ordered = numbered.repartitionByRange(parts, "doc_id", "_at").sortWithinPartitions("doc_id", "_at")
    cut = ordered.select("doc_id", F.regexp_extract_all("text", F.lit(r"[^ \t\r\n]+"), F.lit(0)).alias("words"))

    def write(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        words, writer, name = _words(shared.value), None, uuid.uuid4().hex
        for table in tables:
            for piece, distinct, word, ends in batches(table, "words", SLICE):
                writer = writer or Writer(fs.open_output_stream(f"{root}/{name}", compression=None))
                ids, lengths = words.encode(distinct, word)
                ends = offsets_of(lengths)[ends]
                for doc, a, b in zip(piece.column("doc_id").to_pylist(), ends[:-1], ends[1:], strict=True):
                    writer.add(doc, np.append(ids[a:b], end))
        if writer is not None:
            n_docs, n = writer.close()
            yield pa.record_batch([pa.array([x]) for x in (f"{folder}/{name}", TaskContext.get().partitionId(), n_docs, n)], ["path", "file", "docs", "n"])

    files = stage(cut.mapInArrow(write, "path string, file long, docs long, n long"), "token-id-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return stage(files.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "token-id-starts")


def read_files(files: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids``, little-endian unsigned 32-bit integers."""
    n = files.count()

    def read(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for path, base in zip(table.column("path").to_pylist(), table.column("start").to_pylist(), strict=True):
                fs, name = FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    for docs, offsets, ids in Reader(file).documents():
                        raw, at = ids.astype("<u4").tobytes(), 4 * (offsets - offsets[0])
                        data = pa.array([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                        yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(base + offsets[:-1]), pa.array(np.diff(offsets)), data], ["doc_id", "start", "n_tokens", "ids"])

    spread = files.repartitionByRange(max(n, 1), "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def binary_output(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Encode ``docs`` (``doc_id``, ``text``), write the ids to files, and read every document back from them.

    Null and empty texts are the closing id alone; repeated rows are documents each; rows without id come
    first; further columns are ignored; an empty table gives no file and no row.
    """
    return read_files(write_files(docs, tokenizer, end))
