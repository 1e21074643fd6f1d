"""Alignment of two tokenizers over the same bytes, by galloping intersection of their token ends.

A byte-level BPE cuts a space and the text (A), a sentence-piece model the text, to which it adds that
space (B).  Where both end a token at the same byte, the stretch since the last such place is a group.
The common ends are found by galloping: the shorter list of ends drives an exponential and then a
binary search into the longer one, many stretches of the list at once.  The ranks of the common ends in
both lists slice the groups, and their differences are the groups' sizes.

Two tokens that end together cover the same last bytes, so the bytes of one end with the bytes of the
other.  Pairs of ids that can ever be linked are therefore few and known from the two vocabularies
alone (``linkable``): the corpus-wide counts are a vector of that length, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.bpe import Bpe, batches, pretokens, word_ids
from orderflow.llm.common import documents, list_offsets, offsets_of, ragged_take, released, stage

SPACE = "▁"  # how pieces write a space
LANES = 4096  # stretches of the shorter list that gallop side by side
SLICE = 1 << 17  # pre-tokens, or tokens, worked on at once
SPELLED = 1 << 16  # tokens spelled out at once


@dataclass
class Pieces:
    """A sentence-piece model whose pieces hold spaces at their beginning alone, so that text may be cut before spaces."""

    proto: bytes
    token_bytes: list[bytes]
    space: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        with open(path, "rb") as file:
            proto = file.read()
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        token_bytes = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"{path} has pieces that go on after a space")
            token_bytes.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
        if model.encode("a  b ") != [*model.encode("a"), *model.encode(" b"), model.piece_to_id(SPACE)]:
            raise ValueError(f"{path} does not keep spaces as they are")
        return cls(proto, token_bytes, model.piece_to_id(SPACE))

    def encoder(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.proto)

    def word_ids(self, model: sentencepiece.SentencePieceProcessor, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and offsets of distinct words, each beginning with the space that the model itself puts there."""
        found = model.encode([w[1:] for w in words], num_threads=1)
        found = [[self.space] if w == " " else ids for w, ids in zip(words, found, strict=True)]
        offsets = offsets_of(np.array([len(f) for f in found], np.int64))
        return np.fromiter((i for f in found for i in f), np.int32, offsets[-1]), offsets


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the ascending ``short``, the place of the first of the ascending ``long`` that is not below it.

    The list is cut into lanes which advance together.  Each element starts where its lane's last one
    ended, doubles its step until it is passed, and halves the last step.
    """
    n = len(short)
    if not n:
        return np.empty(0, np.int64)
    depth = -(-n // LANES)
    lanes = -(-n // depth)
    grid = np.full(lanes * depth, short[-1])
    grid[:n] = short
    grid = grid.reshape(lanes, depth)
    top = len(long)
    long = np.append(long, np.iinfo(np.int64).max)
    out = np.empty((lanes, depth), np.int64)
    low = np.searchsorted(long, grid[:, 0])
    out[:, 0] = low
    for t in range(1, depth):
        want, high, step = grid[:, t], low.copy(), 1
        open_ = np.flatnonzero(long[high] < want)
        while len(open_):
            low[open_] = high[open_] + 1
            high[open_] = np.minimum(high[open_] + step, top)
            step *= 2
            open_ = open_[long[high[open_]] < want[open_]]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            below = long[middle] < want[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        out[:, t] = low
    return out.ravel()[:n]


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in either list, of the ends that both have."""
    swap = len(a_ends) > len(b_ends)
    short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
    at = gallop(short, long)
    own = np.flatnonzero(np.append(long, -1)[at] == short)
    return (at[own], own) if swap else (own, at[own])


def linkable(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """Keys (A id * B's size + B id), ascending, of the pairs of which one token's bytes end the other's.

    At most the summed lengths of both vocabularies' tokens, times the ids that share their bytes.
    """
    keys: set[int] = set()
    for one, other, key in ((a_bytes, b_bytes, lambda x, y: x * len(b_bytes) + y), (b_bytes, a_bytes, lambda x, y: y * len(b_bytes) + x)):
        ids: dict[bytes, list[int]] = {}
        for i, raw in enumerate(other):
            if raw:
                ids.setdefault(raw, []).append(i)
        for i, raw in enumerate(one):
            for cut in range(len(raw)):
                keys.update(key(i, j) for j in ids.get(raw[cut:], ()))
    return np.array(sorted(keys), np.int64)


@dataclass
class Vocabularies:
    """Both tokenizers and what follows from them; sizes depend on the vocabularies alone."""

    a: Bpe
    b: Pieces
    a_lengths: np.ndarray
    b_lengths: np.ndarray
    links: np.ndarray  # as of ``linkable``

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Vocabularies:
        a, b = replace(Bpe.load(a_path), special={}), Pieces.load(b_path)  # special strings are plain text
        lengths = [np.array([len(x) for x in v.token_bytes], np.int64) for v in (a, b)]
        return cls(a, b, *lengths, linkable(a.token_bytes, b.token_bytes))


def _spelled(raw: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """The words of a ragged array that ``ids`` name, one after another; taken by stretches, as an index of bytes is wide."""
    return b"".join(ragged_take(raw, offsets, ids[a : a + SPELLED])[0].tobytes() for a in range(0, len(ids), SPELLED))


def _same_bytes(v: Vocabularies, a: np.ndarray, a_rows: np.ndarray, b: np.ndarray, b_rows: np.ndarray) -> np.ndarray:
    """Rows whose tokens spell the same bytes on both sides."""
    texts = []
    for ids, rows, vocabulary, lengths in ((a, a_rows, v.a, v.a_lengths), (b, b_rows, v.b, v.b_lengths)):
        raw = np.frombuffer(b"".join(vocabulary.token_bytes), np.uint8)
        texts.append((_spelled(raw, offsets_of(lengths), ids), offsets_of(lengths[ids])[rows]))
    (x, x_rows), (y, y_rows) = texts
    return np.array([x[x_rows[k] : x_rows[k + 1]] == y[y_rows[k] : y_rows[k + 1]] for k in range(len(a_rows) - 1)], bool)


def encode_both(docs: DataFrame, v: Vocabularies) -> DataFrame:
    """``doc_id`` and the ids of either tokenizer, little-endian unsigned 16- or 32-bit, of every row; none where the bytes differ."""
    shared = docs.sparkSession.sparkContext.broadcast(v)
    kinds = [np.dtype("<u2" if len(n) <= 1 << 16 else "<u4") for n in (v.a_lengths, v.b_lengths)]
    rows = documents(docs)
    whole = F.concat(F.lit(" "), F.col("text"))
    none = F.array().cast("array<string>")
    full = F.col("text") != ""
    cut = rows.select(
        "doc_id",
        F.when(full, pretokens(whole, v.a)).otherwise(none).alias("a"),
        F.when(full, F.regexp_extract_all(whole, F.lit(" +[^ ]*"), F.lit(0))).otherwise(none).alias("b"),
    )

    def encode(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        model = v.b.encoder()
        for table in tables:
            for piece, words, word, rows in batches(table, "a", SLICE):
                ids, offsets = word_ids(v.a, words)
                a, lengths = ragged_take(ids, offsets, word)
                a_rows = offsets_of(lengths)[rows]
                lists = piece.column("b")
                coded = lists.flatten().dictionary_encode()
                ids, offsets = v.b.word_ids(model, coded.dictionary.to_pylist())
                b, lengths = ragged_take(ids, offsets, np.asarray(coded.indices, dtype=np.int64))
                b_rows = offsets_of(lengths)[list_offsets(lists)]
                same = _same_bytes(v, a, a_rows, b, b_rows)
                out = []
                for side, ends, kind in ((a, a_rows, kinds[0]), (b, b_rows, kinds[1])):
                    raw, size = side.astype(kind).tobytes(), kind.itemsize
                    out.append(pa.array([raw[size * x : size * y] if ok else b"" for x, y, ok in zip(ends[:-1], ends[1:], same, strict=True)], pa.binary()))
                yield pa.record_batch([piece.column("doc_id"), *out], ["doc_id", "a", "b"])

    return cut.mapInArrow(released(encode), "doc_id long, a binary, b binary")


def _aligned(table: pa.RecordBatch, v: Vocabularies) -> Iterator[tuple]:
    """Slices of encoded rows with both sides' ids and row offsets, and the ranks of their common ends."""
    sides = []
    for name, lengths in (("a", v.a_lengths), ("b", v.b_lengths)):
        kind = np.dtype("<u2" if len(lengths) <= 1 << 16 else "<u4")
        values = [x.as_buffer() for x in table.column(name)]
        rows = offsets_of(np.array([x.size // kind.itemsize for x in values], np.int64))
        sides.append((values, rows, kind, lengths))
    (_, rows, _, _), start = sides[0], 0
    while start < table.num_rows:
        stop = max(start + 1, int(np.searchsorted(rows, rows[start] + SLICE, side="right")) - 1)
        parts = []
        for values, ends, kind, lengths in sides:
            ids = np.concatenate([np.frombuffer(x, kind) for x in values[start:stop]]).astype(np.int64)
            parts += [ids, ends[start : stop + 1] - ends[start], np.cumsum(lengths[ids])]
        a, a_rows, a_ends, b, b_rows, b_ends = parts
        yield (table.slice(start, stop - start), a, a_rows, b, b_rows, *common_ends(a_ends, b_ends))
        start = stop


def link_counts(coded: DataFrame, v: Vocabularies) -> np.ndarray:
    """How many links of the corpus hold each linkable pair; a vector of the vocabularies' size."""
    shared = coded.sparkSession.sparkContext.broadcast(v)

    def count(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        n = np.zeros(len(v.links), np.int64)
        for table in tables:
            for _, a, _, b, _, i, j in _aligned(table, v):
                n += np.bincount(np.searchsorted(v.links, a[i] * len(v.b_lengths) + b[j]), minlength=len(n))
        met = np.flatnonzero(n)
        yield pa.record_batch([pa.array(met), pa.array(n[met])], ["pair", "n"])

    out = np.zeros(len(v.links), np.int64)
    counted = stage(coded.mapInArrow(released(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "link-counts")
    for r in counted.collect():  # at most a row per linkable pair
        out[r.pair] = r.n
    return out


def _decimal(size: int, ends: str) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids followed by each of the characters ``ends``, as a ragged array."""
    words = [f"{i}{c}".encode() for c in ends for i in range(size)]
    return np.frombuffer(b"".join(words), np.uint8), offsets_of(np.array([len(w) for w in words], np.int64))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``.

    ``groups`` lists the ids of every group, ``a1,a2|b1;a3|b2,b3``.  A link is a token of A and one of B that
    end together; ``count_sum`` adds up how often the links' id pairs are linked in the whole corpus, and
    ``n_best`` counts the links whose pair is the most frequent one, ties included, of its B id.  Null and
    empty texts, and those which the tokenizers do not spell alike, have no tokens, zeros and an empty
    list.  Repeated rows are aligned and counted each; a null id stays null; further columns are ignored;
    an empty table gives an empty one.
    """
    v = Vocabularies.load(a_path, b_path)
    coded = stage(encode_both(docs, v), "aligned-ids")
    counts = link_counts(coded, v)
    most = np.zeros(len(v.b_lengths), np.int64)
    b_of = v.links % len(v.b_lengths)
    np.maximum.at(most, b_of, counts)
    shared = docs.sparkSession.sparkContext.broadcast((v, counts, counts == most[b_of]))

    def lay(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, counts, best = shared.value
        n_a, n_b = len(v.a_lengths), len(v.b_lengths)
        (a_text, a_offsets), (b_text, b_offsets) = _decimal(n_a, ",|"), _decimal(n_b, ",;")
        text, offsets = np.concatenate([a_text, b_text]), np.concatenate([a_offsets, a_offsets[-1] + b_offsets[1:]])
        for table in tables:
            for piece, a, a_rows, b, b_rows, i, j in _aligned(table, v):
                pair = np.searchsorted(v.links, a[i] * n_b + b[j])
                rows = np.searchsorted(i, a_rows)  # of the links
                # A's tokens of a group come before B's; the last one of either side has another separator
                order = np.empty(len(a) + len(b), np.int64)
                a_sizes, b_sizes = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
                a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                a_last[i], b_last[j] = n_a, n_b
                order[np.arange(len(a)) + np.repeat(j + 1 - b_sizes, a_sizes)] = a + a_last
                order[np.arange(len(b)) + np.repeat(i + 1, b_sizes)] = 2 * n_a + b + b_last
                ends = offsets_of((offsets[1:] - offsets[:-1])[order])[a_rows + b_rows]
                raw = _spelled(text, offsets, order)
                total, top = offsets_of(counts[pair]), offsets_of(best[pair].astype(np.int64))
                numbers = [np.diff(a_rows), np.diff(b_rows), np.diff(rows), np.diff(rows), np.diff(top[rows]), np.diff(total[rows])]
                groups = pa.array([raw[x : y - 1].decode() if y > x else "" for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.string())
                yield pa.record_batch([piece.column("doc_id"), *map(pa.array, numbers), groups], ["doc_id", *_NUMBERS, "groups"])

    return coded.mapInArrow(released(lay), f"doc_id long, {', '.join(f'{c} long' for c in _NUMBERS)}, groups string")


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
