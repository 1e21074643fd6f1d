"""Byte-pair tokenizer files as numpy tables, pre-tokens as Spark columns, merging of ragged arrays.

Spark's own regular expressions cut texts into pre-tokens; a task then holds each batch as one flat
array of distinct words, so nothing is done per word in Python.  ``merge_ragged`` is exact: within a
word the lowest rank is merged first, and a merge can only create pairs of higher rank, since every
vocabulary entry comes from one merge and a pair needs both of its parts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.llm.common import list_offsets, offsets_of, ragged_take, string_buffers

# White space as Unicode has it, and the cut of byte-level tokenizers.
SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
CUT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

NEVER = np.iinfo(np.int32).max
SLICE = 1 << 19  # pre-tokens worked on at once, which bounds the memory of a task


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in a vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Bpe:
    """Tables of one tokenizer: bounded by its vocabulary, small enough to broadcast."""

    byte_ids: np.ndarray  # id of each byte
    pair_keys: np.ndarray  # left id * size + right id, ascending
    pair_ranks: np.ndarray
    merged: np.ndarray  # id made by the merge of each rank
    size: int
    special: dict[str, int]
    token_bytes: list[bytes] = field(repr=False)

    @classmethod
    def load(cls, path: str) -> Bpe:
        """Read a byte-level BPE ``tokenizer.json`` without normalizer, prefix space or word affixes."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and not spec["normalizer"]
        if not plain or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        chars, vocab = _byte_chars(), model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *special.values()])
        token_bytes = [b""] * size
        for token, i in vocab.items():
            token_bytes[i] = bytes(chars[c] for c in token)
        for token, i in special.items():
            token_bytes[i] = token.encode()
        byte_ids = np.zeros(256, np.int32)
        for char, b in chars.items():
            byte_ids[b] = vocab[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        return cls(byte_ids, keys[order], order.astype(np.int32), merged, size, special, token_bytes)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, ``NEVER`` where they do not merge."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)


def merge_ragged(bpe: Bpe, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their offsets for words given as bytes and offsets.

    Rank-synchronous: each round every unfinished word merges all places of its own lowest pair.
    Words without a mergeable pair leave the arrays, so later rounds touch only what still changes.
    """
    words = len(offsets) - 1
    lengths = np.diff(offsets)
    word = np.flatnonzero(lengths)  # the words still in work
    sym, lengths = bpe.byte_ids[data], lengths[word]
    done_sym, done_word, done_len = [], [], []

    def ranks_of(s: np.ndarray, ends: np.ndarray) -> np.ndarray:
        r = np.full(len(s), NEVER, np.int32)
        if len(s) > 1:
            r[:-1] = bpe.rank(s[:-1], s[1:])
        r[ends - 1] = NEVER
        return r

    rank = ranks_of(sym, np.cumsum(lengths)) if len(word) else np.empty(0, np.int32)
    while len(word):
        ends = np.cumsum(lengths)
        low = np.minimum.reduceat(rank, ends - lengths)
        open_ = low != NEVER
        if not open_.all():
            keep = np.repeat(open_, lengths)
            done_sym.append(sym[~keep])
            done_word.append(word[~open_])
            done_len.append(lengths[~open_])
            sym, rank, word, lengths, low = sym[keep], rank[keep], word[open_], lengths[open_], low[open_]
            if not len(word):
                break
        hit = rank == np.repeat(low, lengths)
        at = np.flatnonzero(hit)
        # a run of equal symbols overlaps itself: take every second place from its left end
        follows = np.concatenate(([False], np.diff(at) == 1))
        if follows.any():
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        sym[at] = bpe.merged[rank[at]]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        last = np.zeros(len(sym), bool)
        last[np.cumsum(lengths) - 1] = True
        last[at] |= last[at + 1]
        owner = np.repeat(np.arange(len(word)), lengths)
        lengths = lengths - np.bincount(owner[at], minlength=len(word))
        sym, rank, last = sym[stay], rank[stay], last[stay]
        new = np.cumsum(stay)[at] - 1  # places of the new symbols
        touched = np.zeros(len(sym), bool)
        touched[new] = True
        touched[new[new > 0] - 1] = True
        fresh = np.flatnonzero(touched)
        inner = fresh[~last[fresh]]
        rank[fresh] = NEVER
        rank[inner] = bpe.rank(sym[inner], sym[inner + 1])
    if not done_word:
        return np.empty(0, np.int32), np.zeros(words + 1, np.int64)
    flat, owner, sizes = np.concatenate(done_sym), np.concatenate(done_word), np.concatenate(done_len)
    order = np.argsort(owner)
    ids, _ = ragged_take(flat, offsets_of(sizes), order)
    counts = np.zeros(words, np.int64)
    counts[owner] = sizes
    return ids, offsets_of(counts)


def pretokens(text: Column, bpe: Bpe) -> Column:
    """Array of pre-tokens; a special string inside a text is one of its own, as the library has it."""

    def cut(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(CUT), F.lit(0))

    out = cut(text)
    for token in sorted(bpe.special, key=len):
        pattern = "".join(f"\\x{{{ord(c):x}}}" for c in token)
        parts = F.flatten(F.transform(F.split(text, pattern, -1), lambda p: F.concat(cut(p), F.array(F.lit(token)))))
        out = F.when(F.contains(text, F.lit(token)), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(out)
    if len(bpe.special) > 1:
        raise ValueError("tokenizers with several special strings are not supported")
    return out


def batches(table: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]]:
    """Pieces of a batch, each with its distinct words, the word of every pre-token, and row offsets.

    A piece holds about ``size`` words, or one row if that alone is longer.
    """
    lists = table.column(column)
    ends = list_offsets(lists)[1:]
    start = 0
    while start < table.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        piece = table.slice(start, stop - start)
        lists = piece.column(column)
        coded = lists.flatten().dictionary_encode()
        yield piece, coded.dictionary, np.asarray(coded.indices, dtype=np.int64), list_offsets(lists)
        start = stop


def word_ids(bpe: Bpe, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of distinct words, special strings included."""
    ids, offsets = merge_ragged(bpe, *string_buffers(words))
    for token, i in bpe.special.items():
        at = pc.index(words, token).as_py()
        if at >= 0:
            ids = np.concatenate([ids[: offsets[at]], [np.int32(i)], ids[offsets[at + 1] :]])
            shift = 1 - (offsets[at + 1] - offsets[at])
            offsets = np.concatenate([offsets[: at + 1], offsets[at + 1 :] + shift])
    return ids, offsets


def encode(bpe: Bpe, table: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with the ids of all their rows, one after another, and row offsets."""
    for piece, words, word, rows in batches(table, column):
        ids, offsets = word_ids(bpe, words)
        flat, lengths = ragged_take(ids, offsets, word)
        yield piece, flat, offsets_of(lengths)[rows]
