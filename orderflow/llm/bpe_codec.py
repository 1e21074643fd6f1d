"""BPE encoding and decoding with a minimal acyclic transducer of the corpus's frequent words.

The words are counted over all documents; the most frequent are encoded once and compiled into an
automaton in which words share their prefixes and suffixes.  Edges carry the number of words they
skip, so a path adds up to a word's place in the list of outputs.  The automaton is one file of flat
arrays that Spark ships to the executors and tasks memory-map; whole batches of words walk it
together.  Words it does not hold are merged exactly.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.bpe import Bpe, batches, pretokens, word_ids
from orderflow.llm.common import documents, offsets_of, ragged_take, ship_file, string_buffers
from orderflow.session import stage

_ARRAYS = ("edge_keys", "edge_targets", "edge_skips", "final", "offsets", "ids")


@dataclass
class Transducer:
    """Minimal automaton over bytes; state 0 is the root, an edge's key is state * 256 + byte."""

    edge_keys: np.ndarray
    edge_targets: np.ndarray
    edge_skips: np.ndarray
    final: np.ndarray
    offsets: np.ndarray  # of each word's ids
    ids: np.ndarray

    @classmethod
    def compile(cls, words: Sequence[bytes], ids: np.ndarray, offsets: np.ndarray) -> Transducer:
        """From words in ascending order without repeats, and their ids as a ragged array."""
        edges: list[dict[int, int]] = [{}]
        final = [False]
        known: dict[tuple, int] = {}
        path = [0]  # states along the word last added
        last = b""

        def settle(depth: int) -> None:
            """Replace the states below ``depth`` by equal ones already known."""
            for at in range(len(last), depth, -1):
                state = path.pop()
                shape = (final[state], *edges[state].items())
                same = known.setdefault(shape, state)
                if same != state:
                    edges[path[-1]][last[at - 1]] = same

        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            settle(shared)
            for byte in word[shared:]:
                edges.append({})
                final.append(False)
                edges[path[-1]][byte] = len(edges) - 1
                path.append(len(edges) - 1)
            final[path[-1]] = True
            last = word
        settle(0)

        count: dict[int, int] = {}
        order: list[int] = []  # states met from the root, children before parents at the end
        stack = [(0, False)]
        while stack:
            state, ready = stack.pop()
            if ready:
                count[state] = final[state] + sum(count[t] for t in edges[state].values())
                order.append(state)
            elif state not in count:
                stack.append((state, True))
                stack.extend((t, False) for t in edges[state].values() if t not in count)
        order = list(dict.fromkeys(order))
        name = {state: k for k, state in enumerate(reversed(order))}
        keys, targets, skips = [], [], []
        for state in reversed(order):
            skip = int(final[state])
            for byte, target in sorted(edges[state].items()):
                keys.append(name[state] * 256 + byte)
                targets.append(name[target])
                skips.append(skip)
                skip += count[target]
        ends = np.array([final[state] for state in reversed(order)], bool)
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int32), ends, offsets, ids.astype(np.int32))

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, name)) for name in _ARRAYS]
        head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
        return b"".join([len(head).to_bytes(8, "little"), head, *(a.tobytes() for a in arrays)])

    @classmethod
    def map(cls, path: str) -> Transducer:
        """Memory-map a file of ``to_bytes``; processes of one machine share its pages."""
        raw = np.memmap(path, np.uint8, "r")
        at = 8 + int.from_bytes(raw[:8].tobytes(), "little")
        arrays = []
        for dtype, size in json.loads(raw[8:at].tobytes()):
            end = at + size * np.dtype(dtype).itemsize
            arrays.append(raw[at:end].view(dtype))
            at = end
        return cls(*arrays)

    def find(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Place of each word in the list of outputs, -1 for a word that is not held."""
        lengths = np.diff(offsets)
        place = np.zeros(len(lengths), np.int64)
        state = np.zeros(len(lengths), np.int64)
        alive = np.arange(len(lengths))
        depth = 0
        while len(alive) and len(self.edge_keys):
            alive = alive[lengths[alive] > depth]
            key = state[alive] * 256 + data[offsets[alive] + depth]
            edge = np.searchsorted(self.edge_keys, key)
            edge[edge == len(self.edge_keys)] = 0
            hit = self.edge_keys[edge] == key
            state[alive[~hit]] = -1
            alive, edge = alive[hit], edge[hit]
            state[alive] = self.edge_targets[edge]
            place[alive] += self.edge_skips[edge]
            depth += 1
        held = np.zeros(len(lengths), bool)
        if len(self.edge_keys):
            held[state >= 0] = self.final[state[state >= 0]]
        return np.where(held, place, -1)


def frequent_words(cut: DataFrame, size: int, min_count: int) -> list[bytes]:
    """The most frequent pre-tokens of all rows, ascending: at most ``size``, each seen ``min_count`` times.

    Words are taken by their count, all of one count or none, so only those taken leave their tasks.
    """

    def count(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for _, words, word, _ in batches(table, "pre"):
                yield pa.record_batch([words, pa.array(np.bincount(word, minlength=len(words)))], ["word", "n"])

    counts = cut.select("pre").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stage(counts.filter(F.col("n") >= min_count), "lexicon")
    # the least step of counts that lets in no more than ``size``; big counts share steps, so the list is short
    step = F.when(F.col("n") < 4096, F.col("n")).otherwise((4096 + 256 * F.log2("n")).cast("long"))
    least, taken = 1 << 62, 0
    for r in sorted(counts.groupBy(step.alias("n")).agg(F.count("*").alias("words")).collect(), reverse=True):
        if taken + r.words > size:
            break
        least, taken = r.n, taken + r.words
    return sorted(r.word.encode() for r in counts.filter(step >= least).select("word").collect())


def encode_decode(docs: DataFrame, tokenizer: str, lexicon_size: int = 100_000, min_count: int = 16) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` of every row.

    ``tokenizer`` is the path of a byte-level BPE file, ``lexicon_size`` bounds what the driver
    gathers and the file it ships; both only move work between the automaton and the merging, never
    a result.  Null and empty texts have no ids and decode to an empty text; repeated rows are coded
    each; a null id stays null; further columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    bpe = Bpe.load(tokenizer)
    cut = documents(docs).select("doc_id", pretokens(F.col("text"), bpe).alias("pre"))
    words = [w for w in frequent_words(cut, lexicon_size, min_count) if w.decode() not in bpe.special]
    name = ship_file(spark, "lexicon", Transducer.compile(words, *word_ids(bpe, pa.array([w.decode() for w in words], pa.string()))).to_bytes())
    shared = spark.sparkContext.broadcast(bpe)

    def code(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held = shared.value, Transducer.map(SparkFiles.get(name))
        raw = np.frombuffer(b"".join(bpe.token_bytes), np.uint8)
        raw_offsets = offsets_of(np.array([len(b) for b in bpe.token_bytes]))
        for table in tables:
            for piece, distinct, word, rows in batches(table, "pre"):
                place = held.find(*string_buffers(distinct))
                unseen = np.flatnonzero(place < 0)
                merged, merged_offsets = word_ids(bpe, distinct.take(pa.array(unseen)))
                known, lengths = ragged_take(held.ids, held.offsets, place[place >= 0])
                # one list of outputs: the words held, then those merged
                out = np.concatenate([known, merged])
                out_offsets = offsets_of(np.concatenate([lengths, np.diff(merged_offsets)]))
                line = np.empty(len(place), np.int64)
                line[place >= 0] = np.arange(len(lengths))
                line[unseen] = np.arange(len(lengths), len(place))
                ids, counts = ragged_take(out, out_offsets, line[word])
                ends = offsets_of(counts)[rows]
                text, sizes = ragged_take(raw, raw_offsets, ids)
                text_ends = offsets_of(sizes)[ends]
                ids, text = ids.astype("<u4").tobytes(), text.tobytes()
                yield pa.record_batch(
                    [
                        piece.column("doc_id"),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                        pa.array([text[a:b].decode("utf-8", "replace") for a, b in zip(text_ends[:-1], text_ends[1:], strict=True)], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return cut.mapInArrow(code, "doc_id long, ids binary, decoded string")
