"""Mixture-controlled packing: deficit round-robin over source queues into windows of sequences.

Every source is a queue of its documents' tokens.  A window of ``window_sequences`` sequences takes
from each queue its share of the window; the fraction of a token that a share leaves over is carried
as that queue's deficit into the next window.  The state of the round-robin after any number of
windows has a closed form, so each document finds its own windows and places from its position in
its queue, without a walk over windows: tasks carry deficits across partitions by arithmetic.
The stream of windows is cut into sequences, so only the last one is padded.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.bpe import Bpe, encode, pretokens
from orderflow.llm.common import documents, released, stage

MAX_QUEUES = 1024  # bound of what the driver sees of the sources; the rest shares one queue
REST = "rest"  # its name; queues of one source are named s:source
PIECE_ROWS = 1024


@dataclass(frozen=True)
class Segment:
    """A stretch of one queue during which the set of unfinished queues does not change."""

    start: int  # in the queue
    end: int
    low: int  # tokens of the earlier queues within this phase, then with this one
    high: int
    total: int  # tokens of the phase
    base: int  # tokens of the phases before


def segments(totals: dict[str, int], targets: dict[str, float] | None = None) -> dict[str, list[Segment]]:
    """The round-robin as phases: in each, all unfinished queues run at their proportions.

    Without targets all proportions are those of the corpus and all queues end together: one phase.
    """
    weights = {q: float(targets[q]) for q in totals} if targets else {q: float(n) for q, n in totals.items()}
    at = dict.fromkeys(totals, 0)
    out: dict[str, list[Segment]] = {q: [] for q in totals}
    base = 0
    while any(at[q] < totals[q] for q in totals):
        live = [q for q in totals if at[q] < totals[q]]
        time = {q: (totals[q] - at[q]) / weights[q] for q in live}
        first = min(time.values())
        take = {q: totals[q] - at[q] if not targets or time[q] == first else min(totals[q] - at[q], int(first * weights[q])) for q in live}
        total, low = sum(take.values()), 0
        for q in live:
            if take[q]:
                out[q].append(Segment(at[q], at[q] + take[q], low, low + take[q], total, base))
            at[q] += take[q]
            low += take[q]
        base += total
    return out


def places(parts: list[Segment], start: int, end: int, window: int) -> Iterator[tuple[int, int, int]]:
    """(tokens before, length, place in the stream) of the pieces of ``start:end`` of a queue."""
    for s in parts:
        a, b = max(start, s.start), min(end, s.end)
        if a >= b:
            continue

        def served(w: int, s: Segment = s) -> tuple[int, int, int]:
            """Window ``w``'s start, the earlier queues' tokens before it, and this queue's."""
            x = min(w * window, s.total)
            low = x * s.low // s.total
            return x, low, s.start + x * s.high // s.total - low

        w = (a - s.start) * s.total // ((s.high - s.low) * window)
        while w and served(w)[2] > a:
            w -= 1
        while served(w + 1)[2] <= a:
            w += 1
        while a < b:
            (x, low, mine), (_, next_low, next_mine) = served(w), served(w + 1)
            stop = min(b, next_mine)
            if stop > a:
                yield a - start, stop - a, s.base + x + (next_low - low) + (a - mine)
                a = stop
            w += 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = 2048,
    window_sequences: int = 64,
    eos: int = 1,
    targets: dict[str, float] | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.

    A document's tokens are its ids and ``eos``.  ``targets`` gives the weight of every source
    in a window; when a queue ends, the others share its place.  Without it the proportions are the
    corpus's own.  Sources that would not even get two tokens of a window on average, or are not among
    the 1024 largest, share a queue, in the order of their hashes.  ``targets`` must name every source.  ``ids`` are little-endian unsigned
    32-bit integers.  Null and empty texts are the closing id alone; a null source is one named '';
    repeated rows are packed each; a null id stays null; further columns are ignored; an empty table
    gives no piece.  Long documents go on in the next sequences.
    """
    spark = docs.sparkSession
    bpe = Bpe.load(tokenizer)
    shared = spark.sparkContext.broadcast(bpe)
    window = sequence * window_sequences
    width = np.dtype("<u2" if max(bpe.size, eos + 1) <= 1 << 16 else "<u4")  # of the ids while staged

    def tokenize(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        served: dict[str, int] = defaultdict(int)  # tokens of each source so far in this partition
        for table in tables:
            for piece, ids, ends in encode(shared.value, table, "pre"):
                data, before = [], []
                sizes = np.diff(ends) + 1
                for source, a, b in zip(piece.column("source").to_pylist(), ends[:-1], ends[1:], strict=True):
                    before.append(served[source])
                    served[source] += int(b - a) + 1
                    data.append(ids[a:b].astype(width).tobytes() + width.type(eos).tobytes())
                yield pa.record_batch(
                    [pa.array([part] * len(data), pa.int32()), piece.column("doc_id"), piece.column("source"), pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())],
                    ["part", "doc_id", "source", "before", "n", "ids"],
                )

    cut = documents(docs, "source").select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), pretokens(F.col("text"), bpe).alias("pre"))
    coded = stage(cut.mapInArrow(released(tokenize), "part int, doc_id long, source string, before long, n long, ids binary"), "pack")

    sums = coded.groupBy("source", "part").agg(F.sum("n").alias("n"))
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    total = by_source.agg(F.sum("n")).first()[0] or 0
    top = {r.source: r.n for r in by_source.orderBy(F.desc("n"), "source").limit(MAX_QUEUES).collect()}
    if targets is not None:
        weight = sum(targets.values())
        if by_source.count() > len(top) or not set(top) <= set(targets) or min(targets.values()) * window < 2 * weight:
            raise ValueError(f"targets must give every source, {MAX_QUEUES} at most, a weight worth two tokens of a window")
        targets = {f"s:{s}": w for s, w in targets.items()}
        totals = {f"s:{s}": n for s, n in sorted(top.items())}
    else:
        totals = {f"s:{s}": n for s, n in sorted(top.items()) if n * window >= 2 * total}
        rest = total - sum(totals.values())
        if rest:
            totals[REST] = rest
    queues = spark.createDataFrame([(q[2:], q) for q in totals if q != REST], "source string, queue string")

    # where each partition's part of a source begins in its queue
    order = Window.partitionBy("queue").orderBy(F.xxhash64("source"), "source", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sums.join(F.broadcast(queues), "source", "left")
        .withColumn("queue", F.coalesce("queue", F.lit(REST)))
        .select("source", "part", "queue", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    )
    placed = coded.join(stage(bases, "pack-bases"), ["source", "part"])
    plan = segments(totals, targets)

    def lay(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        for table in tables:
            rows: list[tuple] = []
            for doc, queue, at, n, raw in zip(*(table.column(c).to_pylist() for c in ("doc_id", "queue", "at", "n", "ids")), strict=True):
                ids = np.frombuffer(raw, width).astype("<u4")
                for start, length, place in places(plan[queue], at, at + n, window):
                    while length:  # a piece ends where its sequence does
                        room = min(length, sequence - place % sequence)
                        rows.append((doc, start, room, n, place // sequence, place % sequence, ids[start : start + room].tobytes()))
                        start, place, length = start + room, place + room, length - room
                if len(rows) >= PIECE_ROWS:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    ready = placed.select("doc_id", "queue", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    return ready.mapInArrow(released(lay), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
