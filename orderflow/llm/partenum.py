"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles fall into bands of equal size.  A band cuts the domain of shingle hashes into
partitions, and a set's signature in a partition is what it holds there.  Two sets as similar as asked
for differ in at most ``k`` shingles, so in at most ``k`` partitions, and agree on all the others.
With the partitions of either set in one common order, it then suffices to enumerate the first
``k + 1``: some signature among them is shared.  The order puts partitions first that hold a shingle
not common in a sample, so that passages many texts share do not bring them together; the choice
moves work and never a result.  Empty partitions come last and are enumerated only by sets too small
to fill enough.  A set also signs in the next band where larger partners may lie.

Signatures travel as sorted blocks of columns to ranges of their hashes.  There, sets that share one
are grouped around the smallest of them.  Sketches that bound the distance of two sets from below rule out most of a group,
and what they leave is compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import documents, hash_sample, released, released_groups, stage
from orderflow.llm.shingles import digests, mix, slices
from orderflow.operators.skew import left_join_unique

SAMPLE = 20_000  # texts that tell which shingles are common
COMMON = 200_000  # of them remembered at most
RANGE = 1 << 21  # signatures a task sorts at once
WIDE = 4 * RANGE  # a range that holds more has some very common ones, and is dealt out by rows
CHUNK = 1024  # sets of a group compared in one task, and
CHUNK_SHINGLES = 1 << 20  # the shingles they have together, on average
KNOWN = 1 << 16  # sets a task remembers, to work on copies once
FILTER_BITS = 16  # per id of a filter of ids; two in a thousand others pass
FILTER_IDS = 1 << 22  # more ids than this (a filter of 8 MB) meet the texts by a join instead
_NUM, _DEN = 3, 4  # similarity


def band_of(n: np.ndarray) -> np.ndarray:
    """Sizes up to 2, 4, 8 ... are bands 1, 2, 3 ..."""
    return np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64)


def signatures(sets: np.ndarray, offsets: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of the partitions each set enumerates, in all bands it signs in."""
    n = np.diff(offsets)  # sets of one or two shingles link with equal ones alone, and those are one class
    at = np.searchsorted(common, sets)
    at[at == len(common)] = 0
    rare = common[at] != sets if len(common) else np.ones(len(sets), bool)
    keys, owners = [], []
    own = band_of(n)
    for band, rows in ((own, n > 2), (band_of(n * _DEN // _NUM), (n > 2) & (band_of(n * _DEN // _NUM) > own))):
        rows = np.flatnonzero(rows)
        size = n[rows]
        owner = np.repeat(rows, size)
        at = np.repeat(offsets[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        parts = np.ceil(0.45 * np.exp2(band)).astype(np.int64) + 6
        h = sets[at]
        part = ((h >> np.uint64(32)) * parts[owner].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(h), bool)  # sets are sorted, so a partition of hashes by range is a run
        new[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        held, part, owner = np.add.reduceat(mix(h, 5), first), part[first], owner[first]
        weak = ~np.logical_or.reduceat(rare[at], first)
        place = mix(part * np.uint64(64) + band[owner].astype(np.uint64), 6)
        key = mix(held ^ place, 7)
        # the smaller of two sets differs from the larger in at most a third of its size
        k = size // 3
        order = np.lexsort((key, weak, owner))
        key, owner = key[order], owner[order]
        filled = np.bincount(owner, minlength=len(n))[rows]
        rank = np.arange(len(key)) - np.repeat(np.cumsum(filled) - filled, filled)
        keep = rank <= np.repeat(k, filled)
        keys.append(key[keep])
        owners.append(owner[keep])
        for r, want in zip(rows[filled <= k], (k + 1 - filled)[filled <= k], strict=True):
            a = int(offsets[r])
            have = ((sets[a : a + n[r]] >> np.uint64(32)) * np.uint64(parts[r])) >> np.uint64(32)
            empty = np.setdiff1d(np.arange(parts[r], dtype=np.uint64), have)[: int(want)]
            keys.append(mix(mix(empty * np.uint64(64) + np.uint64(band[r]), 6), 7))
            owners.append(np.full(len(empty), r))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _planes(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, so that equal high bytes compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplane(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``left`` and ``right`` sets that link."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    _, feature, count = np.unique(flat, return_inverse=True, return_counts=True)
    feature = feature.ravel()
    shared = count[feature] > 1
    number = np.cumsum(count > 1) - 1
    owner, feature = owner[shared], number[feature[shared]]
    both = np.zeros((len(left), len(right)), np.float32)  # counts below 2**24 are exact
    step = 4096
    total = int((count > 1).sum())
    order = np.argsort(feature, kind="stable")
    owner, feature = owner[order], feature[order]
    where = np.full(len(sets), -1)
    for at in range(0, total, step):
        a, b = np.searchsorted(feature, (at, at + step))
        sides = []
        for rows in (left, right):
            where[:] = -1
            where[rows] = np.arange(len(rows))
            line = where[owner[a:b]]
            dense = np.zeros((len(rows), min(step, total - at)), np.float32)
            dense[line[line >= 0], feature[a:b][line >= 0] - at] = 1
            sides.append(dense)
        both += sides[0] @ sides[1].T
    met = both.astype(np.int64)
    union = size[left][:, None] + size[right][None] - met
    return np.nonzero((_DEN * met >= _NUM * union) & (left[:, None] != right[None]))


def parities(sets: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """A bit per hash range of every set, whether it holds an odd number of shingles there.

    The bits in which two sets differ are at most the shingles in which they differ.  There are two to
    four ranges per shingle, a power of two, so halves can be folded onto each other.
    """
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        bits = max(6, int(b - a).bit_length() + 1)
        at = sets[a:b] >> np.uint64(64 - bits)
        odd = np.zeros(1 << bits, np.uint8)
        odd[np.flatnonzero(np.bincount(at.astype(np.int64)) & 1)] = 1
        out.append(np.packbits(odd))
    return out


def possible(sketches: list[np.ndarray], n: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sets of ``left`` and ``right`` that have a partner on the other side which nothing rules out."""
    shortest = min(len(x) for x in sketches)
    bits = np.stack([np.packbits(np.unpackbits(x).reshape(8 * shortest, -1).sum(1).astype(np.uint8) & 1) for x in sketches])
    bits = bits.view(np.uint64) if shortest % 8 == 0 else bits
    kept = np.zeros(len(n), bool)
    for at in range(0, len(left), 64):
        rows = left[at : at + 64]
        apart = np.bitwise_count(bits[rows][:, None] ^ bits[right][None]).sum(2, dtype=np.int64)
        low, high = np.minimum(n[rows][:, None], n[right][None]), np.maximum(n[rows][:, None], n[right][None])
        fit = (7 * apart <= low + high) & (_DEN * low >= _NUM * high) & (rows[:, None] != right[None])
        kept[rows[fit.any(1)]] = True
        kept[right[fit.any(0)]] = True
    return kept


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the smallest node of each component to its others."""
    nodes, line = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = line[: len(a)], line[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def _bloom(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    ids = ids.astype(np.int64).view(np.uint64)
    return [(mix(ids, salt) % np.uint64(bits)).astype(np.int64) for salt in (11, 12, 13)]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component; ``edges`` has ``a``, ``b``.

    Nodes hang themselves on smaller neighbours until nothing changes, a number of rounds that grows
    with the logarithm of the longest path.  Each round is a written table.
    """
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    print_ = (0, 0)
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not seen[0] or tuple(seen) == print_:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        print_ = tuple(seen)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stage(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "components")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = stage(small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")


def join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    ``n_shingles`` is the number of distinct five-word shingles of a text, lower-cased in A-Z; a text of
    fewer words is one shingle.  Texts link at a similarity of 0.75 or more; ``component_id`` is the
    smallest id reachable.  Null, empty and blank texts have no shingles and link with nothing, not
    even each other.  Rows that share an id are one document; a null id is linked with nothing and
    stays null.  Further columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = documents(docs)

    def sets_of(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for piece, sets, ends in slices(table, "text"):
                first, second = digests(sets, ends)
                yield pa.record_batch([piece.column("doc_id"), pa.array(np.diff(ends)), pa.array(first), pa.array(second)], ["doc_id", "n", "d1", "d2"])

    sized = stage(rows.mapInArrow(released(sets_of), "doc_id long, n long, d1 long, d2 long"), "join-sizes")
    # equal sets are one class, named by its smallest id
    classes = sized.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    classes = stage(classes, "join-classes")

    # which shingles are common: only a hint, so a bounded sample without its near copies will do
    drawn = stage(hash_sample(classes.filter("n > 4"), SAMPLE, "d1", "d2").select(F.col("rep").alias("doc_id")), "join-sample")

    def list_sets(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for _, sets, ends in slices(table, "text"):
                n = np.diff(ends)
                own = pa.ListArray.from_arrays(pa.array(ends[np.append(True, n > 0)], pa.int32()), pa.array(sets.view(np.int64)))
                yield pa.record_batch([pa.array(sets[ends[:-1][n > 0]].view(np.int64)), own], ["sketch", "sets"])

    sampled = rows.join(F.broadcast(drawn), "doc_id").select("text").mapInArrow(released(list_sets), "sketch long, sets array<long>")
    one = sampled.groupBy("sketch").agg(F.min("sets").alias("sets"))
    often = one.select(F.explode("sets").alias("h")).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    held = often.orderBy(F.desc("n"), "h").limit(COMMON).select("h").toArrow().column("h")
    common = np.sort(np.array(held, np.int64).view(np.uint64))
    hints = spark.sparkContext.broadcast(common)

    total = classes.agg(F.sum(F.col("n") / 3 * 1.5 + 1)).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / RANGE) + 1)

    def sign(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()  # sets this task has signed: copies need not sign again
        for table in tables:
            for _, sets, ends in slices(table, "text"):
                if len(known) > KNOWN:
                    known.clear()
                first, second = digests(sets, ends)
                key, owner = signatures(sets, ends, hints.value)
                fresh = np.zeros(len(first), bool)
                for i, pair in enumerate(zip(first.tolist(), second.tolist(), strict=True)):
                    if pair not in known:
                        known.add(pair)
                        fresh[i] = True
                key, owner = key[fresh[owner]], owner[fresh[owner]]
                order = np.argsort(key)
                key, owner = key[order], owner[order]
                target = ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                cuts = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(key) else np.empty(0, np.int64)
                out: list[tuple] = []
                for a, b in zip(cuts, np.append(cuts[1:], len(key))[: len(cuts)], strict=True):
                    who, line = np.unique(owner[a:b], return_inverse=True)
                    steps = np.diff(key[a:b], prepend=np.uint64(0))
                    out.append((int(target[a]), int(b - a), _planes(steps), line.astype(np.uint32).tobytes(), first[who].tobytes()))
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["r", "n", "keys", "lines", "sets"])

    def unpack(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for raw, lines, sets in zip(*(table.column(c).to_pylist() for c in ("keys", "lines", "sets")), strict=True):
            keys.append(np.cumsum(_unplane(raw), dtype=np.uint64))
            nodes.append(np.frombuffer(sets, np.int64)[np.frombuffer(lines, np.uint32)])
        return np.concatenate(keys), np.concatenate(nodes)

    def gather(table: pa.Table) -> pa.Table:
        """Sets under each shared signature of a range, around the smallest."""
        key, node = unpack(table)
        order = np.argsort(key, kind="stable")
        key, node = key[order], node[order]
        del order
        begins = np.append(True, key[1:] != key[:-1])
        run = np.cumsum(begins) - 1
        centre = np.minimum.reduceat(node, np.flatnonzero(begins))[run]
        other = node != centre
        pairs = np.stack([centre[other], node[other]], 1)
        del key, node, begins, run, centre, other
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        if len(pairs):
            pairs = pairs[np.append(True, (pairs[1:] != pairs[:-1]).any(1))]
        return pa.table({"centre": pairs[:, 0], "member": pairs[:, 1]})

    def spread(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            key, node = unpack(table)
            yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(node)], ["key", "node"])

    signed = stage(rows.filter(F.col("doc_id").isNotNull()).select("text").mapInArrow(released(sign), "r long, n long, keys binary, lines binary, sets binary"), "join-signed")
    wide = stage(signed.groupBy("r").agg(F.sum("n").alias("held")).filter(F.col("held") > WIDE).select(F.col("r").alias("wide"), "held"), "join-wide")
    n_wide = wide.count()
    dealt = left_join_unique(signed, wide, F.col("r"), "wide", n_wide) if n_wide else signed.withColumn("held", F.lit(None).cast("long"))
    around = dealt.filter("held is null").groupBy("r").applyInArrow(released_groups(gather), "centre long, member long")
    if n_wide:
        # the sets under a very common signature are never in one task: its smallest set is a partial minimum, which
        # they meet by a join whose hot keys Spark splits
        common_ = dealt.filter("held is not null").mapInArrow(released(spread), "key long, node long")
        least = common_.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre <> last").drop("last")
        around = around.unionByName(common_.join(least, "key").filter("node <> centre").select("centre", F.col("node").alias("member")))
    around = stage(around, "join-around")
    around = stage(around.groupBy("centre", "member").agg(F.lit(1).alias("one")).select("centre", "member"), "join-groups")
    members = around.unionByName(around.select("centre", F.col("centre").alias("member")).distinct())

    wanted = stage(classes.join(members.select(F.col("member").alias("d1")).distinct(), "d1", "left_semi"), "join-wanted")

    def again(reps: DataFrame, made: str) -> DataFrame:
        """Rows of the texts of the distinct ``reps`` (``rep``) once more, with their sketches or their shingles.

        They are known by a filter, so some others may come along; more than ``FILTER_IDS`` by a join.
        """
        n = reps.count()
        bits = 1 << max(16, (FILTER_BITS * max(n, 1) - 1).bit_length())
        bloom = np.zeros(bits // 8, np.uint8)

        def fill(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(bits // 8, np.uint8)
            for table in tables:
                for at in _bloom(np.asarray(table.column("rep")), bits):
                    np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
            yield pa.record_batch([pa.array([own.tobytes()])], ["bits"])

        texts = rows.filter(F.col("doc_id").isNotNull())
        if n <= FILTER_IDS:
            for r in reps.coalesce(2).mapInArrow(released(fill), "bits binary").toLocalIterator():
                bloom |= np.frombuffer(r.bits, np.uint8)
        else:
            bloom[:] = 255
            texts = texts.join(reps.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
        filter_ = spark.sparkContext.broadcast(bloom)

        def fetch(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: set[tuple[int, int, int]] = set()
            for table in tables:
                ids = np.asarray(table.column("doc_id"))
                hit = np.ones(len(ids), bool)
                for at in _bloom(ids, bits):
                    hit &= (filter_.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                for piece, sets, ends in slices(table.filter(pa.array(hit)), "text"):
                    if len(known) > KNOWN:
                        known.clear()
                    first, second = digests(sets, ends)
                    keys = list(zip(piece.column("doc_id").to_pylist(), first.tolist(), second.tolist(), strict=True))
                    fresh = [k for k, key in enumerate(keys) if key not in known and not known.add(key)]
                    values = parities(sets, ends) if made == "sketch" else [sets[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
                    raw = pa.array([values[k].tobytes() for k in fresh], pa.binary())
                    yield pa.record_batch([*(pa.array([keys[k][c] for k in fresh], pa.int64()) for c in range(3)), raw], ["rep", "d1", "d2", made])

        return texts.mapInArrow(released(fetch), f"rep long, d1 long, d2 long, {made} binary")

    # groups beyond a chunk meet chunk by chunk, so that no task holds a whole one
    place = stage(members.join(wanted.select("rep", F.col("d1").alias("member"), "d2", "n"), "member"), "join-members")
    most = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("long").alias("chunks")
    sizes = place.groupBy("centre").agg(most)
    large = stage(sizes.filter("chunks > 1").select(F.col("centre").alias("hot"), "chunks"), "join-large")
    # only groups beyond a chunk are looked up, so members are not dealt out by their centre while these are few
    place = left_join_unique(place, large, F.col("centre"), "hot", large.count()).withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
    place = place.withColumn("mine", F.pmod(F.hash("member"), "chunks").cast("long"))
    place = place.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    low, high = F.least("mine", "met").alias("low"), F.greatest("mine", "met").alias("high")
    place = stage(place.select("centre", F.col("member").alias("d1"), "mine", low, high, "rep", "d2", "n"), "join-places")

    def sift(table: pa.Table) -> pa.Table:
        n, mine = np.asarray(table.column("n")), np.asarray(table.column("mine"))
        left, right = np.flatnonzero(mine == table.column("low")[0].as_py()), np.flatnonzero(mine == table.column("high")[0].as_py())
        kept = np.zeros(len(n), bool)
        if len(left) and len(right):
            kept = possible([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("sketch")], n, left, right)
        return table.filter(pa.array(kept)).select(["centre", "low", "high", "mine", "rep", "d1", "d2"])

    sketched = again(wanted.select("rep"), "sketch").join(place, ["rep", "d1", "d2"]).select("centre", "low", "high", "mine", "rep", "d1", "d2", "n", "sketch")
    kept = "centre long, low long, high long, mine long, rep long, d1 long, d2 long"
    left_over = stage(sketched.groupBy("centre", "low", "high").applyInArrow(released_groups(sift), kept), "join-sifted")
    ready = again(left_over.select("rep").distinct(), "shingles").join(left_over, ["rep", "d1", "d2"]).select("centre", "low", "high", "mine", "rep", "shingles")

    def link(table: pa.Table) -> pa.Table:
        reps, mine = np.asarray(table.column("rep")), np.asarray(table.column("mine"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        a = b = np.empty(0, np.int64)
        if len(left) and len(right):
            i, j = compare([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")], left, right)
            a, b = stars(reps[left[i]], reps[right[j]])
        return pa.table({"a": a, "b": b})

    links = ready.groupBy("centre", "low", "high").applyInArrow(released_groups(link), "a long, b long")
    named = stage(sized.join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left").select("doc_id", "n", "rep"), "join-named")
    # an id under several texts ties their classes together
    several = named.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x < y").select("doc_id")
    tied = named.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    component = components(links.unionByName(tied))
    named = named.join(component, F.col("rep") == F.col("node"), "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"))
