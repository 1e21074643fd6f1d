"""Grouping of spelling variants by search schemes over bidirectional FM-indexes.

Words that differ by one inserted, deleted or replaced letter agree on a whole half: the first half of
the asked word begins the other, or its second half ends it.  So a search matches one half exactly and
extends across the other half, allowing one error, up to the delimiters on both sides.  An interval of
suffix ranks stands for all places of what is matched so far.  The index keeps it for the text and for
the reversed text at once, so it grows in either direction, and ends as the rank of one word.

The vocabulary is not held in one place.  Words go to where their possible halves lead (a hash of side
and half), words that ask go with their own two halves, and each shard indexes what it has.  A half
that very many words share is cut into parts by the hash of the word, and who asks for it visits all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import documents
from orderflow.operators.skew import left_join_unique
from orderflow.session import stage

# What words are made of, and how they are counted and changed.
LETTERS = "A-Za-zÀ-ÿ"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHORTEST, LEAST = 5, 3
NOISE = 97

SHARD_WORDS = 100_000  # entries a shard is meant to hold
PART_WORDS = 50_000  # entries of one half that stay together
STEP = 16  # places between the counts an index keeps
STATES = 1 << 14  # search states extended at once by every letter


def words_of(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """``word`` of every occurrence of at least ``SHORTEST`` letters, lower-cased in A-Z.

    Where ``noise`` divides the crc32 of ``doc_id:run``, a letter is left out of the run; a null id
    counts as empty text.
    """
    text = F.translate(F.col("text"), UPPER, UPPER.lower())
    runs = documents(docs).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))).alias("run"),
    )
    code = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = F.pmod(F.col("code"), F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("code") % noise == 0, cut).otherwise(F.col("run"))
    return runs.withColumn("code", code).select(word.alias("word")).filter(F.length("word") >= SHORTEST)


@dataclass
class _Side:
    """Suffix ranks of a text: its last column of letters, counts before each STEP-th rank, first ranks."""

    bwt: np.ndarray
    before: np.ndarray  # [place // STEP, letter]
    first: np.ndarray  # rank of the first suffix beginning with each letter

    @classmethod
    def of(cls, text: np.ndarray, letters: int) -> tuple[_Side, np.ndarray]:
        order = suffix_order(text, letters)
        bwt = text[order - 1]  # before the first letter stands the last
        n = len(text)
        padded = np.zeros(-(-(n + 1) // STEP) * STEP, text.dtype)
        padded[:n] = bwt
        blocks = len(padded) // STEP
        cell = np.repeat(np.arange(blocks), STEP)[:n] * letters + bwt
        counts = np.bincount(cell, minlength=blocks * letters).reshape(blocks, letters)
        before = np.zeros((blocks, letters), np.int32)
        np.cumsum(counts[:-1], axis=0, out=before[1:])
        totals = np.bincount(text, minlength=letters)
        return cls(padded, before, np.cumsum(totals) - totals), order

    def count(self, letter: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of a letter before a place."""
        block = place // STEP
        window = self.bwt[(block * STEP)[:, None] + np.arange(STEP)]
        inside = np.arange(STEP) < (place % STEP)[:, None]
        return self.before[block, letter] + ((window == letter[:, None]) & inside).sum(1)

    def counts(self, place: np.ndarray) -> np.ndarray:
        """Occurrences of every letter before a place."""
        block, rest = place // STEP, place % STEP
        out = self.before[block].astype(np.int64)
        row = np.arange(len(place))
        for k in range(STEP - 1):
            open_ = row[rest > k]
            out[open_, self.bwt[block[open_] * STEP + k]] += 1
        return out

    def smaller(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many of the places ``low:high`` hold a smaller letter."""
        gap = self.counts(high) - self.counts(low)
        gap[np.arange(gap.shape[1]) >= letter[:, None]] = 0
        return gap.sum(1)


def suffix_order(text: np.ndarray, letters: int) -> np.ndarray:
    """Starts of the cyclic suffixes of ``text`` in ascending order, by doubling the compared length."""
    n = len(text)
    bits = max(1, int(letters - 1).bit_length())
    length = 62 // bits
    key = np.zeros(n, np.int64)
    for k in range(length):
        key = (key << bits) | np.roll(text, -k)
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
        if length >= n or rank[order[-1]] == n - 1:
            return order
        key = rank * n + np.roll(rank, -length)
        length *= 2


@dataclass
class Index:
    """Bidirectional FM-index over distinct words: ``$w1$w2$...wn$``.

    A state is (rank in the text, rank in the reversed text, size): the suffixes that begin with the
    matched string, and the reversed ones that begin with its reverse.
    """

    ahead: _Side  # of the text: extends to the left
    back: _Side  # of the reversed text: extends to the right
    size: int  # of the text
    word_of: np.ndarray  # word after the delimiter of each suffix rank

    @classmethod
    def of(cls, codes: np.ndarray, offsets: np.ndarray, letters: int) -> Index:
        """Words as a ragged array of letter codes from 1; the delimiter is 0."""
        n = len(offsets) - 1
        text = np.zeros(len(codes) + n + 1, np.int64)
        text[np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(offsets)) + 1] = codes
        ahead, order = _Side.of(text, letters)
        back, _ = _Side.of(text[::-1].copy(), letters)
        starts = offsets[:-1] + np.arange(n)  # of the delimiter before each word
        word_of = np.searchsorted(starts, order[: n + 1])
        return cls(ahead, back, len(text), word_of)

    def whole(self, n: int) -> np.ndarray:
        """The state of the empty string, ``n`` times."""
        return np.repeat(np.array([[0], [0], [self.size]]), n, axis=1)

    def extend(self, state: np.ndarray, letter: np.ndarray, right: bool) -> np.ndarray:
        """States grown by one letter each; those of size 0 match nothing."""
        side = self.back if right else self.ahead
        low = state[1] if right else state[0]
        high = low + state[2]
        start = side.count(letter, low)
        size = side.count(letter, high) - start
        moved = side.first[letter] + start
        other = np.zeros(len(low), np.int64)
        live = np.flatnonzero(size > 0)
        other[live] = (state[0] if right else state[1])[live] + side.smaller(letter[live], low[live], high[live])
        return np.stack([other, moved, size] if right else [moved, other, size])

    def branches(self, state: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every state, each letter but the delimiter that extends it: (state's place, letter, new state)."""
        side = self.back if right else self.ahead
        low = state[1] if right else state[0]
        start = side.counts(low)
        gap = side.counts(low + state[2]) - start
        other = (state[0] if right else state[1])[:, None] + np.cumsum(gap, axis=1) - gap
        gap[:, 0] = 0
        row, letter = np.nonzero(gap)
        moved, other, size = side.first[letter] + start[row, letter], other[row, letter], gap[row, letter]
        return row, letter, np.stack([other, moved, size] if right else [moved, other, size])


def _exact(index: Index, state: np.ndarray, codes: np.ndarray, at: np.ndarray, end: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """States grown over ``codes[at:end]`` (to the left: ``end:at`` backwards) and who of them is left."""
    who = np.arange(len(at))
    at = at.copy()
    while True:
        open_ = np.flatnonzero(at != end[who])
        if not len(open_):
            return state, who
        grown = index.extend(state[:, open_], codes[at[open_] if right else at[open_] - 1], right)
        state[:, open_] = grown
        at[open_] += 1 if right else -1
        keep = state[2] > 0
        state, who, at = state[:, keep], who[keep], at[keep]


def search(index: Index, codes: np.ndarray, offsets: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(asking word, found word) at distance one, the error in the second half (``right``) or in the first.

    Matched exactly from its outer delimiter is the other half.  Of equal letters in a row only one
    is left out or doubled, which gives the same words.
    """
    n = len(offsets) - 1
    begin, stop = offsets[:-1], offsets[1:]
    middle = begin + (stop - begin) // 2
    state = index.extend(index.whole(n), np.zeros(n, np.int64), right)
    state, who = _exact(index, state, codes, begin if right else stop, middle, right)
    at, goal = middle[who], (stop if right else begin)[who]
    step = 1 if right else -1
    asked, found = [], []

    def finish(state: np.ndarray, who: np.ndarray, at: np.ndarray, goal: np.ndarray) -> None:
        if not len(who):
            return
        state, left = _exact(index, state, codes, at, goal, right)
        who = who[left]
        state = index.extend(state, np.zeros(len(who), np.int64), right)
        hit = state[2] > 0
        asked.append(who[hit])
        found.append(index.word_of[state[0][hit]])

    while len(who):
        inner = at != goal
        letter = np.where(inner, codes[np.clip(np.where(inner, at, 0) if right else np.where(inner, at - 1, 0), 0, None)], -1)
        fresh = at == middle[who]
        last = np.where(fresh, -1, codes[np.clip(at - 1 if right else at, 0, len(codes) - 1)])
        # left out: the next letter, unless the one before it is the same
        skip = np.flatnonzero(inner & (letter != last))
        finish(state[:, skip], who[skip], at[skip] + step, goal[skip])
        for a in range(0, len(who), STATES):
            part = slice(a, a + STATES)
            row, found_letter, grown = index.branches(state[:, part], right)
            row = row + a
            # put in: any letter that is not the same as the one before
            more = np.flatnonzero(found_letter != last[row])
            finish(grown[:, more], who[row[more]], at[row[more]], goal[row[more]])
            # replaced
            other = np.flatnonzero(inner[row] & (found_letter != letter[row]))
            finish(grown[:, other], who[row[other]], at[row[other]] + step, goal[row[other]])
        # on without an error
        on = np.flatnonzero(inner)
        state = index.extend(state[:, on], letter[on], right)
        keep = state[2] > 0
        state, who, at, goal = state[:, keep], who[on][keep], at[on][keep] + step, goal[on][keep]
    if not asked:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(asked), np.concatenate(found)


def _ragged_codes(words: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    offsets = np.append(0, np.cumsum([len(w) for w in words], dtype=np.int64))
    return np.searchsorted(alphabet, flat) + 1, offsets


def near_in(table: pa.Table) -> pa.Table:
    """Pairs of a shard: each asking word and every entry near it, with the entry's ``n``."""
    asks = np.asarray(table.column("asks"))
    word, n, side = np.array(table.column("word").to_pylist(), object), np.asarray(table.column("n")), np.asarray(table.column("side"))
    held, place = np.unique(word[~asks], return_index=True)
    held_n = n[~asks][place]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    if len(held) and asks.any():
        alphabet = np.unique(np.frombuffer("".join(word).encode("utf-32-le"), "<u4"))
        index = Index.of(*_ragged_codes(list(held), alphabet), len(alphabet) + 1)
        for right in (True, False):
            own = np.unique(word[asks & (side == (0 if right else 1))])
            if len(own):
                asked, found = search(index, *_ragged_codes(list(own), alphabet), right)
                out.append((own[asked], found))
    asked = np.concatenate([a for a, _ in out]) if out else np.empty(0, object)
    found = np.concatenate([f for _, f in out]) if out else np.empty(0, np.int64)
    return pa.table({"word": pa.array(asked.tolist(), pa.string()), "near": pa.array(held[found].tolist(), pa.string()), "n": pa.array(held_n[found], pa.int64())})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(``word``, ``near``, ``n`` of ``near``), once each, of all pairs of the distinct ``word``s at distance one."""
    spark = vocabulary.sparkSession
    size = F.length("word")

    def halves(size: Column) -> list[Column]:
        """(side, half) of a word of this size that asks, from the actual word."""
        first = F.floor(size / 2).cast("int")
        ahead = F.substring(F.col("word"), F.lit(1), first)
        behind = F.reverse(F.substring(F.reverse("word"), F.lit(1), (size - F.floor(size / 2)).cast("int")))
        return [F.struct(F.lit(0).alias("side"), ahead.alias("half")), F.struct(F.lit(1).alias("side"), behind.alias("half"))]

    entries = F.array_distinct(F.array(*[h for d in (-1, 0, 1) for h in halves(size + d)]))
    held = stage(vocabulary.select("word", "n", F.explode(entries).alias("h")).select("word", "n", "h.side", "h.half"), "spelling-entries")
    asking = vocabulary.select("word", "n", F.explode(F.array(*halves(size))).alias("h")).select("word", "n", "h.side", "h.half")
    # halves shared by very many words are few: at most one in PART_WORDS entries
    large = held.groupBy("side", "half").agg(F.ceil(F.count("*") / PART_WORDS).cast("long").alias("parts")).filter("parts > 1")
    large = stage(large.select(F.concat_ws(":", "side", "half").alias("hot"), "parts"), "spelling-large")
    sizes = large.agg(F.count("*"), F.coalesce(F.sum(F.length("hot")), F.lit(0))).first()

    def parted(rows: DataFrame) -> DataFrame:
        looked = left_join_unique(rows, large, F.concat_ws(":", "side", "half"), "hot", *sizes)
        return looked.withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))

    one = parted(held).withColumn("part", F.pmod(F.xxhash64("word"), "parts")).withColumn("asks", F.lit(False))
    every = parted(asking).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("asks", F.lit(True))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // SHARD_WORDS))
    dealt = one.unionByName(every).select("word", "n", "side", "asks", F.pmod(F.xxhash64("side", "half", "part"), F.lit(shards)).alias("shard"))
    found = dealt.groupBy("shard").applyInArrow(near_in, "word string, near string, n long")
    return found.groupBy("word", "near").agg(F.max("n").alias("n"))


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) where ``forms`` (``word``, ``form``) lead in the end; counts double from form to form, so paths are short.

    Each round, written, doubles the length of the followed paths.
    """
    ahead = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = ahead.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = stage(ahead.join(on, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        ahead = joined.select("word", "root")
        if joined.filter("_moved").isEmpty():
            return ahead


def variants(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the texts of ``docs``.

    Words have at least 5 letters and 3 occurrences.  A word's form is the most frequent word near it
    (ties: the smallest in code-point order) that occurs at least twice as often; its root is where forms
    lead in the end, the word itself without one.  Null texts have no words; a null id counts as empty;
    repeated rows count each; further columns are ignored; an empty table gives an empty one.
    """
    vocabulary = stage(words_of(docs, noise).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST), "spelling-words")
    near = near_words(vocabulary)
    best = F.min_by(F.struct(F.col("near"), F.col("n")), F.struct(-F.col("n"), F.col("near"))).alias("best")
    leads = near.groupBy("word").agg(F.count("*").alias("n_near"), best).select("word", "n_near", "best.*")
    leads = leads.select(F.col("word").alias("_word"), "n_near", "near", F.col("n").alias("near_n"))
    joined = vocabulary.join(leads, F.col("word") == F.col("_word"), "left")
    holds = F.col("near_n") >= 2 * F.col("n")
    formed = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(holds, F.col("near")).alias("form"), F.when(holds, F.col("near_n")).alias("form_n")
        ),
        "spelling-forms",
    )
    ends = roots(formed.filter(F.col("form").isNotNull())).select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    return formed.join(ends, F.col("word") == F.col("_word"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("_root", "word").alias("root"))
