"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its labels.

Stems (beginnings of words, and whole words) that labelled rows associate with either class are dealt
into lexicon voters; patterns of style vote as well.  A generative model takes each voter to fire with
one probability per class, estimates these over the votes of all documents that may be learnt from,
and measures how far voters agree beyond their class; what they only repeat of each other is
discounted.  Its posterior labels, of unlabelled documents and of labelled ones, whose label is a vote, train a logistic regression
over stems, which scores every text.  Scale and bias of its scores come from the labels of rows that
were left out while it was fitted on the others.

Only rows whose ``crc32(doc_id)`` mod 5 is not 0 teach anything; language, source and id score nothing.
The rows that induce lexicons and train are at most ``labelled`` with labels and ``unlabelled`` without,
drawn by hash; votes are counted, and scores given, over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.bpe import batches
from orderflow.llm.common import documents, give_back, hash_sample, released, stage, string_buffers, text_of

LENGTHS = (4, 5, 6)  # bytes of the beginnings of words
LONGEST = 16  # longer words have their beginnings, and every stretch of GRAM bytes, instead of the whole
GRAM = 6
VOCABULARY = 4096
TRUST = 0.98  # how often a given label is taken to be right
HINT, PROOF = 4.0, 16.0  # log-likelihood gain for a stem to be a feature, and to be in a lexicon
LEXICONS, BENIGN = 24, 8  # voters for either class
# Patterns of style that vote for toxicity until the model knows better.
PATTERNS = (r"\b[A-Z]{4,}\b", r"!{2,}", r"(?i)\byou(?:'re| are)\b", r"(?i)\b(?:idiot|moron|stupid|loser|scum|trash)s?\b", r"(\p{L})\1{3}")
WORDS = r"\p{L}{3,}"
SLICE = 1 << 18  # words worked on at once
SPREAD = 1 << 16  # the same where every stem of every word is listed


def taught(doc_id: Column) -> Column:
    """Whether a row may be learnt from; a null id may not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def stems(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, stem) of every stem of distinct words, stems as 64-bit hashes; all of a long word is in some stem."""
    lengths = np.diff(offsets)
    h = np.zeros(len(lengths), np.uint64)
    owners, found = [], []
    for k in range(LONGEST + 1):
        whole = np.flatnonzero(lengths == k)
        owners.append(whole)
        found.append((h[whole] ^ np.uint64(0xFF)) * np.uint64(0x9E3779B97F4A7C15))
        if k in LENGTHS:
            longer = np.flatnonzero(lengths > k)
            owners.append(longer)
            found.append((h[longer] ^ np.uint64(k)) * np.uint64(0xC2B2AE3D27D4EB4F))
        more = np.flatnonzero(lengths > k)
        h[more] = (h[more] ^ data[offsets[more] + k]) * np.uint64(0x100000001B3) + np.uint64(0x1465)
    long_ = np.flatnonzero(lengths > LONGEST)
    grams = lengths[long_] - GRAM + 1
    owners.append(np.repeat(long_, grams))
    at = np.arange(grams.sum()) + np.repeat(offsets[long_] - (np.cumsum(grams) - grams), grams)
    gram = np.full(len(at), 0x5851F42D4C957F2D, np.uint64)
    for k in range(GRAM):
        gram = (gram ^ data[at + k]) * np.uint64(0x100000001B3) + np.uint64(0x1465)
    found.append(gram * np.uint64(0xC2B2AE3D27D4EB4F))
    return np.concatenate(owners), np.concatenate(found).view(np.int64)


def _spread(owner: np.ndarray, value: np.ndarray, word: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the values of distinct words, wherever the words stand, once per row and value."""
    order = np.argsort(owner, kind="stable")
    owner, value = owner[order], value[order]
    first, last = np.searchsorted(owner, word), np.searchsorted(owner, word, "right")
    n = last - first
    line = np.repeat(np.repeat(np.arange(len(rows) - 1), np.diff(rows)), n)
    value = value[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    order = np.lexsort((value, line))
    line, value = line[order], value[order]
    fresh = np.ones(len(line), bool)
    fresh[1:] = (np.diff(line) != 0) | (np.diff(value) != 0)
    return line[fresh], value[fresh]


def _sketch(words: pa.Array, word: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The smallest hash of five words in a row, which near copies mostly share."""
    owner, stem = stems(*string_buffers(words.cast(pa.binary())))
    h = np.zeros(len(words), np.uint64)
    np.bitwise_xor.at(h, owner, stem.view(np.uint64))
    h, out = h[word], np.zeros(len(rows) - 1, np.uint64)
    mixed = h.copy()
    for k in range(1, 5):
        mixed[: len(h) - k] = mixed[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
    for k, (a, b) in enumerate(zip(rows[:-1], rows[1:], strict=True)):
        out[k] = mixed[a : max(a + 1, b - 4)].min() if b > a else 0
    return out.view(np.int64)


def _inside(known: np.ndarray, words: pa.Array, word: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in ``known``) of the stems of ``known`` in each row, once each."""
    owner, stem = stems(*string_buffers(words))
    at = np.searchsorted(known, stem)
    at[at == len(known)] = 0
    hit = known[at] == stem if len(known) else np.zeros(len(stem), bool)
    return _spread(owner[hit], at[hit], word, rows)


@dataclass
class Model:
    """What scoring needs; a few thousand numbers."""

    known: np.ndarray  # stems, ascending
    weights: np.ndarray
    bias: float
    voters: dict = field(default_factory=dict)


def _label_model(patterns: DataFrame, n_voters: int, prior: float, seen: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Firing rates per class, correlation of the voters, and each voter's weight.

    ``patterns`` has the combinations of votes over all documents and their counts; ``seen`` holds the
    firings among labelled rows, the model's prior: [class, voter], the last column the rows.
    """
    rates = (seen[:, :-1] + 0.5) / (seen[:, -1:] + 1.0)

    def gather(theta: np.ndarray) -> np.ndarray:
        """Posterior-weighted sums per class: rows, firings, and joint firings."""
        llr = np.log(theta[1] / theta[0]) - np.log((1 - theta[1]) / (1 - theta[0]))
        base = np.log(prior / (1 - prior)) + np.log((1 - theta[1]) / (1 - theta[0])).sum()

        def part(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, n_voters + 1, n_voters + 1))
            for t in tables:
                mask, n = np.asarray(t.column("votes"), dtype=np.int64), np.asarray(t.column("n"), dtype=np.float64)
                fires = ((mask[:, None] >> np.arange(n_voters)) & 1).astype(np.float64)
                post = 1 / (1 + np.exp(-np.clip(base + fires @ llr, -50, 50)))
                one = np.concatenate([fires, np.ones((len(fires), 1))], 1)
                for y, p in enumerate((1 - post, post)):
                    total[y] += (one * (n * p)[:, None]).T @ one
            yield pa.record_batch([pa.array([total.tobytes()])], ["total"])

        sums = patterns.mapInArrow(part, "total binary").collect()  # one row per partition of the combinations
        return sum((np.frombuffer(r.total).reshape(2, n_voters + 1, n_voters + 1) for r in sums), np.zeros((2, n_voters + 1, n_voters + 1)))

    joint = np.zeros((2, n_voters + 1, n_voters + 1))
    for _ in range(rounds):
        joint = gather(rates)
        fired, rows = joint[:, -1, :-1], joint[:, -1, -1:]
        rates = np.clip((fired + seen[:, :-1] + 0.5) / (rows + seen[:, -1:] + 1.0), 1e-4, 1 - 1e-4)
    # agreement of two voters within a class, beyond what the class explains
    rho = np.zeros((n_voters, n_voters))
    for y in range(2):
        n = max(joint[y, -1, -1], 1.0)
        p = joint[y, -1, :-1] / n
        cov = joint[y, :-1, :-1] / n - np.outer(p, p)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        rho += np.clip(cov / np.outer(sd, sd), -1, 1) / 2
    np.fill_diagonal(rho, 0)
    return rates, rho, 1 / (1 + np.maximum(rho, 0).sum(1))


def _fit(rows: list[np.ndarray], target: np.ndarray, size: int, steps: int = 300, ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over sparse binary rows, by Adagrad with a ridge penalty."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.empty(0, np.int64)
    w, b = np.zeros(size), float(np.log(max(target.mean(), 1e-3) / max(1 - target.mean(), 1e-3)))
    ridge /= max(len(rows), 1)
    gw, gb = np.full(size, 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(owner, w[column], len(rows)), -50, 50)))
        error = (p - target) / len(rows)
        grad = np.bincount(column, error[owner], size) + ridge * w
        gw += grad * grad
        gb += error.sum() ** 2
        w -= 0.3 * grad / np.sqrt(gw)
        b -= 0.05 * error.sum() / np.sqrt(gb)
    return w, b


def _calibrated(rows: list[np.ndarray], target: np.ndarray, label: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """The classifier on posterior labels, its scores scaled and shifted to fit the labels (-1: none) of rows not fitted on."""
    w, b = _fit(rows, target, size)
    fold = np.arange(len(rows)) % 2
    logit = np.zeros(len(rows))
    for k in range(2):
        kept = np.flatnonzero(fold != k)
        if not len(kept):
            continue
        own_w, own_b = _fit([rows[i] for i in kept], target[kept], size)
        for i in np.flatnonzero(fold == k):
            logit[i] = own_b + own_w[rows[i]].sum()
    told = label >= 0
    x, y = logit[told], label[told].astype(float)
    scale, shift = 1.0, 0.0
    for _ in range(30):  # Newton's method, held near a scale of 1 by one row's worth of doubt
        p = 1 / (1 + np.exp(-np.clip(scale * x + shift, -50, 50)))
        grad = np.array([((p - y) * x).sum() + (scale - 1), (p - y).sum() + 0.01 * shift])
        v = np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        scale, shift = scale - np.clip(step[0], -1, 1), shift - np.clip(step[1], -2, 2)
    scale = max(scale, 0.1)
    return w * scale, float(b * scale + shift)


def train(docs: DataFrame, labels: DataFrame, labelled: int = 10_000, unlabelled: int = 10_000) -> Model:
    """Learn from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``toxic``).

    ``labelled`` bounds the labelled rows that induce lexicons and train the classifier, ``unlabelled`` the
    others that train it.  Labels other than 0 and 1 and rows with a null id teach nothing; of several
    labels of a document the largest counts.
    """
    spark = docs.sparkSession
    teach = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    teach = teach.filter(taught(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    teach = stage(hash_sample(teach, labelled, "doc_id", "toxic"), "toxic-labels")
    rows = documents(docs).filter(taught(F.col("doc_id")))
    others = hash_sample(rows.select("doc_id"), unlabelled, "doc_id").distinct().withColumn("toxic", F.lit(-1))
    drawn_ids = stage(teach.unionByName(others).groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-drawn")
    patterns = [F.col("text").rlike(p).cast("long") for p in PATTERNS]
    cut = rows.select("doc_id", words_of(F.col("text")).alias("words"), sum((F.shiftleft(p, k) for k, p in enumerate(patterns)), F.lit(0).cast("long")).alias("style"))
    sample = cut.join(F.broadcast(drawn_ids), "doc_id")  # bounded by ``labelled`` and ``unlabelled`` ids

    def list_stems(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for piece, words, word, ends in batches(table, "words", SPREAD):
                line, found = _spread(*stems(*string_buffers(words)), word, ends)
                own = pa.ListArray.from_arrays(pa.array(np.searchsorted(line, np.arange(len(ends))), pa.int32()), pa.array(found))
                sketch = pa.array(_sketch(words, word, ends))
                yield pa.record_batch([*(piece.column(c) for c in ("doc_id", "toxic", "style")), sketch, own], ["doc_id", "toxic", "style", "sketch", "stems"])

    drawn = sample.mapInArrow(released(list_stems), "doc_id long, toxic int, style long, sketch long, stems array<long>")
    # one of each group of copies, or a copied text would pass off all its words as evidence; a labelled one if there is one
    own = F.min_by(F.struct("toxic", "style", "stems"), F.struct(F.col("toxic") < 0, "doc_id")).alias("own")
    every = stage(drawn.groupBy("sketch").agg(own).select("sketch", "own.*"), "toxic-sample")
    taken = every.filter("toxic >= 0")
    n = {r.toxic: r.n for r in taken.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:  # nothing to tell apart
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log((n1 + 0.5) / (n0 + 1.5))))
    seen = taken.select("toxic", F.explode("stems").alias("stem")).groupBy("stem").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    # how much likelier the counts are under a rate of the stem's own than under the common one
    b, g, share = F.col("bad").cast("double"), F.col("good").cast("double"), n1 / (n0 + n1)

    def gain(part: Column, expected: Column) -> Column:
        return F.when(part > 0, part * F.log(part / expected)).otherwise(0.0)

    evidence = (gain(b, (b + g) * share) + gain(g, (b + g) * (1 - share))) * F.when(b > (b + g) * share, 1).otherwise(-1)
    told = seen.withColumn("z", evidence).filter(F.abs("z") >= HINT)
    top = told.orderBy(F.desc(F.abs("z")), "stem").limit(VOCABULARY).collect()
    order = sorted(top, key=lambda r: r.stem)
    known = np.array([r.stem for r in order], np.int64)
    place = {r.stem: k for k, r in enumerate(order)}
    bad = [r for r in sorted(top, key=lambda r: (-r.z, r.stem)) if r.z >= PROOF]
    good = [r for r in sorted(top, key=lambda r: (r.z, r.stem)) if r.z <= -PROOF]
    voter = np.full(len(known), -1)
    for k, r in enumerate(bad):
        voter[place[r.stem]] = k % LEXICONS
    for k, r in enumerate(good):
        voter[place[r.stem]] = LEXICONS + k % BENIGN
    n_voters = LEXICONS + BENIGN + len(PATTERNS)
    shared = spark.sparkContext.broadcast((known, voter))

    def votes_of(row: np.ndarray, at: np.ndarray, voter: np.ndarray, style: np.ndarray) -> np.ndarray:
        mask = style << (LEXICONS + BENIGN)
        fired = voter[at] >= 0
        np.bitwise_or.at(mask, row[fired], np.int64(1) << voter[at[fired]])
        return mask

    def vote(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, voter = shared.value
        for table in tables:
            for piece, words, word, ends in batches(table, "words", SLICE):
                row, at = _inside(known, words, word, ends)
                mask = votes_of(row, at, voter, np.array(piece.column("style"), dtype=np.int64))
                combined, counts = np.unique(mask, return_counts=True)
                yield pa.record_batch([pa.array(combined), pa.array(counts)], ["votes", "n"])

    # every document that may be learnt from votes; equal combinations are one row
    combined = stage(cut.select("words", "style").mapInArrow(released(vote), "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")), "toxic-votes")

    def shrink(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value[0]
        for t in tables:
            own = [np.searchsorted(known, s) for s in (np.intersect1d(np.asarray(x), known) for x in t.column("stems").to_numpy(zero_copy_only=False))]
            yield pa.record_batch([t.column("sketch"), t.column("toxic"), t.column("style"), pa.array(own, pa.list_(pa.int16()))], ["sketch", "toxic", "style", "at"])

    # at most ``labelled`` + ``unlabelled`` rows, with places among the known stems
    small = every.mapInArrow(shrink, "sketch long, toxic int, style long, at array<smallint>").orderBy("sketch").toArrow().combine_chunks()
    at = [np.asarray(x, np.int64) for x in small.column("at").to_numpy(zero_copy_only=False)]
    label, style = np.asarray(small.column("toxic")), np.array(small.column("style"), np.int64)
    owner = np.repeat(np.arange(len(at)), [len(a) for a in at])
    fires = ((votes_of(owner, np.concatenate(at), voter, style)[:, None] >> np.arange(n_voters)) & 1).astype(float)
    firings = np.stack([np.append(fires[label == y].sum(0), (label == y).sum()) for y in range(2)])
    prior = n1 / (n0 + n1)
    rates, rho, weight = _label_model(combined, n_voters, prior, firings)
    llr = weight * (np.log(rates[1] / rates[0]) - np.log((1 - rates[1]) / (1 - rates[0])))
    base = np.log(prior / (1 - prior)) + (weight * np.log((1 - rates[1]) / (1 - rates[0]))).sum()
    # a given label is one more vote
    told = np.where(label < 0, 0.0, (2 * label - 1) * np.log(TRUST / (1 - TRUST)))
    posterior = 1 / (1 + np.exp(-np.clip(base + fires @ llr + told, -50, 50)))
    weights, bias = _calibrated(at, posterior, label, len(known))
    return Model(known, weights, bias, {"rates": rates, "correlation": rho, "weight": weight, "posterior": posterior, "label": label})


def _logits(m: Model, words: pa.Array) -> np.ndarray:
    """One per row of an array of lists of words, worked on in pieces."""
    out = [np.empty(0)]
    for piece, distinct, word, ends in batches(pa.record_batch([words], ["words"]), "words", SLICE):
        row, at = _inside(m.known, distinct, word, ends)
        out.append(m.bias + np.bincount(row, m.weights[at], piece.num_rows))
    return np.concatenate(out)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model does not call toxic.

    Python sees the words alone and answers with a boolean; the rows stay where they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def calm(words: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for part in words:
                yield pa.array(_logits(shared.value, part) < 0)
        finally:
            give_back()

    return docs.filter(calm(words_of(text_of(docs))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; an empty text gets the bare prior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    cut = documents(docs).select("doc_id", words_of(F.col("text")).alias("words"))

    def rate(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            logit = _logits(shared.value, table.column("words"))
            yield pa.record_batch([table.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(logit, -50, 50))))], ["doc_id", "score"])

    scored = cut.mapInArrow(released(rate), "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, labelled: int = 10_000, unlabelled: int = 10_000) -> DataFrame:
    """Train on ``docs`` and ``labels``, then score every row of ``docs``.

    Null texts count as empty; a null id is scored, its ``held_out`` is null and it teaches nothing;
    repeated rows are scored each; further columns are ignored; an empty table gives an empty one.
    """
    return score(docs, train(docs, labels, labelled, unlabelled))
