"""Cases in which rows, ids or parts of texts could get lost."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from orderflow.llm import common, kmeans_tree, packing, partenum, shingles, toxicity
from orderflow.llm.common import string_buffers

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_vectors_of_every_length_answer(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8 if i % 3 else 5).tolist()) for i in range(900)]
    rows += [(1000, [1.0, 2.0]), (1001, [3.0, 4.0]), (1100, [7.0] * 9)]
    got = defaultdict(list)
    for r in kmeans_tree.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q, v in rows:
        if q % 100 == 0:
            far = sorted((float(np.linalg.norm(np.array(v) - np.array(w))), i) for i, w in rows if len(w) == len(v) and i != q)[:10]
            assert len(got[q]) == len(far)
            hit, total = hit + len({i for _, i in far} & {i for _, i, _ in got[q]}), total + len(far)
    assert hit / total >= 0.9 and got[1000] == [(1, 1001, np.sqrt(8.0))] and not got[1100]


def sources(spark, n):
    rows = [(i, " ".join(f"w{i}" for _ in range(20)), f"s{i % n}") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_beyond_the_queues_keep_their_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 2)
    docs = sources(spark, 5)
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, targets={"s0": 1.0, "s1": 1.0}).count()
    pieces = packing.pack(docs, PATH, sequence=64, window_sequences=2).collect()
    held = Counter()
    for p in pieces:
        held[p.doc_id] += p.length
    assert held == {p.doc_id: p.doc_tokens for p in pieces} and len(held) == 40
    with pytest.raises(ValueError):
        packing.pack(sources(spark, 3), PATH, targets={f"s{i}": 1.0 for i in range(2)}).count()


def test_targets_lose_no_ids(spark):
    docs = sources(spark, 3)
    whole = sum(p.length for p in packing.pack(docs, PATH).collect())
    for weights in ({"s0": 1.0, "s1": 1.0, "s2": 1.0}, {"s0": 5.0, "s1": 1.0, "s2": 3.0, "more": 1.0}):
        pieces = packing.pack(docs, PATH, sequence=64, window_sequences=2, targets=weights).collect()
        assert sum(p.length for p in pieces) == whole
        assert {p.doc_id: p.doc_tokens for p in pieces}.keys() == set(range(40))


def test_small_sources_mix_in_a_queue_of_their_own(spark):
    rows = [(i, "word " * 400, "big") for i in range(20)] + [(100 + i, "x", f"tiny{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, PATH, sequence=128, window_sequences=8).collect()
    assert sum(p.length for p in pieces if p.doc_id >= 100) == 60
    windows = {p.sequence_id // 8 for p in pieces if p.doc_id >= 100}
    assert len(windows) == 1 + max(p.sequence_id for p in pieces) // 8  # spread over all windows
    taken = sorted((p.sequence_id * 128 + p.offset, p.length) for p in pieces)
    assert [a for a, _ in taken] == np.cumsum([0, *[n for _, n in taken]])[:-1].tolist()


def features(word):
    _, found = toxicity.stems(*string_buffers(pa.array([word])))
    return set(found.tolist())


def test_long_words_are_known_as_a_whole():
    a, b = "abcdefgrinnstuvwxyz", "abcdefzzzzzstuvwxyz"
    assert features(a) != features(b) and features(a) & features(b)
    tail = "漢字" * 20
    assert features(tail + "毒") - features(tail) and len(features("short")) == 2
    assert features(a) >= {f for f in features("abcdef" + "x" * 20) if f in features("abcdef" + "y" * 20)}


def test_toxic_long_compounds_are_told_apart(spark):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(700):
        bad = i % 4 == 0
        filler = "".join(rng.choice(list("aeioulmn"), 24))
        rows.append((i, " ".join("".join(rng.choice(list("bcdfghaeiou"), 6)) for _ in range(12)) + " " + filler + ("grobian" if bad else "gruesse") + filler))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in held]) > 0.95


def test_label_model_is_that_of_brute_force(spark):
    """Rates, correlations and posteriors of one model from combined votes against the same sums row by row."""
    rng = np.random.default_rng(1)
    n, voters = 3000, 4
    y = rng.random(n) < 0.3
    true = np.array([[0.05, 0.1, 0.2, 0.05], [0.7, 0.6, 0.5, 0.7]])
    fires = rng.random((n, voters)) < true[y.astype(int)]
    fires[:, 3] = fires[:, 0]  # repeats another voter
    mask = (fires << np.arange(voters)).sum(1)
    votes = spark.createDataFrame([(int(m), int(c)) for m, c in Counter(mask.tolist()).items()], "votes long, n long").repartition(3)
    seen = np.stack([np.append(fires[:200][y[:200] == k].sum(0), (y[:200] == k).sum()) for k in range(2)]).astype(float)
    rates, rho, weight = toxicity._label_model(votes, voters, 0.3, seen)
    theta = (seen[:, :-1] + 0.5) / (seen[:, -1:] + 1.0)
    for _ in range(6):
        log = np.log(0.3 / 0.7) + np.where(fires, np.log(theta[1] / theta[0]), np.log((1 - theta[1]) / (1 - theta[0]))).sum(1)
        post = np.stack([1 / (1 + np.exp(log)), 1 / (1 + np.exp(-log))])
        theta = np.clip((post @ fires + seen[:, :-1] + 0.5) / (post.sum(1)[:, None] + seen[:, -1:] + 1.0), 1e-4, 1 - 1e-4)
    assert np.allclose(rates, theta) and np.abs(rates - true)[:, 1:3].max() < 0.12
    assert rho[0, 3] > 0.5 > abs(rho[1, 2]) and weight[0] < weight[1]


def test_clashing_names_pass_the_pipeline(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, a, "s"), (2, a, "s"), (3, b, "s"), (3, a + " x", "s"), (4, None, "s"), (None, a, "s")]
    clash = {"first": "f", "rows": "r", "copy_id": "c", "_text_key": "k", "_digest": "d", "_first": "g", "_Rows": "h", "__words": "w", "n_shingles": "n", "__text": "t", "tid": "i", "__spans": "p", "spans": "q"}
    docs = spark.createDataFrame([(*r, *clash.values()) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in clash))
    kept = corpus_pipeline.keep_one_of_copies(spark, docs, "")
    assert kept.columns == docs.columns
    got = kept.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(1, a), (3, b), (4, None), (None, a)])
    assert all(r[c] == v for r in got for c, v in clash.items())
    clean = toxicity.keep_clean(docs, toxicity.Model(np.empty(0, np.int64), np.empty(0), -1.0))
    assert clean.columns == docs.columns and clean.count() == 6
    masked = corpus_pipeline.mask_personal_data(spark, docs.withColumn("n_chars", docs["doc_id"]), "")
    assert masked.columns == [*docs.columns, "n_chars"] and masked.count() == 6


def test_the_whole_pipeline_on_a_small_corpus(spark, tmp_path):
    rng = np.random.default_rng(4)
    calm = ["".join(rng.choice(list("bcdfgaeiou"), 6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(300):
        words = list(rng.choice(calm, 30))
        if i % 5 == 0:
            words[3:5] = ["dreckskerl", "mistbock"]
        rows.append((i, " ".join(words) + (" me@mail.com" if i % 7 == 0 else ""), "en", "st"[i % 2], 1))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(1000 + i, rows[1][1], "en", "s", 1) for i in range(5)] + [(2000, None, None, None, None), (2001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = {r.doc_id for r in out}
    toxic = {i for i in range(300) if i % 5 == 0}
    assert len(docs & toxic) <= 2 and len(set(range(300)) - toxic - docs) <= 2
    assert {2000, 2001} <= docs and not docs & set(range(1000, 1005)) and 1 in docs
    assert sum(p.length for p in out) == sum({p.doc_id: p.doc_tokens for p in out}.values())


def test_long_words_that_differ_have_other_hashes():
    def pattern(k):  # the sequence whose sums of powers vanish modulo powers of two
        return "".join("ab"[bin(i).count("1") % 2] for i in range(1 << k))

    a = pattern(12)
    texts = [a, a.translate(str.maketrans("ab", "ba"))]
    hashes, _ = shingles.word_hashes(*string_buffers(pa.array(texts)))
    assert hashes[0] != hashes[1]


@pytest.mark.parametrize("ids, shingles_, wide", [(1 << 22, 40, 10), (0, 1 << 20, 0), (0, 1 << 20, 1 << 20)])
def test_join_with_small_chunks_without_filters_and_by_rows(spark, monkeypatch, ids, shingles_, wide):
    monkeypatch.setattr(partenum, "WIDE", wide)
    monkeypatch.setattr(partenum, "FILTER_IDS", ids)
    monkeypatch.setattr(partenum, "CHUNK_SHINGLES", shingles_)
    monkeypatch.setattr(partenum, "KNOWN", 3)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*base[:i], f"x{i}", *base[i:]])) for i in range(30)] + [(100 + i, " ".join(f"y{i}{k}" for k in range(20))) for i in range(30)] + [(200, " ".join(base))] * 3
    got = {r.doc_id: r.component_id for r in partenum.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in [*range(30), 200]) and all(got[100 + i] == 100 + i for i in range(30))


@pytest.mark.parametrize("operator", [packing, partenum, toxicity])
def test_staged_texts_come_to_python_in_short_batches(spark, operator):
    def sizes(tables):
        for t in tables:
            yield pa.record_batch([pa.array([t.num_rows])], ["n"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    rows = spark.range(2500).coalesce(1)
    assert [r.n for r in operator.stage(rows.mapInArrow(sizes, "n long")).collect()] == [1000, 1000, 500]
    assert spark.conf.get(setting) == before
    spark.conf.set(setting, "400")
    try:
        assert max(r.n for r in operator.stage(rows.mapInArrow(sizes, "n long")).collect()) == 400
    finally:
        spark.conf.set(setting, before)


def test_memory_is_given_back_at_the_end_of_a_task_and_after_large_groups(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    work = common.released(lambda batches: (b + 1 for b in batches))
    assert list(work(iter([1, 2]))) == [2, 3] and len(given) == 1
    next(half := work(iter([1, 2])))
    half.close()  # a task whose reader wants no more
    assert len(given) == 2
    group = common.released_groups(lambda t: t.slice(0, 1))
    assert group(pa.table({"x": np.arange(9)})).num_rows == 1 and len(given) == 2
    assert group(pa.table({"x": np.arange(1 << 18)})).num_rows == 1 and len(given) == 3
