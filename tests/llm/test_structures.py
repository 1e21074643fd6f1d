"""Joins, vector searches and archives against brute force."""

import gzip
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm import kmeans_tree, partenum, shingles, vafile, warc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sets(texts):
    out = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def _components(docs):
    sets, parent = _sets(t for _, t in docs), {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, own in enumerate(sets):
        met = Counter(j for s in own for j in where[s])
        for j, n in met.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(docs[k][0]), find(docs[j][0])))
                parent[b] = a
        for s in own:
            where[s].append(k)
    return sorted((i, len(s), find(i)) for (i, _), s in zip(docs, sets, strict=True))


@pytest.fixture(scope="module")
def near(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = list(rng.choice(vocabulary, 40))
    docs = []
    for group in range(60):
        base = list(rng.choice(vocabulary, int(rng.integers(3, 120))))
        if group % 3 == 0:
            base[:0] = passage
        for _ in range(1 + group % 7 + 25 * (group == 9)):
            copy = list(base)
            for at in rng.integers(0, len(copy), int(rng.integers(0, max(1, len(copy) // 20) + 1))):
                copy[at] = "e" + str(rng.integers(0, 99))
            docs.append((len(docs), " ".join(copy)))
    n = len(docs)
    docs += [(n, None), (n + 1, ""), (n + 2, " \t "), (n + 3, "A b c"), (n + 4, "a  B\nc"), (n + 5, "a b c d"), (n + 6, "p q r s t u v"), (n + 7, "p q r s t u v w"), (3, "x y z"), (n + 8, "x y z")]
    return docs


@pytest.mark.parametrize("wide", [partenum.WIDE, 100])
def test_join_equals_brute_force(spark, near, monkeypatch, wide):
    monkeypatch.setattr(partenum, "CHUNK", 8)  # groups are met chunk by chunk
    monkeypatch.setattr(partenum, "WIDE", wide)  # ranges with common signatures are dealt out by rows
    frame = spark.createDataFrame([(i, t, 7) for i, t in near], "doc_id long, text string, rep int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in partenum.join(frame).collect())
    assert got == _components(near)
    assert partenum.join(frame.limit(0)).count() == 0
    alone = partenum.join(spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in alone} == {(None, None), (1, 1)}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for size in [*range(3, 40), 100, 333, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            keep = rng.permutation(a)[: int(np.ceil(0.75 * len(a)))]
            more = int(len(keep) / 0.75 - len(keep)) if len(keep) == len(a) else int(4 * len(keep) / 3) - len(a)
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, max(0, more), dtype=np.uint64)]))
            met = len(np.intersect1d(a, b))
            if 4 * met < 3 * (len(a) + len(b) - met):
                continue
            key, owner = partenum.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), np.sort(rng.choice(a, len(a) // 2, replace=False)))
            assert np.array_equal(a, b) or set(key[owner == 0]) & set(key[owner == 1]), size


def test_shingle_sets_tell_texts_apart():
    texts = ["a b c d e f", "A B C D E F", "a b c d e  f ", "f e d c b a", "", "ab c d e f", "a b", "b a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    first, second = shingles.digests(*shingles.shingle_sets(data, np.cumsum([0, *map(len, texts)])))
    assert len({*zip(first, second, strict=True)}) == len({frozenset(s) for s in _sets(texts)})


def _vectors(spark, n=900, dim=8):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=dim))]) for i in range(n)]
    rows += [(n + i, rows[100][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2100, [1.0, None] * (dim // 2)), (2200, [float("nan")] * dim), (2300, []), (2400, [0.0] * dim), (2500, [1.0] * (dim + 1)), (None, [1.0] * dim), (7, rows[7][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))


def _good(row, dim, zero):
    i, v = row
    return i is not None and v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 100)
    rows, frame = _vectors(spark)
    good = [r for r in rows if _good(r, 8, True)]
    ids, m = np.array([r[0] for r in good]), np.floor(1024 * np.array([r[1] for r in good])).astype(int)
    want = []
    for q in sorted({i for i in ids.tolist() if i % 100 == 0}):
        score = m @ m[np.flatnonzero(ids == q)[0]]
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:10]
        want += [(q, rank + 1, int(ids[k]), int(score[k])) for rank, k in enumerate(order)]
    read = []
    plain = vafile.stage
    monkeypatch.setattr(vafile, "stage", lambda df, label: read.append((label, out := plain(df, label))) or out)
    assert sorted(map(tuple, vafile.top_k(frame).collect())) == want
    sizes = {label: df.count() for label, df in read}
    pairs = len(good) * len({q for q, *_ in want})
    assert sizes["va-candidates"] < pairs / 4 and sizes["va-first"] <= 20 * len({q for q, *_ in want})
    assert vafile.top_k(frame.limit(0)).count() == 0


def test_bounds_hold_and_scores_beyond_64_bits_raise(spark):
    rng = np.random.default_rng(8)
    for scale in (3, 1000, 10**9, 10**15):
        exact = rng.integers(-scale, scale + 1, (200, 7))
        queries = rng.integers(-scale, scale + 1, (20, 7))
        about, below, above = vafile.bounds(queries, *vafile.approximate(exact))
        true = [[sum(int(x) * int(y) for x, y in zip(q, v, strict=True)) for v in exact] for q in queries]
        for q in range(20):
            assert all(a - below[q] <= t <= a + above[q] for a, t in zip(about[q], true[q], strict=True))
    big = spark.createDataFrame([(i, [2.0**40, 1.0]) for i in range(3)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        vafile.top_k(big).collect()


def test_tree_finds_neighbours(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "PROBES", 64)
    rows, frame = _vectors(spark)
    good = [r for r in rows if _good(r, 8, False)]
    ids, m = np.array([r[0] for r in good]), np.array([r[1] for r in good])
    got = defaultdict(list)
    for r in kmeans_tree.neighbours(frame).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q in {i for i in ids.tolist() if i % 100 == 0}:
        far = np.sqrt(((m - m[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        order = [int(ids[k]) for k in np.lexsort((ids, far)) if ids[k] != q][:10]
        hit, total = hit + len({*order} & {v for _, v, _ in got[q]}), total + 10
        assert len(got[q]) == 10 and all(abs(far[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for _, v, s in got[q])
    assert hit / total >= 0.9
    assert kmeans_tree.neighbours(frame.limit(0)).count() == 0


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 3)
    long_ = "\u00e9" * 60
    rows = [(i, f"http://a{i % 3}.Example.com:80/p?q={i % 4}#x", "<p>%d</p>" % (i % 5)) for i in range(40)]
    rows += [(100 + i, None if i % 2 else "not a url\r\n", long_) for i in range(6)] + [(200, "http://x.y/", None), (200, "http://x.y/", None), (None, "", long_), (99, "http://u.v/", "x" * 99), (98, "http://u.v/", "x" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = warc.archive(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        raw = next((h or "") for i, _, h in rows if i == r.page_id).encode()
        copy = len(raw) >= 100 and r.page_id != 100
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 100) if copy else ("response", None))
        assert r.payload == (None if copy else raw)
    captures = warc.write_archives(pages)
    index = warc.build_index(captures)
    absent = spark.createDataFrame([("com,zzz)/", 1), ("", 12345)], "key string, page_id long")
    assert warc.lookup(absent, index).count() == 0 and warc.archive(pages.limit(0)).count() == 0
    assert spark.range(1).select(warc.surt(F.lit("http://u@A.b.com:80/x?y#z"))).first()[0] == "com,b,a)/x?y"
    assert gzip.decompress(warc._record(1, "u", "d", None, b"x")).startswith(b"WARC/1.1\r\n")


def test_pipeline_stages(spark, near):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in near], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one_of_copies(spark, docs, "").collect()
    by = {}
    for i, n, c in _components(near):
        by[i] = c if n else i
    assert {r.doc_id for r in kept} == set(by.values()) and corpus_pipeline.keep_one_of_copies(spark, docs, "").columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "pii", "packing"]
    masked = corpus_pipeline.mask_personal_data(spark, docs, "")
    assert masked.columns == docs.columns and masked.count() == docs.count()


def test_pipeline_keeps_texts_of_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(5, ""), (5, a), (5, a), (6, a + " more"), (1, b), (7, c), (7, d), (8, d), (8, " "), (8, None), (9, c), (9, b), (None, a), (None, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    kept = corpus_pipeline.keep_one_of_copies(spark, docs, "")
    wanted = [(5, ""), (5, a), (1, b), (7, c), (7, d), (8, " "), (8, None), (None, a), (None, "")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(wanted) and kept.columns == docs.columns
