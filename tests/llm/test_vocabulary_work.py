"""Tokenizer alignment, spelling variants and token-id files against the libraries and brute force."""

import hashlib
import io
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderflow.llm import alignment, common, pfor, queries, spelling

BYTES, PIECES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
ODD = [
    None, "", " ", "  ", "a ", " a", "a  b   c ", "<|endoftext|> <s> </s> <unk> <0x41>", "plain words, and more words", "▁ literal ▁", "tab\tnew\nline\r\n",
    "é Café naïve ßEÉ ΣΣ \U0001f600\U0001f44d\U0001f3fd", "你好，世界", "\u0000x\x7f", "x" * 6000, "ab " * 3000, "ab " * 3000,
    "a b c　d\u0085e", "it's I'LL DON'T 12345", "<|startoftext|>x<|endoftext|>Y",
]


def odd(spark, **more):
    rows = [(i, t, "junk", "junk") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, (None, "no id", "junk", "junk")], "doc_id long, text string, part string, n_a string")


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)), st.integers(1, 9))
def test_gallop_is_intersection(a, b, lanes):
    before, alignment.LANES = alignment.LANES, lanes
    try:
        x, y = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
        i, j = alignment.common_ends(x, y)
    finally:
        alignment.LANES = before
    assert x[i].tolist() == y[j].tolist() == sorted(a & b)


def brute_alignment(texts):
    a_lib = Tokenizer.from_file(BYTES)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    v = alignment.Vocabularies.load(BYTES, PIECES)
    out, count = {}, Counter()
    for doc, text in texts:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        x, y = [v.a.token_bytes[i] for i in a], [v.b.token_bytes[i] for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x) != whole or b"".join(y) != whole:
            out[doc] = None
            continue
        x, y = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
        shared = sorted(set(x) & set(y))
        links = [(a[x.index(e)], b[y.index(e)]) for e in shared]
        count.update(links)
        groups, last = [], (0, 0)
        for e in shared:
            end = (x.index(e) + 1, y.index(e) + 1)
            groups.append(",".join(map(str, a[last[0] : end[0]])) + "|" + ",".join(map(str, b[last[1] : end[1]])))
            last = end
        out[doc] = (len(a), len(b), links, ";".join(groups))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return {
        doc: (0, 0, 0, 0, 0, 0, "") if r is None else (r[0], r[1], len(r[2]), len(r[2]), sum(count[x] == top[x[1]] for x in r[2]), sum(count[x] for x in r[2]), r[3])
        for doc, r in out.items()
    }


@pytest.mark.parametrize("size", [3, 1 << 18])
def test_alignment_is_that_of_the_libraries(spark, monkeypatch, size):
    monkeypatch.setattr(alignment, "SLICE", size)
    short = [(i, t if t is None or len(t) < 5000 else t[:300]) for i, t in enumerate(ODD)] + [(None, "no id")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in short], "doc_id long, text string, n_links string")
    rows = alignment.align(docs, BYTES, PIECES).collect()
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows} == brute_alignment(short)
    assert len(rows) == len(short) and any(r.n_groups == 0 for r in rows if r.doc_id == 9)
    assert alignment.align(docs.limit(0), BYTES, PIECES).count() == 0


def test_alignment_takes_texts_in_short_batches_and_gives_memory_back(spark, monkeypatch, tmp_path):
    sizes, given = tmp_path / "sizes", tmp_path / "given"

    def noted(table, *more, pieces=alignment.batches):
        with open(sizes, "a") as file:
            print(table.num_rows, file=file)
        return pieces(table, *more)

    def give_back():
        with open(given, "a") as file:
            print(1, file=file)

    monkeypatch.setattr(alignment, "batches", noted)
    monkeypatch.setattr(common, "give_back", give_back)
    docs = spark.range(2500).coalesce(1).selectExpr("id as doc_id", "'a b' as text")
    rows = alignment.align(docs, BYTES, PIECES).collect()
    assert sorted(r.doc_id for r in rows) == [*range(2500)] and {r.count_sum for r in rows} == {5000}
    assert sizes.read_text().split() == ["1000", "1000", "500"]
    assert len(given.read_text().split()) >= 3  # a task each that encodes, counts and lays out


def test_linkable_pairs_share_their_ends():
    a, b = [b"x", b"ab", b"", b"b"], [b"b", b"cab", b"b", b"x"]
    assert alignment.linkable(a, b).tolist() == [3, 4, 5, 6, 12, 13, 14]


def brute_variants(rows, noise):
    import re

    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = defaultdict(set)
    holes = defaultdict(set)  # a word with a letter left out or blanked
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    out = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [n, len(near[w]), form, words[form] if form else None, None]
    for w, r in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        r[4] = root
    return {w: tuple(r) for w, r in out.items()}


@pytest.mark.parametrize("noise, part, shards", [(3, 50_000, 100_000), (2, 4, 64)])
def test_spelling_variants_are_those_of_brute_force(spark, monkeypatch, noise, part, shards):
    monkeypatch.setattr(spelling, "PART_WORDS", part)
    monkeypatch.setattr(spelling, "SHARD_WORDS", shards)
    base = ["kitchen", "chickens", "restaurant", "École×÷", "straight", "aaaaaa", "aaaaaaa", "abcde", "abcdf", "w" * 300, "w" * 301]
    rows = [(i, " ".join(base[(i * k) % len(base)] + ["", "s", "x"][(i + k) % 3] for k in range(40)) + ", KITCHEN") for i in range(60)]
    rows += [(100 + i, "ggbbcc" + " ggbbcd" * 3 + " ggbbdd" * 9) for i in range(40)]  # forms lead on from form to form
    rows += [(None, "kitchen kitchen"), (3, None), (4, ""), (5, "kitchen"), (5, "kitchen")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(docs, noise).collect()}
    want = brute_variants(rows, noise)
    assert found == want and len(want) > 100 and any(r[4] != (r[2] or w) for w, r in want.items())
    assert spelling.variants(docs.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abé", min_size=5, max_size=9), min_size=2, max_size=60, unique=True))
def test_index_finds_all_words_at_distance_one(words):
    rows = [(w, side, asks) for w in words for side, asks in ((0, False), (0, True), (1, True))]
    word, side, asks = zip(*rows, strict=True)
    found = spelling.near_in(pa.table({"word": word, "n": pa.array([1] * len(rows), pa.int64()), "side": side, "asks": asks}))

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    pairs = set(zip(found.column("word").to_pylist(), found.column("near").to_pylist(), strict=True))
    assert pairs == {(a, b) for a in words for b in words if near(a, b)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=3000), st.sampled_from([0, 50, 95, 100]))
def test_blocks_round_trip(ids, percentile):
    blocks = pfor.pack_blocks(np.array(ids, np.int64), percentile)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert pfor.unpack_blocks(b"".join(blocks), starts).tolist() == ids


def test_blocks_keep_outliers_apart():
    ids = np.array([7, 8, 9, 10] * 255 + [4_000_000_000] * 4)
    (block,) = pfor.pack_blocks(ids)
    assert len(block) < 1024 * 2 // 8 + 100  # two bits an id, and the outliers beside
    assert pfor.unpack_blocks(block, np.array([0])).tolist() == ids.tolist()


def test_reader_reads_ranges(tmp_path):
    rng = np.random.default_rng(0)
    rows = [(None, np.empty(0, np.int64)), (1, rng.integers(0, 9, 5000)), (1, rng.integers(0, 50_000, 70_000)), (2, np.array([3]))]
    out = io.BytesIO()
    out.close = lambda: None
    writer = pfor.Writer(out)
    for doc, ids in rows:
        writer.add(doc, ids)
    assert writer.close() == (4, 75_001)
    reader = pfor.Reader(pa.PythonFile(io.BytesIO(out.getvalue()), "r"))
    flat = np.concatenate([ids for _, ids in rows])
    assert reader.docs == [None, 1, 1, 2]
    for a, b in ((0, 0), (0, 1), (1023, 1025), (4000, 9000), (75_000, 75_001), (0, 75_001)):
        assert reader.ids(a, b).tolist() == flat[a:b].tolist()


@pytest.mark.parametrize("file_bytes, known", [(1 << 27, 1 << 19), (2000, 2)])
def test_files_hold_the_librarys_ids(spark, monkeypatch, file_bytes, known):
    monkeypatch.setattr(pfor, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(pfor, "SPREAD_BYTES", file_bytes)
    monkeypatch.setattr(pfor, "KNOWN", known)
    library = Tokenizer.from_file(WORDS)
    docs = odd(spark)
    rows = pfor.binary_output(docs.repartition(3), WORDS, 2).collect()
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in [*enumerate(ODD), (None, "no id")]}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == want and len(rows) == len(want)
    at = 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        assert (r.start, r.n_tokens) == (at, len(want[r.doc_id]))
        at += r.n_tokens
    assert pfor.binary_output(docs.limit(0), WORDS, 2).count() == 0


def test_the_library_is_given_a_bounded_text_at_once(monkeypatch):
    class Watched:
        most = 0

        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, texts, **options):
            self.most = max(self.most, sum(map(len, texts)))
            return library.encode_batch_fast(texts, **options)

    library, watched = Tokenizer.from_file(WORDS), Watched()
    monkeypatch.setattr(pfor, "ENCODED", 4000)
    monkeypatch.setattr(pfor.Words, "JOINED", 50)
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("abcdeéß"), 8)) + end for end in ("", ",", "-x9", "\u0001") for _ in range(1000)]
    words = np.array(list(dict.fromkeys(made)), object)
    ids, lengths = pfor.Words(watched).encode(words, np.arange(len(words)))
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert ids.tolist() == sum(want, []) and lengths.tolist() == list(map(len, want))
    assert 0 < watched.most < 2 * 4000


def test_queries_on_the_test_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in queries.QUERIES["op11_tokenizer_alignment"](spark, sf).collect()}
    some = {d: r for d, r in brute_alignment([(d, t) for d, t in texts if t is None or len(t) < 3000]).items()}
    for doc, (n_a, n_b, n_groups, *_, groups) in some.items():
        r = found[doc]
        assert (r.n_a, r.n_b, r.n_groups) == (n_a, n_b, n_groups)
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if n_groups else "")
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in queries.QUERIES["op12_spelling_variants"](spark, sf).collect()} == brute_variants(texts, 97)
    library, at = Tokenizer.from_file(WORDS), 0
    files = {r.doc_id: r for r in queries.QUERIES["op13_token_id_files"](spark, sf).collect()}
    assert len(files) == len(found) == len(texts)
    for doc, text in sorted(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (files[doc].start, files[doc].n_tokens, files[doc].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_words_are_taken_apart_as_arrow_text():
    library = Tokenizer.from_file(WORDS)
    made = ["Word", "word,", "word,,", ",", "été!", "ß.", "ÿ;:", "x-9", "a,b", "\u0001", "b\u0001,", "日本、", "İ!", "×", "</w>", "word"]
    column = pa.array(["cut off", *made]).slice(1)
    ids, lengths = pfor.Words(library).encode(column, np.arange(len(made)))
    want = [library.encode(w, add_special_tokens=False).ids for w in made]
    assert ids.tolist() == sum(want, []) and lengths.tolist() == list(map(len, want))
    assert pfor.Words(library).encode(column.slice(0, 0), np.empty(0, np.int64))[0].tolist() == []
