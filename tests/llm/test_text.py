"""Tokenizer operators, chat formatting, personal data and toxicity against the library and brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderflow.llm import bpe_codec, chat, packing, pii, queries, token_counts, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "<|endoftext|>", "a  <|endoftext|>  b<|endoftext|><|endoftext|>", "<|endoftext|", "aaaaaaaaaaaaa aaa", "\u3000x\x85 \x1c y\xa0\xa0z",
    "\u00bd\u00b2x", "e\u0301 \u0915\u093f \U0001f44d\U0001f3fd", "I'LL we'll'd", "\n\n  \t x  ", "1234567890123", "x" * 9000 + "y" * 5000, "ab" * 4000, "ab" * 4000,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "s0" if i % 3 else None, "junk") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, (None, "no id", "s1", "junk")], "doc_id long, text string, source string, n_tokens string")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in [*enumerate(ODD), (None, "no id")]}


def test_token_counts(odd, library):
    rows = token_counts.count_tokens(odd, PATH, limit=3).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(ids) for i, ids in library.items()}
    assert all(r.over_limit == (r.n_tokens > 3) for r in rows) and len(rows) == len(ODD) + 1
    assert token_counts.count_tokens(odd.limit(0), PATH).count() == 0


@pytest.mark.parametrize("size", [0, 3, 50_000])
def test_codec_is_exact_whatever_the_lexicon(odd, library, size):
    rows = bpe_codec.encode_decode(odd, PATH, lexicon_size=size, min_count=1).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library[r.doc_id]
        assert r.decoded == ("no id" if r.doc_id is None else ODD[r.doc_id] or "")
    assert len(rows) == len(ODD) + 1


def test_transducer_finds_its_words_and_no_others():
    words = sorted({b"tap", b"taps", b"top", b"tops", b"a", b"stop", b"stops"})
    built = bpe_codec.Transducer.compile(words, np.arange(len(words)), np.arange(len(words) + 1))
    other = [b"", b"t", b"to", b"topsy", b"zz", b"s"]
    data = b"".join([*words, *other])
    offsets = np.cumsum([0, *map(len, words), *map(len, other)])
    assert built.find(np.frombuffer(data, np.uint8), offsets).tolist() == [*range(len(words)), *[-1] * len(other)]
    assert len(built.final) < 10  # taps, tops and stops share their ends


@pytest.mark.parametrize("targets", [None, {"": 3.0, "s0": 1.0, "s1": 2.0}])
def test_packing_holds_every_id_once(odd, library, targets):
    pieces = packing.pack(odd, PATH, sequence=64, window_sequences=4, targets=targets).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc, ids in library.items():
        own = sorted(by_doc[doc], key=lambda p: p.start)
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == [*ids, 1]
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
    fill = []
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        fill.append(sum(p.length for p in own))
    assert sorted(fill)[1:] == [64] * (len(fill) - 1) and max(by_sequence) == len(fill) - 1
    assert packing.pack(odd.limit(0), PATH).count() == 0


def test_windows_keep_proportions():
    totals = {"a": 60_000, "b": 30_000, "c": 10_000}
    plan = packing.segments(totals)
    share = np.zeros(100)
    for a, n, place in packing.places(plan["b"], 0, 30_000, 1000):
        for x in range(place, place + n):
            share[x // 1000] += 1
        assert a >= 0
    assert share.min() >= 299 and share.max() <= 301


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "[\\INST] <\\s> <s>", "[\\\\/INST] [/INST", "", None, "a\nb [INST", " [INST] x [/INST]</s>", "plain"]
    rows = [(c, t, ["user", "assistant", "system", None, " [INST] "][(c + t) % 5], hard[(c * 3 + t) % len(hard)], 1) for c in range(6) for t in range(4)]
    rows += [(7, 0, "user", "same", 1), (7, 0, "user", "same", 1), (None, None, "assistant", "x", 1)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    by_conv = defaultdict(list)
    for c, t, role, text, _ in rows:
        by_conv[c].append((-1 if t is None else t, role or "", text or ""))
    for r in chat.format_chats(chats).collect():
        assert [(t.role, t.text) for t in r.turns] == [x[1:] for x in sorted(by_conv.pop(r.conv_id))]
    assert not by_conv
    out = {r.conv_id: r for r in chat.digests(chat.format_chats(chats)).collect()}
    assert out[7].n_turns == 2 and out[7].loss_chars == 0
    assert out[7].turns_sha256 == hashlib.sha256(b"user\nsame\nuser\nsame\n").hexdigest()
    assert chat.format_chats(chats.limit(0)).count() == 0


def test_chat_escapes_every_control_string(spark):
    texts = [queries.CHECK_TEXT, "[INST]", "</s>", "a\u00e9\U0001f600 [/INST] <\\s> <s>", "plain \u00e9", ""]
    rows = [(-1, t, role, queries.CHECK_TEXT) for t, role in enumerate(["user", "assistant"])]
    rows += [(c, t, ["assistant", "user", "\u00e9</s>"][(c + t) % 3], texts[(c + t) % len(texts)]) for c in range(3) for t in range(12)]
    out = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    escaped = "<\\/s>[\\INST] ok [\\/INST]"
    assert out[-1].formatted == f"<s>user [INST] {escaped} [/INST]</s><s>assistant [INST] {escaped} [/INST]</s>"
    for conv, r in out.items():
        own = [x for x in rows if x[0] == conv]
        for control in ("<s>", "</s>", "[INST]", "[/INST]"):
            assert r.formatted.count(control) == len(own)
        cuts = [r.formatted.encode()[m.start : m.end].decode() for m in r.loss_mask]
        assert [re.sub(r"([<\[])\\(\\*)(?=/?(s>|INST\]))", r"\1\2", c) for c in cuts] == [x[3] for x in own if x[2] == "assistant"]
    for r in chat.digests(spark.createDataFrame(list(out.values()))).collect():
        spoken = "".join(x[3] for x in rows if x[0] == r.conv_id and x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(spoken), hashlib.sha256(spoken.encode()).hexdigest())
        assert r.formatted_chars == len(out[r.conv_id].formatted)


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _base(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans(spark):
    texts = [
        None, "", "a@b.c", "a@b.c_d@e.f", "x@y x@y.z.", "@a.b a@@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1 001.2.3.004", "1.2.3 4.5.6.7",
        "4111 1111 1111 1111 then 4111-1111-1111-1111", "4111  1111 1111 1111", "+1 (403) 555-9312. +12", "+1+1234567890 5", "\x014111111111111111\x01", "\u00e9\U0001f600 a@b.c 1.1.1.1",
        "9" * 3000, "a" * 3000 + "@", "1 " * 3000, "- " * 100 + "5", "---5 (a1) @",
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, base string")
    for r in pii.find(docs).select("doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect():
        assert r.b == r.s == _base(texts[r.doc_id] or ""), texts[r.doc_id]
    assert pii.find(docs.limit(0)).count() == 0
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[3] == "[EMAIL][EMAIL]" and masked[0] is None and masked[14] == "\u00e9\U0001f600 [EMAIL] [IP]"


def test_contexts_discover_other_forms(spark):
    rows = [(i, f"word{chr(97 + i)} my mail address: user{i}@mail.com and so on") for i in range(12)]
    rows += [(20, "x my mail address: bob9(at)mail and so on"), (21, "nothing with 17 cats"), (22, "nothing with 18 cats")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.s for r in pii.find(docs).select("doc_id", pii.listed("spans").alias("s")).collect()}
    assert spans[20] == "email:19:31" and spans[21] == spans[22] == ""


def test_toxicity_learns_and_holds_out(spark):
    rng = np.random.default_rng(3)
    calm = [f"w{chr(97 + i)}{chr(97 + j)}{chr(97 + i)}n" for i in range(20) for j in range(20)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        words = list(rng.choice(calm, 40))
        if bad:
            words[3], words[9] = rng.choice(["dreckig", "dreckskerl", "mistbock"], 2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (5000, None), (5001, ""), (None, "x")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert len(out) == 903 and all(0 <= r.score <= 1 for r in out)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert toxicity.keep_clean(docs, model).count() == sum(r.predicted == 0 for r in out)
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
