"""Personal data: exact patterns as seeds, and lexical contexts bootstrapped from them.

All of it is DataFrame functions.  The seeds are e-mail addresses, IP addresses, card and phone
numbers.  The words before each seed, and before every other token that could identify someone, make
a graph of contexts and instances.  In rounds, a context is scored by the share of its instances that
are known to be of one kind, and instances under trusted contexts become known themselves.  What
stands under a trusted context at the end is personal data of its kind, whatever its form.

Spans are structs of kind, start and end in code points, the end exclusive.  Patterns start only where
a run of their characters starts and give nothing back, so a text of one long run costs linear time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import documents, text_of
from orderflow.session import stage

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:int,start:int,end:int>>"

# The patterns of the kinds.  A card's separators are single, between digits, and are
# turned into one mark first, so that the whole number is one run.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = "[0-9][0-9\x01]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)"
CANDIDATE = r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S++"
_CONTEXT_CHARS = 80


def _hits(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit, before) of the matches of ``pattern``, ``before`` the end of the text up to it."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string,before:string>>").alias("out"))

    def add(seen: Column, pair: Column) -> Column:
        begin = seen["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        found = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("hit"), F.right(pair["gap"], F.lit(_CONTEXT_CHARS)).alias("before"))
        return F.struct(end.alias("at"), F.concat(seen["out"], F.array(found)).alias("out"))

    pairs = F.filter(F.arrays_zip(hits.alias("hit"), gaps.alias("gap")), lambda p: p["hit"].isNotNull())
    return F.aggregate(pairs, start, add, lambda seen: seen["out"])


def _luhn(number: Column) -> Column:
    digits = F.regexp_replace(number, "[^0-9]", "")

    def value(c: Column, i: Column) -> Column:
        n = c.cast("int") * (1 + i % 2)
        return n - F.when(n > 9, 9).otherwise(0)

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def base_hits(text: Column) -> Column:
    """Array of (kind, start, end, hit, before) of the exact patterns, by kind and start."""
    joined = F.regexp_replace(F.translate(text, "\x01", "\x02"), "(?<=[0-9])[ -](?=[0-9])", "\x01")
    # what a kind cannot do without is looked for first: it is far cheaper
    kinds = (
        (text.contains("@"), _hits(text, EMAIL), lambda h: F.lit(True)),
        (text.rlike(r"[0-9]\.[0-9]"), _hits(text, IP), lambda h: h.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")),
        (text.rlike("[0-9](?:[ -]?[0-9]){12}"), _hits(joined, CARD), _luhn),
        (text.contains("+"), _hits(text, PHONE), lambda h: F.length(F.regexp_replace(h, "[^0-9]", "")).between(9, 15)),
    )
    none = F.array().cast("array<struct<kind:int,start:int,end:int,hit:string,before:string>>")

    def named(k: int, hits: Column, right: Callable[[Column], Column]) -> Column:
        return F.transform(
            F.filter(hits, lambda h: right(h["hit"])),
            lambda h: F.struct(F.lit(k).alias("kind"), h["start"].alias("start"), h["end"].alias("end"), h["hit"].alias("hit"), h["before"].alias("before")),
        )

    found = [F.when(possible, named(k, hits, right)).otherwise(none) for k, (possible, hits, right) in enumerate(kinds)]
    return F.concat(*found)


def candidate_hits(text: Column, base: Column) -> Column:
    """Tokens with a digit or an at sign that touch no base span, without the punctuation around them."""

    def trim(h: Column) -> Column:
        lead = F.length(F.regexp_extract(h["hit"], "^[^A-Za-z0-9+@]*+", 0))
        core = F.regexp_replace(F.substr(h["hit"], lead + 1), "(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
        begin = (h["start"] + lead).cast("int")
        return F.struct(begin.alias("start"), (begin + F.length(core)).alias("end"), core.alias("hit"), h["before"].alias("before"))

    def apart(h: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < h["end"]) & (h["start"] < b["end"])) & (h["end"] > h["start"])

    none = F.array().cast("array<struct<start:int,end:int,hit:string,before:string>>")
    return F.when(text.rlike("[0-9@]"), F.filter(F.transform(_hits(text, CANDIDATE), trim), apart)).otherwise(none)


def _contexts(before: Column) -> Column:
    """The last word before an instance, and the last two."""
    words = F.regexp_extract_all(F.lower(before), F.lit(r"\p{L}++:?"), F.lit(0))
    n = F.size(words)
    one = F.when(n >= 1, F.element_at(words, -1))
    two = F.when(n >= 2, F.concat(F.get(words, n - 2), F.lit(" "), F.get(words, n - 1)))
    return F.array_compact(F.array(one, two))


def discover(scanned: DataFrame, rounds: int, confidence: float, support: int) -> DataFrame:
    """(tid, kind, start, end) of the candidates that stand under a trusted context."""
    seeds = scanned.select(F.explode("base").alias("h")).select(_contexts(F.col("h.before")).alias("contexts"), F.lower("h.hit").alias("instance"), F.col("h.kind").alias("kind"))
    others = scanned.select("tid", F.explode("candidates").alias("h")).select(
        "tid", "h.start", "h.end", _contexts(F.col("h.before")).alias("contexts"), F.lower("h.hit").alias("instance")
    )
    # one edge per context and instance, so copies of a document weigh nothing
    edges = seeds.select(F.explode("contexts").alias("context"), "instance", "kind").unionByName(
        others.select(F.explode("contexts").alias("context"), "instance", F.lit(None).cast("int").alias("kind"))
    )
    edges = stage(edges.groupBy("context", "instance").agg(F.max("kind").alias("seed")), "pii-edges")
    totals = edges.groupBy("context").agg(F.count("*").alias("n"))
    known = edges.filter("seed is not null").groupBy("instance").agg(F.max("seed").alias("kind"), F.lit(1.0).alias("score"))
    trusted = None
    for turn in range(rounds):
        # an instance is of a kind with a score; a context is as sure as its instances are alike
        votes = edges.join(known, "instance").groupBy("context", "kind").agg(F.sum("score").alias("votes"))
        sure = votes.join(totals, "context").withColumn("confidence", F.col("votes") / F.col("n"))
        trusted = stage(sure.filter((F.col("confidence") >= confidence) & (F.col("votes") >= support)).select("context", "kind", "confidence"), "pii-contexts")
        if turn + 1 < rounds:
            doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
            scored = edges.filter("seed is null").join(trusted, "context").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
            best = scored.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"), F.max("score").alias("score"))
            seeded = edges.filter("seed is not null").groupBy("instance").agg(F.max("seed").alias("kind"), F.lit(1.0).alias("score"))
            known = stage(seeded.unionByName(best.join(seeded, "instance", "left_anti")), "pii-known")
    under = others.select("tid", "start", "end", F.explode("contexts").alias("context")).join(trusted, "context")
    return under.groupBy("tid", "start", "end").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))


def find(docs: DataFrame, rounds: int = 3, confidence: float = 0.8, support: int = 5) -> DataFrame:
    """``doc_id``, ``tid`` (a digest of the text), ``base`` and ``spans``, both sorted by kind and start.

    ``confidence`` and ``support`` are what a context needs to be trusted: the share of its distinct
    instances known to be of one kind, and their number.  Null texts count as empty and have no spans;
    repeated rows and equal texts get equal spans; a null id stays null; further columns are ignored;
    an empty table gives an empty one.
    """
    rows = documents(docs).select("doc_id", "text", F.md5("text").alias("tid"), base_hits(F.col("text")).alias("base"))
    scanned = stage(rows.select("doc_id", "tid", "base", candidate_hits(F.col("text"), F.col("base")).alias("candidates")), "pii")
    added = discover(scanned.select("tid", "base", "candidates"), rounds, confidence, support)
    more = stage(added.groupBy("tid").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")), "pii-added")
    base = F.transform("base", lambda h: F.struct(h["kind"].alias("kind"), h["start"].alias("start"), h["end"].alias("end"))).cast(SPANS)
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPANS))))
    return scanned.select("doc_id", "tid", F.array_sort(base).alias("base")).join(more, "tid", "left").select("doc_id", "tid", "base", spans.alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def counts() -> list[Column]:
    """How many base spans there are of each kind."""

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    return [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]


def redact(docs: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in square brackets; other columns as they are, whatever their names."""
    longest = max(map(len, docs.columns), default=0)
    whole, tid, held = (f"__{c}" + "_" * longest for c in ("text", "tid", "spans"))  # longer than any name there
    found = find(docs, **options)
    spans = stage(found.filter(F.size("spans") > 0).select("tid", "spans").dropDuplicates(["tid"]), "pii-spans")
    names = F.array(*map(F.lit, KINDS))
    text = text_of(docs)
    marked = docs.withColumns({whole: text, tid: F.md5(text)}).join(spans.select(F.col("tid").alias(tid), F.col("spans").alias(held)), tid, "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(seen: Column, s: Column) -> Column:
        begin = F.greatest(seen["at"], s["start"])
        label = F.when(s["end"] > seen["at"], F.concat(F.lit("["), F.upper(F.get(names, s["kind"])), F.lit("]"))).otherwise("")
        gap = F.substr(F.col(whole), seen["at"] + 1, begin - seen["at"])
        return F.struct(F.greatest(seen["at"], s["end"]).alias("at"), F.concat(seen["out"], gap, label).alias("out"))

    by_start = F.array_sort(held, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    rest = F.aggregate(by_start, start, cut, lambda seen: F.concat(seen["out"], F.substr(F.col(whole), seen["at"] + 1)))
    return marked.withColumn("text", F.when(F.col(held).isNotNull(), rest).otherwise(docs["text"])).drop(tid, held, whole)
