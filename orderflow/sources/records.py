"""From files to raw records: one row per record, with its file and its position.

The caller says how files are laid out; their size decides nothing.

``document``, the default: every XML document and JSON array is read whole by one task.  Each file decides
for itself whether it holds a JSON array or JSON Lines, which are split.  Any valid layout is accepted.
``records``: for huge files, which are split, so that one file spreads over the cluster; all files of a
directory are alike.  JSON Lines are split at line ends, JSON arrays of any layout at ``}`` and documents
of records under any tags at ``<``: see ``chunks`` for how pieces find together.  XML of plain
``<tag>...</tag>`` records and comments, where only the tag is wanted, is split on ``</tag>``, which no
text can contain.  The rows that open and close a file keep a mark, from which ``broken_files`` checks
its overall shape.  What this layout cannot cut soundly raises; it never yields fewer rows.

Columns: ``_raw`` (record text), ``_mark`` (NULL unless the file was split), ``_file``, ``_pos``.
``_pos`` rises with the place in a file; the order between files is the read order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.errors import IngestError
from orderflow.sources import chunks

LAYOUTS = ("document", "records")

# Marks of the rows of a split file.
OPENING = "opening"  # first row, no record
CLOSING = "closing"  # last row, no record
FIRST = "first"  # a record that also opens the file
INNER = "inner"  # a record followed by another
FINAL = "final"  # a record that claims to be the last
BROKEN = "broken"  # neither


def text_rows(
    spark: SparkSession, path: str, record_end: str | None = None, whole: bool = False, of: Column | None = None
) -> DataFrame:
    """Pieces of the files under ``path``, or of those for which ``of`` holds, a condition on their metadata."""
    read = spark.read.text(path, wholetext=whole, lineSep=record_end)
    return (read if of is None else read.filter(of)).select(
        F.col("value").alias("_raw"),
        F.lit(None).cast("string").alias("_mark"),
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def not_blank(c: Column | str = "_raw") -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(r"\S")


def known_layout(layout: str) -> str:
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout}")
    return layout


def json_records(spark: SparkSession, path: str, layout: str = LAYOUTS[0]) -> DataFrame:
    """Records of JSON arrays, or of JSON Lines.  A blank file holds none: Spark writes one for an
    empty table."""
    if known_layout(layout) == "document":
        return _json_whole(spark, path)
    # Up to the first "{"; a piece may be long, so only its beginning comes back.
    head = spark.read.text(path, lineSep="{").filter(not_blank("value")).select(F.substring(F.ltrim("value"), 1, 1)).first()
    if head is None or head[0] != "[":
        return text_rows(spark, path).filter(not_blank())
    return _json_split(spark, path)


def _array_files(spark: SparkSession, path: str) -> tuple[list[str], bool]:
    """The files that begin with ``[``, and whether there are others."""
    # What stands before the first "{" tells; of it only the first character that is not blank comes back.
    pieces = spark.read.text(path, lineSep="{").select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    first = pieces.filter("_block = 0").withColumn("_pos", F.monotonically_increasing_id())
    head = F.min_by(F.regexp_extract("value", r"\A\s*(\S)", 1), "_pos").alias("_head")
    heads = first.groupBy("_file").agg(head).withColumn("_array", F.col("_head") == "[")
    found = heads.agg(F.collect_list(F.when(F.col("_array"), F.col("_file"))).alias("arrays"), F.count("*").alias("n")).first()
    return found["arrays"], found["n"] > len(found["arrays"])


def _json_whole(spark: SparkSession, path: str) -> DataFrame:
    """Arrays are read whole; a file that is no array holds a record per line, and is split at line ends."""
    arrays, others = _array_files(spark, path)
    of_lines = ~F.col("_metadata.file_path").isin(arrays) if arrays else F.lit(True)
    lines = text_rows(spark, path, of=of_lines).filter(not_blank())
    if not arrays:
        return lines
    of_arrays = F.col("_metadata.file_path").isin(arrays) if others else F.lit(True)
    docs = text_rows(spark, path, whole=True, of=of_arrays)
    # Parsed as an array of text, each element keeps its own JSON; a broken document gives NULL.
    # The flag is a column of its own before the explode, so that no row carries its document along.
    parsed = docs.select("_mark", "_file", F.from_json("_raw", "array<string>").alias("_items"))
    flagged = parsed.withColumn("_broken", F.col("_items").isNull())
    items = (
        flagged.select(F.explode_outer("_items").alias("_item"), "_mark", "_file", "_broken")
        .filter(F.col("_broken") | F.col("_item").isNotNull())
        .select(F.when(F.col("_broken"), F.lit("broken document")).otherwise(F.col("_item")).alias("_raw"), "_mark", "_file")
    )
    rows = items.unionByName(lines.drop("_pos")) if others else items
    return rows.withColumn("_pos", F.monotonically_increasing_id())


def _json_grammar() -> chunks.Grammar:
    """Pieces end with ``}``, real or not: the state is whether a string is open, the depth counts brackets.

    The last piece of an array ends without ``}`` and is given one, hence depth -1 at the end.
    """
    plain = F.when(F.contains("_raw", F.lit("\\")), F.regexp_replace("_raw", r"(?s)\\.", "")).otherwise(F.col("_raw"))
    # Quotes and brackets alone; two quotes with none between them change nothing, in a string or out of it.
    glance = F.replace(F.regexp_replace(plain, r'[^"\[\]{}]+', ""), F.lit('""'), F.lit(""))
    seen, quoted = F.col("_seen"), F.contains("_seen", F.lit('"'))
    strings = r'"[^"]*+(?:"|\z)'
    quotes = F.length(seen) - F.length(F.replace(seen, F.lit('"')))
    outside = F.when(quoted, F.regexp_replace(seen, strings, "")).otherwise(seen)
    inside = F.when(quoted, F.regexp_replace(F.regexp_replace(seen, r'\A[^"]*+"', ""), strings, "")).otherwise("")

    def delta(text: Column) -> Column:
        return 2 * F.length(F.translate(text, "]}", "")) - F.length(text) - F.length(F.translate(text, "[{]}", ""))

    cut_once = ~chunks.uncompressed() | (F.col("bytes") == F.col("size") + 1)
    sound = (F.col("end_state") == 0) & (F.col("end_depth") == -1) & cut_once
    return chunks.Grammar("}", (quotes % 2, (quotes + 1) % 2), (delta(outside), delta(inside)), 1, sound, glance=glance, after="}")


def _json_split(spark: SparkSession, path: str) -> DataFrame:
    """Objects of arrays in any layout; nested ones and texts with brackets do not matter."""
    nothing = F.col("_raw").rlike(r"\A\s*(?:\[\s*\]\s*)?\}\z")  # a blank file, or an empty array
    return (
        chunks.read(spark, path, _json_grammar())
        .filter(~nothing)
        .select(
            F.regexp_replace("_raw", r"\A\s*[\[,]\s*", "").alias("_raw"),
            F.when(F.col("_raw").rlike(r"\A\s*\]\s*\}\z"), CLOSING)
            .when(F.col("_raw").rlike(r"\A\s*\[\s*\{"), FIRST)
            .when(F.col("_raw").rlike(r"\A\s*,\s*\{"), INNER)
            .otherwise(BROKEN)
            .alias("_mark"),
            "_file",
            "_pos",
        )
    )


_NAME = r"""[^\s<>"'!?/=]"""
_TAG = rf"""\A<{_NAME}[^<>"'/]*+(?:(?:"[^"]*+"|'[^']*+'|/(?!>))[^<>"'/]*+)*+"""
_BAD_TAG = 1 << 20  # depth that no file comes back from
_NEUTRAL, _START_TAG, _LONE_TAG, _END_TAG, _NO_TAG = range(5)  # pieces that begin with ``<``


def _xml_grammar() -> chunks.Grammar:
    """Pieces begin with ``<``, which no attribute value holds.

    States: among tags and text, in a comment, in a CDATA section, in a processing instruction.
    """
    raw = F.col("_raw")
    kinds = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>"))
    opens = F.lit(0)
    for k, (begin, end) in reversed(list(enumerate(kinds, 1))):
        closed = F.contains(F.substring(raw, F.lit(len(begin) + 1), F.length(raw)), F.lit(end))
        opens = F.when(raw.startswith(begin), F.when(closed, 0).otherwise(k)).otherwise(opens)
    ends = [F.when(F.contains(raw, F.lit(end)), 0).otherwise(k) for k, (_, end) in enumerate(kinds, 1)]
    # what a piece is, told by its beginning where that is enough
    start, alone, end = raw.rlike(_TAG + ">"), raw.rlike(_TAG + "/>"), raw.rlike(rf"\A</{_NAME}[^<>/\s]*+\s*>")
    neutral = raw.startswith("<!") | raw.startswith("<?")
    glance = (
        F.when(raw.startswith("</"), F.when(end, _END_TAG).otherwise(_NO_TAG))
        .when(neutral, _NEUTRAL)
        .when(start, _START_TAG)
        .when(alone, _LONE_TAG)
        .when(raw.rlike(r"\A<\x{FEFF}?\s*\z"), _NEUTRAL)
        .otherwise(_NO_TAG)
    )
    seen = F.col("_seen")
    delta = F.when(seen == _START_TAG, 1).when(seen == _END_TAG, -1).when(seen == _NO_TAG, _BAD_TAG).otherwise(0)
    sound = (F.col("end_state") == 0) & (F.col("end_depth") == 0)
    return chunks.Grammar(
        "<", (opens, *ends), (delta, F.lit(0), F.lit(0), F.lit(0)), 1, sound, seen.isin(_START_TAG, _LONE_TAG), glance, from_root=False, before="<"
    )


def xml_children(spark: SparkSession, path: str) -> DataFrame:
    """One row per child of the root, whatever its tag, of documents that are split."""
    found = chunks.read(spark, path, _xml_grammar())
    outer, raw = found.filter(F.col("_mark").isNotNull()), F.col("_raw")
    tag = F.regexp_extract("_raw", rf"\A</?({_NAME}[^\s<>/]*+)", 1)
    # an opened and closed root, or one that is both, and nothing but comments and the like beside it
    blank = raw.rlike(r"\A<\x{FEFF}?\s*\z")
    framed = raw.rlike(rf"(?s)\A</{_NAME}[^<>]*>\s*\z|\A<!--.*-->\s*\z|\A<\?.*\?>\s*\z|\A<!--|\A<\?|\A<!\w") | blank
    root = ~framed | raw.startswith("</")
    shape = outer.groupBy("_file").agg(
        F.count(F.when(~framed & raw.rlike(_TAG + "/?>"), 1)).alias("roots"),
        F.count(F.when(~framed & ~raw.rlike(_TAG + "/?>"), 1)).alias("odd"),
        F.min(F.when(root, tag)).alias("first"),
        F.max(F.when(root, tag)).alias("last"),
        F.count(F.when(~blank, 1)).alias("filled"),
    )
    broken = shape.filter((F.col("filled") > 0) & ((F.col("roots") != 1) | (F.col("odd") > 0) | (F.col("first") != F.col("last")))).select("_file").first()
    if broken is not None:
        raise IngestError("malformed", broken["_file"])
    # one tag, or all up to the end of the last one
    tail = F.substring_index("_raw", "</", -1)
    ended = F.concat(F.substring(raw, F.lit(1), F.length(raw) - F.length(tail)), F.substring_index(tail, ">", 1), F.lit(">"))
    whole = F.when(~F.contains(raw, F.lit("</")), F.regexp_extract("_raw", _TAG + "/>", 0)).otherwise(ended)
    return found.filter(F.col("_mark").isNull()).withColumn("_raw", whole)


_QUOTED_END = r'[^"]*+(?:""[^"]*+)*+'
_OPEN_LINE = rf'(?s)\A(?:(?:"{_QUOTED_END}"[^,]*+|[^",][^,]*+)?+,)*+"{_QUOTED_END}\z'


def _csv_grammar() -> chunks.Grammar:
    """Pieces are lines; the state is whether a quoted value is open.  A quote inside an unquoted value opens nothing."""
    raw, has = F.col("_raw"), F.contains("_raw", F.lit('"'))
    rest = F.regexp_replace("_raw", rf'(?s)\A{_QUOTED_END}"[^,]*+,?', "")
    closes = raw.rlike(rf'(?s)\A{_QUOTED_END}"')
    outside = F.when(has & raw.rlike(_OPEN_LINE), 1).otherwise(0)
    inside = F.when(has & closes & ~rest.rlike(_OPEN_LINE), 0).otherwise(1)
    return chunks.Grammar(None, (outside, inside), (F.lit(0), F.lit(0)), 0, F.col("end_state") == 0, after="\n")


def csv_records(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Rows of quoted CSV as text; with ``multi_line`` values may hold line breaks."""
    if not multi_line:
        return text_rows(spark, path).filter(not_blank())
    return chunks.read(spark, path, _csv_grammar()).withColumn("_raw", F.regexp_replace("_raw", r"\n\z", "")).filter(not_blank())


def csv_fields(record: Column) -> Column:
    """The values of a row of quoted CSV."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf'(?s),("{_QUOTED_END}"[^,]*+|[^,]*+)'), F.lit(1))
    quoted = rf'(?s)\A"{_QUOTED_END}"\z'
    return F.transform(cells, lambda c: F.when(c.startswith('"') & c.rlike(quoted), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def _of_root(mark: str, text: Column, pattern: str) -> Column:
    """The mark followed by the name of the root element that the row opens or closes."""
    return F.concat(F.lit(mark + " "), F.regexp_extract(text, pattern, 1))


def _mark_word() -> Column:
    return F.substring_index("_mark", " ", 1)


def xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """One row per ``<tag>`` element of documents in the ``records`` layout.

    A piece must hold exactly one start tag.  One that holds two, because an end tag was written in
    another way (``</tag >``), is broken, as is one with a comment that does not end in it.
    """
    end = f"</{tag}>"
    begin = F.lit(rf"<{re.escape(tag)}(\s[^>]*)?>")
    start = F.regexp_instr("_raw", begin)
    starts = F.regexp_count("_raw", begin)
    uncommented = F.when(F.contains("_raw", F.lit("<![CDATA[")), F.col("_raw")).otherwise(F.regexp_replace("_raw", r"(?s)<!--.*?-->", ""))
    before = F.substring(F.col("_raw"), F.lit(1), F.col("_start") - 1)
    opens = r"^\s*(?:<\?xml[^>]*\?>)?\s*<([A-Za-z_][\w.\-]*)(?:\s[^>]*)?>\s*$"
    closes = r"^\s*</([A-Za-z_][\w.\-]*)\s*>\s*$"
    return (
        text_rows(spark, path, end)
        .withColumn("_raw", uncommented)
        .withColumn("_start", start)
        .select(
            F.when(F.col("_start") > 0, F.concat(F.substring(F.col("_raw"), F.col("_start"), F.length("_raw")), F.lit(end)))
            .otherwise(F.col("_raw"))
            .alias("_raw"),
            F.when(F.col("_raw").rlike(closes), _of_root(CLOSING, F.col("_raw"), closes))
            .when((starts != 1) | F.contains("_raw", F.lit("<!--")), BROKEN)
            .when((F.col("_start") > 0) & ~not_blank(before), INNER)
            .when((F.col("_start") > 0) & before.rlike(opens), _of_root(FIRST, before, opens))
            .otherwise(BROKEN)
            .alias("_mark"),
            "_file",
            "_pos",
        )
    )


def is_record() -> Column:
    return F.col("_mark").isNull() | ~_mark_word().isin(OPENING, CLOSING)


def broken_files(df: DataFrame) -> DataFrame:
    """Files read in pieces whose pieces do not add up: not opened first, not closed last, ...

    One partial aggregate per file, so a file holding most of the rows costs no skew.
    """

    def where(*marks: str) -> Column:
        return F.when(_mark_word().isin(*marks), F.col("_pos"))

    root = F.when(F.contains("_mark", F.lit(" ")), F.substring_index("_mark", " ", -1))
    shape = (
        df.filter(F.col("_mark").isNotNull())
        .groupBy("_file")
        .agg(
            F.min("_pos").alias("first_pos"),
            F.max("_pos").alias("last_pos"),
            F.count(where(BROKEN)).alias("n_broken"),
            F.count(where(OPENING, FIRST)).alias("n_open"),
            F.min(where(OPENING, FIRST)).alias("open_pos"),
            F.count(where(CLOSING)).alias("n_close"),
            F.max(where(CLOSING)).alias("close_pos"),
            F.count(where(OPENING)).alias("n_bare"),
            F.max(where(INNER)).alias("inner_pos"),
            F.count(where(FINAL)).alias("n_final"),
            F.max(where(FINAL)).alias("final_pos"),
            (F.min(root) == F.max(root)).alias("one_root"),
        )
    )
    framed = (
        (F.col("n_broken") == 0)
        & (F.col("n_open") == 1)
        & (F.col("open_pos") == F.col("first_pos"))
        & (F.col("n_close") == 1)
        & (F.col("close_pos") == F.col("last_pos"))
        & F.coalesce("one_root", F.lit(True))
    )
    # In an array of lines the last record, and no other, goes without a comma.
    no_records = F.col("inner_pos").isNull() & (F.col("n_final") == 0)
    commas = (F.col("n_final") == 1) & (F.coalesce("inner_pos", F.lit(-1)) < F.col("final_pos"))
    sound = framed & ((F.col("n_bare") == 0) | no_records | commas)
    return shape.filter(~F.coalesce(sound, F.lit(False))).select("_file")
