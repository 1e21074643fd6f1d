"""Entity files in CSV, JSON and XML, read strictly or leniently into typed, staged rows.

Strict: every field is required.  CSV is cut at every comma unless ``quoted`` is asked for; a row with
the wrong number of fields refuses its whole file.  A broken document, an absent attribute or a value
that does not convert raises.
Lenient: CSV may be quoted and have a header that decides the column order; a row that is short,
lacks a field or does not convert is rejected alone, with its reason.

Both return the entity's columns typed, plus ``_file``, ``_pos``, ``reject_reason`` and
``reject_detail``.  NULL in JSON or XML counts as absent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.errors import IngestError
from orderflow.functions.casts import _CASTS, all_of, first_failing, missing_field
from orderflow.schema import Entity
from orderflow.session import stage, stage_watched
from orderflow.sources import records
from orderflow.sources.records import LAYOUTS

FORMATS = ("csv", "json", "xml")  # fixed value: the extensions served, compared as written
CONTROL = ("_file", "_pos", "reject_reason", "reject_detail")
_BAD = "_bad"


def _null_text() -> Column:
    return F.lit(None).cast("string")


def extension_of(path: str) -> str:
    ext = path.rsplit(".", 1)[-1]
    if ext not in FORMATS:
        raise IngestError("unsupported_format", ext)
    return ext


# ---------------------------------------------------------------- raw text columns per format


def csv_strict(spark: SparkSession, path: str, columns: list[str], quoted: bool = False) -> DataFrame:
    """Positional CSV without header: lines cut at every comma, or ``quoted`` values that may hold
    commas, quotes and line breaks."""
    parts = records.csv_fields(F.col("_raw")) if quoted else F.split("_raw", ",", -1)
    lines = records.csv_records(spark, path, multi_line=quoted).withColumn("_parts", parts)
    return lines.select(
        *[F.get("_parts", F.lit(i)).alias(c) for i, c in enumerate(columns)],
        "_mark",
        "_file",
        "_pos",
        F.when(F.size("_parts") != len(columns), F.lit("field_count")).alias("reject_reason"),
        F.when(F.size("_parts") != len(columns), F.size("_parts").cast("string")).alias("reject_detail"),
    )


def csv_headers(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per file of ``rows`` (``_raw``, ``_file``, ``_pos``): where its header is, if it has one, and in
    which places its columns are."""
    first = rows.groupBy("_file").agg(F.min("_pos").alias("_head"), F.min_by("_raw", "_pos").alias("_line"))
    names = first.withColumn("_names", records.csv_fields(F.col("_line")))
    known = all_of(F.array_contains("_names", c) for c in columns)
    places = F.array(*[F.array_position("_names", c).cast("int") - 1 for c in columns])
    return names.select(
        F.col("_file").alias("_of"),
        F.when(known, F.col("_head")).alias("_head"),
        F.when(known, places).otherwise(F.array(*[F.lit(i) for i in range(len(columns))])).alias("_places"),
    )


def csv_lenient(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True) -> DataFrame:
    """Quoted CSV; each file has a header or none, and its own decides its column order, resolved by name.

    Only the first row of a file can be its header; which place a column has is looked up by file, so
    files of any headers are read together.  Values may hold line breaks inside quotes.  Without
    ``multi_line`` lines are taken as rows, in one pass less, for text known to have none.
    """
    rows = records.csv_records(spark, path, multi_line)
    headers = stage(csv_headers(rows, columns), "csv-headers")  # staged: its true size decides the join
    cells = rows.join(headers, F.col("_file") == F.col("_of")).filter(F.col("_head").isNull() | (F.col("_head") != F.col("_pos")))
    cells = cells.withColumn("_cells", records.csv_fields(F.col("_raw")))
    short = F.size("_cells") <= F.array_max("_places")
    return cells.select(
        *[F.when(~short, F.get("_cells", F.get("_places", F.lit(i)))).alias(c) for i, c in enumerate(columns)],
        _null_text().alias("_mark"),
        "_file",
        "_pos",
        F.when(short, F.lit("short_row")).alias("reject_reason"),
        F.when(short, F.size("_cells").cast("string")).alias("reject_detail"),
    )


def _text_struct(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BAD]])


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of the parsed struct ``_rec``; text that did not parse is marked malformed."""
    broken = records.is_record() & (F.col("_rec").isNull() | F.col(f"_rec.{_BAD}").isNotNull())
    return rows.select(
        *[F.col(f"_rec.{c}").alias(c) for c in columns],
        "_mark",
        "_file",
        "_pos",
        F.when(broken, F.lit("malformed")).alias("reject_reason"),
        _null_text().alias("reject_detail"),
    )


def json_rows(spark: SparkSession, path: str, columns: list[str], layout: str = LAYOUTS[0]) -> DataFrame:
    rows = records.json_records(spark, path, layout)
    parsed = F.from_json("_raw", _text_struct(columns), {"columnNameOfCorruptRecord": _BAD})
    return _unpacked(rows.withColumn("_rec", parsed), columns)


# No name in XML holds a blank, so no child is taken for this column.
_CHILDREN = "any child"
_CDATA, _CDATA_END = "<![CDATA[", "]]>"
# CDATA sections, comments, start tags with values in quotes, and what lies between them
_XML_PARTS = r"""(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|<[^\s<>"'!?/][^<>"']*(?:(?:"[^"]*"|'[^']*')[^<>"']*)+>|.+?(?=<|\z)"""
_TAG_PARTS = r""""[^"]*"|'[^']*'|[^"']+"""


def _escaped_twice(xml: Column) -> Column:
    """A document whose texts are still escaped after one parse that unescapes them and puts values in double quotes."""

    def replaced(text: Column, *pairs: tuple[str, str]) -> Column:
        return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), pairs, text)

    def value(c: Column) -> Column:
        return F.when(c.startswith("'"), replaced(c, ("&", "&amp;"), ('"', "&amp;quot;"))).otherwise(replaced(c, ("&", "&amp;")))

    def part(c: Column) -> Column:
        inner = F.substring(c, F.lit(len(_CDATA) + 1), F.length(c) - len(_CDATA + _CDATA_END))
        tag = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_TAG_PARTS), F.lit(0)), value), "")
        section = replaced(inner, ("&", "&amp;amp;"), ("<", "&amp;lt;"), (">", "&amp;gt;"))
        return F.when(c.startswith(_CDATA), section).when(c.rlike(r"^<[^!?/]") & c.endswith(">"), tag).otherwise(replaced(c, ("&", "&amp;")))

    parts = F.transform(F.regexp_extract_all(xml, F.lit(_XML_PARTS), F.lit(0)), part)
    special = F.contains(xml, F.lit(_CDATA)) | xml.rlike(r"""=\s*'[^'<]*["]""")
    return F.when(special, F.array_join(parts, "")).otherwise(replaced(xml, ("&", "&amp;")))


def _xml_children(docs: DataFrame, columns: list[str], options: dict[str, str]) -> DataFrame:
    """Every child of the root is a record, whatever its tag."""
    schema = T.StructType([T.StructField(_CHILDREN, T.ArrayType(T.StringType())), T.StructField(_BAD, T.StringType())])
    # The wildcard gives what is inside each child, in order, with its texts unescaped once.
    doc = F.from_xml(_escaped_twice(F.col("_raw")), schema, {**options, "wildcardColName": _CHILDREN})
    broken = F.col("_doc").isNull() | F.col(f"_doc.{_BAD}").isNotNull()
    parsed = docs.withColumn("_doc", doc).select("_mark", "_file", F.col("_doc").getField(_CHILDREN).alias("_children"), broken.alias("_broken"))
    children = (
        parsed.select(F.explode_outer("_children").alias("_child"), "_mark", "_file", "_broken")
        .filter(F.col("_broken") | F.col("_child").isNotNull())
        .select("_mark", "_file", F.monotonically_increasing_id().alias("_pos"), F.concat(F.lit("<_>"), "_child", F.lit("</_>")).alias("_raw"))
    )
    return _unpacked(children.withColumn("_rec", F.from_xml("_raw", _text_struct(columns), options)), columns)


def xml_rows(spark: SparkSession, path: str, tag: str | None, columns: list[str], layout: str = LAYOUTS[0]) -> DataFrame:
    """Rows of the elements ``tag``; without a tag, of every child of the root."""
    options = {"columnNameOfCorruptRecord": _BAD, "ignoreSurroundingSpaces": "false"}
    if tag is None and records.known_layout(layout) == "records":
        return _unpacked(records.xml_children(spark, path).withColumn("_rec", F.from_xml("_raw", _text_struct(columns), options)), columns)
    if tag is None:
        docs = records.text_rows(spark, path, whole=True).filter(records.not_blank())
        return _xml_children(docs, columns, options)
    options["rowTag"] = tag
    if records.known_layout(layout) == "records":
        rows = records.xml_records(spark, path, tag)
        return _unpacked(rows.withColumn("_rec", F.from_xml("_raw", _text_struct(columns), options)), columns)
    # A blank document is an empty table: Spark writes one for a partition without rows.
    docs = records.text_rows(spark, path, whole=True).filter(records.not_blank())
    row = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    schema = T.StructType([T.StructField(tag, T.ArrayType(row)), T.StructField(_BAD, T.StringType())])
    doc = F.from_xml("_raw", schema, options)
    broken = F.col("_doc").isNull() | F.col(f"_doc.{_BAD}").isNotNull()
    # The flag is a column of its own before the explode, so that no row carries its document along.
    parsed = docs.withColumn("_doc", doc).select("_mark", "_file", F.col(f"_doc.{tag}").alias("_recs"), broken.alias("_broken"))
    return (
        parsed.select(F.explode_outer("_recs").alias("_rec"), "_mark", "_file", "_broken")
        .filter(F.col("_broken") | F.col("_rec").isNotNull())
        .select(
            *[F.col(f"_rec.{c}").alias(c) for c in columns],
            "_mark",
            "_file",
            F.monotonically_increasing_id().alias("_pos"),
            F.when(F.col("_broken"), F.lit("malformed")).alias("reject_reason"),
            _null_text().alias("reject_detail"),
        )
    )


# ---------------------------------------------------------------- typing and settling


def type_rows(df: DataFrame, entity: Entity) -> DataFrame:
    """Cast every text column to its declared kind; absent or unconvertible fields are named."""
    casts = {**{a.name: _CASTS[a.kind] for a in entity.fields}, **entity.casts}
    # columns of their own, so that each text is cast once and the value looked at twice
    typed = {a.name: f"_typed_{i}" for i, a in enumerate(entity.fields) if a.kind != "string" or a.name in entity.casts}
    cast = df.withColumns({own: casts[name](F.col(name)) for name, own in typed.items()})
    absent = missing_field(entity.columns)
    wrong = first_failing((F.col(name).isNotNull() & F.col(own).isNull(), name) for name, own in typed.items())
    checked = records.is_record() & F.col("reject_reason").isNull()
    flagged = cast.withColumn("_absent", F.when(checked, absent)).withColumn("_wrong", F.when(checked & F.col("_absent").isNull(), wrong))
    return flagged.select(
        *[F.col(typed.get(a.name, a.name)).alias(a.name) for a in entity.fields],
        "_mark",
        "_file",
        "_pos",
        F.coalesce(
            "reject_reason",
            F.when(F.col("_absent").isNotNull(), F.lit("missing_field")),
            F.when(F.col("_wrong").isNotNull(), F.lit("bad_value")),
        ).alias("reject_reason"),
        F.coalesce("reject_detail", "_absent", "_wrong").alias("reject_detail"),
    )


_RAISING = ("malformed", "missing_field", "bad_value")


def settle(typed: DataFrame, strict: bool, label: str = "read") -> DataFrame:
    """Stage typed rows and apply the whole-file rules to them: raise on broken or, if strict,
    incomplete input; if strict, give every row of a file with a wrong field count that reason.

    What the rules need to know is gathered while the rows are written.
    """
    reason = F.col("reject_reason")
    found_at = F.coalesce("reject_detail", "_file")
    staged, found = stage_watched(
        typed,
        label,
        **{r: F.min(F.when(reason == r, found_at)) for r in _RAISING},
        split=F.max("_mark"),
        uneven=F.max(reason == "field_count"),
    )
    if found["split"] is not None:
        broken = records.broken_files(staged).limit(1).collect()
        if broken:
            raise IngestError("malformed", broken[0]["_file"])
    for r in _RAISING if strict else _RAISING[:1]:
        if found[r] is not None:
            raise IngestError(r, found[r])
    rows = staged.filter(records.is_record()).drop("_mark")
    if not (strict and found["uneven"]):
        return rows
    # Staged, the set of bad files has a known size, from which the join strategy is chosen.
    bad = stage(rows.filter(reason == "field_count").select("_file").distinct(), "bad-files")
    marked = rows.join(bad.withColumn("_refused", F.lit(True)), "_file", "left")
    refused = F.when(F.col("_refused"), F.lit("field_count")).otherwise(reason)
    return marked.withColumn("reject_reason", refused).select(*rows.columns)


def raw_rows(
    spark: SparkSession,
    path: str,
    entity: Entity,
    strict: bool = True,
    format: str | None = None,
    tag: str | None = None,
    layout: str = LAYOUTS[0],
    quoted: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Untyped rows of any of the three formats, chosen by the file extension.

    ``layout`` concerns JSON and XML (see ``records``), ``quoted`` strict and ``multi_line`` lenient CSV.
    ``tag`` names the records of strict XML, where the ``records`` layout raises on other children; lenient
    XML is read without it: every child of the root is a record.
    """
    ext = format or extension_of(path)
    if ext == "csv":
        return csv_strict(spark, path, entity.columns, quoted) if strict else csv_lenient(spark, path, entity.columns, multi_line)
    if ext == "json":
        return json_rows(spark, path, entity.columns, layout)
    if ext == "xml":
        return xml_rows(spark, path, tag or entity.name if strict else None, entity.columns, layout)
    raise IngestError("unsupported_format", ext)


def read_entity(spark: SparkSession, path: str, entity: Entity, strict: bool = True, **options) -> DataFrame:
    """Read, type, stage and settle one entity file or directory of files; options as of ``raw_rows``.

    The text is parsed once; everything later reads the staged Parquet copy.
    """
    typed = type_rows(raw_rows(spark, path, entity, strict, **options), entity)
    rows = settle(typed, strict, f"read-{entity.name}")
    return entity.derive(rows) if entity.derive else rows


def accepted(df: DataFrame) -> DataFrame:
    kept = df.filter(F.col("reject_reason").isNull())
    return kept.drop(*CONTROL)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNotNull())


# ---------------------------------------------------------------- seed lists


def quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headerless CSV whose values may be quoted, all text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("quote", '"').option("escape", '"').csv(path)


def text_lines(spark: SparkSession, path: str, column: str = "name") -> DataFrame:
    """One value per line, without the line end."""
    return spark.read.text(path).select(F.col("value").alias(column))
