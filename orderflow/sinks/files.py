"""Entity files out: CSV, JSON and XML, a directory of part files written in parallel.

CSV and XML are text: booleans as True/False, user ids with hyphens, NULL as ``None``.  JSON keeps
its own types and writes NULL fields.  Values are quoted or escaped where the format asks for it.

XML documents and JSON arrays are read whole by most tools, so a part file holds ``FILE_RECORDS`` at
most: more rows make more files, not larger ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.errors import IngestError
from orderflow.functions.casts import file_text, uuid_text
from orderflow.schema import Entity
from orderflow.sources.files import extension_of

FILE_RECORDS = 10_000  # records of a part file that is one document


def text_columns(entity: Entity) -> list[Column]:
    return [file_text(F.col(a.name), a.kind).alias(a.name) for a in entity.fields]


def csv_line(entity: Entity) -> Column:
    """One row as a CSV line, quoted where needed."""
    return F.to_csv(F.struct(*text_columns(entity)), {"quote": '"', "escape": '"', "emptyValue": ""})


def json_columns(entity: Entity) -> list[Column]:
    return [
        (F.when(F.col(a.name).isNotNull(), uuid_text(F.col(a.name))) if a.kind == "uuid" else F.col(a.name)).alias(a.name)
        for a in entity.fields
    ]


def json_object(entity: Entity) -> Column:
    """One row as a JSON object, NULL fields included."""
    return F.to_json(F.struct(*json_columns(entity)), {"ignoreNullFields": "false"})


def write_csv(df: DataFrame, path: str, entity: Entity, quoted: bool = True) -> None:
    """Values that need it are quoted; with ``quoted`` off such a value raises, since lines are then cut
    at every comma."""
    if not quoted:
        values = df.select(*text_columns(entity))
        cut = values.agg(*[F.max(F.col(a.name).rlike("[,\r\n]")).alias(a.name) for a in entity.fields]).first()
        for a in entity.fields:
            if cut[a.name]:
                raise IngestError("needs_quotes", a.name)
        values.select(F.concat_ws(",", *[F.coalesce(a.name, F.lit("")) for a in entity.fields])).write.text(path)
        return
    (
        df.select(*text_columns(entity))
        .write.option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _bracketed(batches: Iterator[pa.RecordBatch], records: int) -> Iterator[pa.RecordBatch]:
    """Lines as JSON arrays, one after another, an object per line: ``records`` in each but the last, at least one array."""
    held = pa.array([], pa.string())  # lines kept back until it is known whether more follow
    for batch in batches:
        held = pa.concat_arrays([held, batch.column(0).cast(pa.string())])
        while len(held) > records:
            yield _array(held[:records])
            held = held[records:]
    yield _array(held)


def _array(lines: pa.Array) -> pa.RecordBatch:
    commas = pc.binary_join_element_wise(lines[:-1], "", ",")  # each line joined with nothing by a comma
    return pa.record_batch([pa.concat_arrays([pa.array(["["]), commas, lines[-1:], pa.array(["]"])])], ["value"])


def write_json(df: DataFrame, path: str, entity: Entity, layout: str = "lines") -> None:
    """``lines``: JSON Lines.  ``array``: each part file is one JSON array, an object per line."""
    if layout == "lines":
        df.select(*json_columns(entity)).write.option("ignoreNullFields", False).json(path)
    elif layout == "array":
        objects = df.select(json_object(entity).alias("value"))
        arrays = objects.mapInArrow(partial(_bracketed, records=FILE_RECORDS), "value string")
        # each array but a task's last has this many lines with its brackets, so files end where arrays do
        arrays.write.option("maxRecordsPerFile", FILE_RECORDS + 2).text(path)
    else:
        raise ValueError(f"unknown JSON layout {layout}")


def write_xml(df: DataFrame, path: str, entity: Entity) -> None:
    """Each part file is a complete document with its own root."""
    (
        df.select(*text_columns(entity))
        .write.format("xml")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .option("rootTag", entity.root_tag)
        .option("rowTag", entity.name)
        .save(path)
    )


def write_entity(
    df: DataFrame, path: str, entity: Entity, format: str | None = None, layout: str = "lines", quoted: bool = True
) -> None:
    ext = format or extension_of(path)
    if ext == "csv":
        write_csv(df, path, entity, quoted)
    elif ext == "json":
        write_json(df, path, entity, layout)
    elif ext == "xml":
        write_xml(df, path, entity)
    else:
        raise IngestError("unsupported_format", ext)
