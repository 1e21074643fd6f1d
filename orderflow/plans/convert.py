"""Convert entity files between CSV, JSON and XML without changing their content."""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderflow.errors import IngestError
from orderflow.schema import Entity
from orderflow.sinks.files import write_entity
from orderflow.sources.files import CONTROL, extension_of, read_entity


def convert(
    spark: SparkSession, source: str, target: str, entity: Entity, layout: str = "array", quoted: bool = False, source_layout: str = "document"
) -> None:
    """Both extensions are checked before anything is read; no row is lost on the way, and the order of rows is kept:
    part files one after another have the rows of the source's files, by their names, one after another.

    JSON comes as one array per part file unless ``layout`` asks for JSON Lines, which Spark and
    most tools split more easily.  CSV is read and written without quoting unless ``quoted`` is set: a
    value with a comma or a line break then raises ``needs_quotes``, and so does (``field_count``) a source
    file with a row of the wrong length.  ``source_layout`` is the layout of a JSON or XML source.
    """
    extension_of(source)
    extension_of(target)
    rows = read_entity(spark, source, entity, strict=True, quoted=quoted, layout=source_layout)
    refused = rows.filter("reject_reason IS NOT NULL").select("reject_reason", "_file").first()
    if refused is not None:
        raise IngestError(refused["reject_reason"], refused["_file"])
    ordered = rows.repartitionByRange("_file", "_pos").sortWithinPartitions("_file", "_pos")
    write_entity(ordered.drop(*CONTROL), target, entity, layout=layout, quoted=quoted)
