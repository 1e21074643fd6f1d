"""Writers of entity files and of stored tables."""

from orderflow.sinks.files import write_entity
from orderflow.sinks.tables import append_table

__all__ = ["append_table", "write_entity"]
