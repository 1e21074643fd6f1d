"""Readers of entity files, seed lists and tables."""

from orderflow.sources.files import read_entity, settle
from orderflow.sources.tables import append_jdbc, hex_keys, jdbc_table, keys, table

__all__ = ["append_jdbc", "hex_keys", "jdbc_table", "keys", "read_entity", "settle", "table"]
