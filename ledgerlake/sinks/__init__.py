"""Sinks: tables (catalog or path), CSV exports, mart publishing."""

from ledgerlake.sinks.writers import Store, export_csv, publish_mart, write_table

__all__ = ["Store", "export_csv", "publish_mart", "write_table"]
