"""Declared schemas, table reading and history-table writing."""
