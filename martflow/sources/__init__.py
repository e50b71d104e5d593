"""Readers and writers: files, JDBC, catalog tables, change topics."""
