"""Readers and writers: files, JDBC, metastore tables and streams."""
