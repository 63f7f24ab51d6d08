"""Readers: files, JDBC, test tables, generated sales."""
