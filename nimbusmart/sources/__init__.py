"""Readers: files, JDBC, in-memory rows and catalog tables."""
