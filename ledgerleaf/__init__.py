"""Spark jobs that turn extracted document data into trustworthy linked tables."""
