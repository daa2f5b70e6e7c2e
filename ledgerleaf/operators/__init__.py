"""Operators on record tables. Names that begin with an underscore are theirs: record tables have no such columns."""
