"""Operators on text corpora. Nothing else in the library imports this subpackage; queries over the given tables are in ``queries``."""
