"""Relational operators of the record pipeline, each a DataFrame function."""
