"""Operators: lazy DataFrame -> DataFrame transformations keyed by symbol."""
