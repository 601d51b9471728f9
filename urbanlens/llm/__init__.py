"""Operators and queries for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries`` registers them, ``oracles`` holds their DuckDB SQL.
"""
