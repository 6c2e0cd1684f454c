"""Operators of a training-data pipeline: near-duplicate removal, scans,
classifiers, decontamination, packing and exact code search.

Each module holds one operator with a general interface; ``queries`` holds
the thin registered queries and ``oracles`` their DuckDB SQL.
"""
