"""Operators: increment, enrich, merge, rollup, quality, ledger, layout, sizing.

Import from the submodules (``tidemark.operators.merge`` ...); names are not
re-exported here so that module and function names never shadow each other.
"""
