"""Column-level helpers; see ``tidemark.functions.columns``."""
