"""Column-level building blocks: pure expressions, no shuffles and no Python workers."""
