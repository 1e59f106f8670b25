"""Check queries: the operators applied to the given tables, with reference SQL."""
