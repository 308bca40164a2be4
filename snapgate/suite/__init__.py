"""The registered queries: every operator on the given tables, each beside its SQL."""
