"""The registered queries: each operator and job run over the given tables, with its SQL."""
