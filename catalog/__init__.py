"""Registered queries: each operator on data derived from the given tables, with its SQL counterpart."""
