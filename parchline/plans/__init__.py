"""Registered queries: each name maps to a builder and, where SQL can say it, the same in SQL."""
