"""Registered queries: each operator on the driver's tables, with the same question in SQL."""
