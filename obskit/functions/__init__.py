"""Column functions: one ``select`` over the table, no user functions."""
