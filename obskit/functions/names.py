"""Scratch columns beside a user's own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import wraps

from pyspark.sql import DataFrame


def fresh(df: DataFrame | Sequence[str], *names: str) -> tuple[str, ...]:
    """Names like ``names`` that ``df`` (or a list of columns) doesn't have: scratch columns beside a user's own, which
    stay columns of their own and so can be pruned."""
    taken, out = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def scratch(*names: str):
    """For an operator that takes and returns rows and needs columns ``names`` meanwhile: a user's columns of these names
    have others while it runs, and theirs again in its result. Arguments that name such a column follow."""
    own = {n.lower() for n in names}

    def around(operator):
        @wraps(operator)
        def run(df: DataFrame, *args, **kwargs):
            clash = [c for c in df.columns if c.lower() in own]
            if not clash:
                return operator(df, *args, **kwargs)
            aside = dict(zip(clash, fresh([*df.columns, *names], *clash)))
            follow = lambda a: aside.get(a, a) if isinstance(a, str) else type(a)(map(follow, a)) if type(a) in (list, tuple) else a
            out = operator(df.withColumnsRenamed(aside), *map(follow, args), **{k: follow(a) for k, a in kwargs.items()})
            return out.withColumnsRenamed({b: a for a, b in aside.items()})

        return run

    return around
