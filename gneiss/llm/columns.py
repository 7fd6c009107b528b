"""Names for an operator's own columns beside those of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def private(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores behind it as make it differ from every column of df, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
