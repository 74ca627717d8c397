"""Names for helper columns."""

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores appended as make it new to `df`."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
