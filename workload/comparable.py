"""One textual form for results, so that two engines can be compared value by value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def comparable(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded through decimals, days as text, integers as long."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("decimal(22,8)"), digits).cast("double")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def sql_select(columns: str, source: str, digits: int = DIGITS) -> str:
    """The same form in SQL. ``columns`` lists ``name:kind`` with kind d, t, i or s.

    d is a double, t a day, i an integer, s text.
    """
    forms = {
        "d": f'CAST(round(CAST("{{0}}" AS DECIMAL(22,8)), {digits}) AS DOUBLE) AS "{{0}}"',
        "t": "strftime(\"{0}\", '%Y-%m-%d') AS \"{0}\"",
        "i": 'CAST("{0}" AS BIGINT) AS "{0}"',
        "s": '"{0}"',
    }
    parts = [p.split(":") for p in columns.split()]
    return "SELECT " + ", ".join(forms[k].format(n) for n, k in parts) + f" FROM {source}"
