"""Small literal frames for tests."""

from __future__ import annotations

from countypanel.schemas import _schema
from countypanel.sources.reference_data import local_table


def frame(spark, columns: str, *rows):
    return local_table(spark, list(rows), _schema(columns))


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
