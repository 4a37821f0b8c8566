"""Helpers of the tests."""

from datetime import datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
