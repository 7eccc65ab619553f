from __future__ import annotations

from datetime import date, datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples, of some columns or of all."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
