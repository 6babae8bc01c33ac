"""What tests share besides the session: the repository's root, plans and sorted rows."""

from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    """Collected rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
