"""Plans as text, for tests of what a job reads and shuffles."""

from __future__ import annotations


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
