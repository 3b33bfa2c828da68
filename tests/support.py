"""Helpers that test modules import."""


def plan_of(df) -> str:
    """Physical plan text (tests only look at operator names)."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()
