from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def at(steps, minutes=15):
    return START + timedelta(minutes=minutes * steps)


def rows(df, *order):
    """Rows as plain tuples in a fixed order."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
