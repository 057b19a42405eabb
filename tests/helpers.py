"""Small helpers shared by the tests."""


def rows(df, *columns):
    """Row tuples, sorted with nulls first."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def values(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def plan(df):
    """The optimised and physical plans as text."""
    execution = df._jdf.queryExecution()
    return execution.optimizedPlan().toString(), execution.executedPlan().toString()
