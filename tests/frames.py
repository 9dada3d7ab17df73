"""Helpers of the tests: rows of windows, frames as lists of rows, executed plans."""


def sample_rows(n=200, incidents=20):
    """Deterministic, varied windows; every tenth or so has an incident."""
    rows = []
    for i in range(n):
        rows.append(
            (
                f"svc.{(i * i) % 5}",
                f"2401{1 + i // 24:02d}_{i % 24:02d}",
                (i * 7) % 11 if i % 3 == 0 else 0,
                1 + (i * 13) % 37,
                1 + i % 4,
                1 if i % (n // incidents) == 3 else 0,
            )
        )
    return rows


def table(df, *keys):
    """Rows of a small frame as dicts, sorted by the given columns."""
    rows = [row.asDict() for row in df.collect()]
    return sorted(rows, key=lambda r: tuple((r[k] is None, r[k]) for k in keys))


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
