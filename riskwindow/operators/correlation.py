"""Pearson correlations, all pairs from one aggregation."""

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import literal, quoted, rows_from
from riskwindow.operators.quality import numeric_columns


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(x, y, r) for every ordered pair; NULL where a column is constant.

    Each pair uses the rows in which both values are present; NaN counts as missing.
    """
    columns = list(columns or numeric_columns(df))
    df = _without_nan(df, columns)
    pairs = list(combinations(columns, 2))
    wide = df.agg(
        *[F.expr(f"{_pearson(x, y)} AS r{i}") for i, (x, y) in enumerate(pairs)],
        *[F.expr(f"{_own(c)} AS d{i}") for i, c in enumerate(columns)],
    )
    cells = [(literal(c), literal(c), f"d{i}") for i, c in enumerate(columns)]
    for i, (x, y) in enumerate(pairs):
        cells += [(literal(x), literal(y), f"r{i}"), (literal(y), literal(x), f"r{i}")]
    return wide.selectExpr(rows_from(["x", "y", "r"], cells))


def correlation_with_target(
    df: DataFrame, columns: Sequence[str], target: str = S.INCIDENT
) -> DataFrame:
    """Correlation of each column with the target, highest first; NaN counts as missing."""
    df = _without_nan(df, [*columns, target])
    wide = df.agg(
        *[
            F.expr(f"{_own(c) if c == target else _pearson(c, target)} AS r{i}")
            for i, c in enumerate(columns)
        ]
    )
    cells = [(literal(c), f"r{i}") for i, c in enumerate(columns)]
    return wide.selectExpr(rows_from(["feature", "r"], cells)).orderBy(
        F.desc_nulls_last("r"), "feature"
    )


def correlation_heatmap(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation cells as annotated in a heat map, two decimals."""
    return heatmap_cells(correlation_matrix(df, columns))


def heatmap_cells(matrix: DataFrame) -> DataFrame:
    return matrix.selectExpr("x", "y", "round(r, 2) AS r")


def _without_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = {name.lower(): kind for name, kind in df.dtypes}
    floating = {c for c in columns if kinds[c.lower()] in ("float", "double")}
    return df.withColumns({c: F.expr(f"nanvl({quoted(c)}, NULL)") for c in floating})


def _pearson(x: str, y: str) -> str:
    # covar_pop skips rows in which either side is NULL, so the deviations must too.
    x, y = quoted(x), quoted(y)
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"try_divide(covar_pop({x}, {y}), stddev_pop({x}) {both} * stddev_pop({y}) {both})"


def _own(column: str) -> str:
    return f"CASE WHEN stddev_pop({quoted(column)}) > 0 THEN 1D END"
