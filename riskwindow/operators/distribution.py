"""Exact distribution tables built from value frequencies.

``value_frequencies`` reads the data once and keeps one row per distinct value
of a column with the number of times it occurs. Describe, histogram and box
statistics all start from that table, so the raw rows are scanned and combined
map-side once, and nothing later depends on how often a value is repeated.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwindow import schema as S
from riskwindow.functions import literal, quoted, rows_from

QUARTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 30
WHISKER_REACH = 1.5


def value_frequencies(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    keep_missing_keys: bool = False,
) -> DataFrame:
    """(by…, feature, value, n): how often each value of each column occurs.

    Missing values are left out, and so are missing group keys unless they are
    to be kept. The values are int or bigint when every column is integral,
    else double.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    used = [kinds[c.lower()] for c in columns]
    if not all(isinstance(kind, T.IntegralType) for kind in used):
        common = "double"
    elif any(isinstance(kind, T.LongType) for kind in used):
        common = "bigint"
    else:
        common = "int"
    long = rows_from(
        ["feature", "value"], [(literal(c), f"CAST({quoted(c)} AS {common})") for c in columns]
    )
    present = "value IS NOT NULL"
    if common == "double":
        present += " AND NOT isnan(value)"
    if by and not keep_missing_keys:
        df = df.filter(" AND ".join(f"{quoted(key)} IS NOT NULL" for key in by))
    return (
        df.selectExpr(*[quoted(key) for key in by], long)
        .filter(present)
        .groupBy(*by, "feature", "value")
        .agg(F.expr("count(*) AS n"))
    )


def combined(frequencies: DataFrame) -> DataFrame:
    """Frequencies over all groups, from those per group."""
    return frequencies.groupBy("feature", "value").agg(F.expr("sum(n) AS n"))


#: Values that a window ranks at most: a group with more distinct values is narrowed down first.
RANKED = 1 << 20
#: Equal parts that one level of narrowing cuts the range that occurs into.
PARTS = 1 << 22


def quantiles(
    frequencies: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] = QUARTILES
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (by…, feature).

    The order statistics around a quantile lie in a bracket, at first the whole range of values that
    occurs. A bracket with more than ``RANKED`` distinct values is narrowed: its range is cut
    into ``PARTS`` equal parts, the rows of each are counted, and the range that occurs in a part that holds a
    wanted rank is a bracket of the next level. Single values are ranked in brackets that
    are narrow enough, so no window has to hold a whole column. The range that occurs decides how many levels do
    any work: counts of a few thousand different values need none, and a level without a bracket ends before
    it reads the frequencies.
    """
    group = [*by, "feature"]
    kind = dict(frequencies.dtypes)["value"]
    few = _few(by)
    rows = frequencies.selectExpr(*map(quoted, group), "value", "n", f"{_code(kind)} AS code")
    bracket = ["lo", "hi", "below", "total", "distinct_values"]
    level = rows.groupBy(*group).agg(
        F.expr("min(code) AS lo"),
        F.expr("max(code) AS hi"),
        F.expr("0L AS below"),
        F.expr("sum(n) AS total"),
        F.expr("count(*) AS distinct_values"),
    )
    narrow = None
    for _ in range(_LEVELS[kind]):
        done = level.filter(f"distinct_values <= {RANKED}")
        narrow = done if narrow is None else narrow.unionByName(done)
        # Always true, but it needs every column, so that all uses of a level are the same table to Spark.
        wide = level.filter(f"distinct_values > {RANKED} AND lo <= hi AND below < total")
        part = f"code DIV (hi DIV {PARTS} - lo DIV {PARTS} + 1)"
        counted = (
            _within(rows, wide, group, few)
            .groupBy(*group, "lo", "below", "total", F.expr(f"{part} AS part"))
            .agg(
                F.expr("min(code) AS part_lo"),
                F.expr("max(code) AS part_hi"),
                F.expr("sum(n) AS n"),
                F.expr("count(*) AS distinct_values"),
            )
        )
        upto = f"below + sum(n) OVER (PARTITION BY {_names(group)}, lo ORDER BY part) AS upto"
        level = (
            counted.selectExpr(*map(quoted, group), "part_lo", "part_hi", "n", "total", "distinct_values", upto)
            .filter(_holds_wanted_rank(probabilities))
            .selectExpr(*map(quoted, group), "part_lo AS lo", "part_hi AS hi", "upto - n AS below", "total", "distinct_values")
        )
    narrow = level if narrow is None else narrow.unionByName(level)
    running = f"sum(n) OVER (PARTITION BY {_names(group)}, lo ORDER BY value)"
    return (
        _within(rows, narrow.select(*group, *bracket), group, few)
        .selectExpr(*map(quoted, group), "value", "n", f"below + {running} AS upto", "total")
        .filter(_holds_wanted_rank(probabilities))
        .groupBy(*group)
        .agg(*[F.expr(f"{_interpolated(p)} AS {quantile_name(p)}") for p in probabilities])
    )


def _within(rows: DataFrame, brackets: DataFrame, group: Sequence[str], few: bool) -> DataFrame:
    """The rows whose code lies in a bracket of their group, with the bracket."""
    same = " AND ".join(f"l.{quoted(key)} <=> r.{quoted(key)}" for key in group)
    right = F.broadcast(brackets) if few else brackets
    return (
        rows.alias("l")
        .join(right.alias("r"), F.expr(f"{same} AND l.code BETWEEN r.lo AND r.hi"))
        .selectExpr("l.*", "r.lo", "r.hi", "r.below", "r.total")
    )


def _few(by: Sequence[str]) -> bool:
    """Whether a table with a few rows per (by…, feature) is small whatever the data: by label, or overall."""
    return set(by) <= {S.INCIDENT}


def _matched(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    few: bool = False,
) -> DataFrame:
    """Join on keys that are never NULL.

    A right side of ``few`` rows, bounded by the number of features, labels and wanted
    ranks, is broadcast. The left side then stays where it is, instead of meeting in one task
    for each of a handful of features.

    The comparison is null-safe, because a plain one would add NULL filters below
    only one of the uses of a frequency table. Spark would then take them for
    different tables and read the data twice instead of reusing a shuffle.
    """
    same = " AND ".join(f"l.{quoted(key)} <=> r.{quoted(key)}" for key in keys)
    added = [f"r.{quoted(c)}" for c in right.columns if c not in keys]
    if few:
        right = F.broadcast(right)
    return left.alias("l").join(right.alias("r"), F.expr(same), how).selectExpr("l.*", *added)


def quantile_name(probability: float) -> str:
    return f"p{probability * 100:g}"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(map(quoted, columns))


#: Levels after which a bracket holds at most RANKED values whatever the range: each takes 22 of 64 bits away.
_LEVELS = {"int": 1, "bigint": 2, "double": 2}


def _code(kind: str) -> str:
    """A BIGINT in the order of the values."""
    if kind in ("int", "bigint"):
        return "CAST(value AS BIGINT)"
    # A double's sign, power of two and 52 bits of its mantissa; 0 for zeros.
    size = "least(abs(value), 1.7976931348623157E308D)"
    power = f"greatest(least(floor(log2({size})), 1023L), -900L)"
    code = f"(({power} + 1000L) * {1 << 52}L + CAST(floor(({size} / pow(2D, {power}) - 1) * {1 << 52}D) AS BIGINT))"
    return f"CASE WHEN value > 0 THEN {code} WHEN value < 0 THEN -{code} ELSE 0L END"


def _rank(probability: float, rounding: str) -> str:
    return f"{rounding}({float(probability)!r}D * (total - 1))"


def _holds_wanted_rank(probabilities: Sequence[float]) -> str:
    """Whether ranks upto - n … upto - 1 include an order statistic of a quantile."""
    ranks = [_rank(p, rounding) for p in probabilities for rounding in ("floor", "ceil")]
    return " OR ".join(f"(upto - n <= {rank} AND {rank} < upto)" for rank in ranks)


def _interpolated(probability: float) -> str:
    low, high = (
        f"max(CASE WHEN upto - n <= {rank} AND {rank} < upto THEN CAST(value AS DOUBLE) END)"
        for rank in (_rank(probability, "floor"), _rank(probability, "ceil"))
    )
    fraction = f"max({float(probability)!r}D * (total - 1) - {_rank(probability, 'floor')})"
    return f"{low} + ({high} - {low}) * {fraction}"


def describe(
    frequencies: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] = QUARTILES
) -> DataFrame:
    """Count, mean, sample deviation, min, quantiles and max per (by…, feature)."""
    group = [*by, "feature"]
    totals = frequencies.groupBy(*group).agg(
        F.expr("sum(n) AS count"),
        F.expr("sum(CAST(value AS DOUBLE) * n) / sum(n) AS mean"),
        F.expr("CAST(min(value) AS DOUBLE) AS min"),
        F.expr("CAST(max(value) AS DOUBLE) AS max"),
    )
    squares = "sum(n * (value - mean) * (value - mean))"
    spread = (
        _matched(frequencies, totals, group, few=_few(by))
        .groupBy(*group, "count", "mean", "min", "max")
        .agg(F.expr(f"sqrt(try_divide({squares}, count - 1)) AS std"))
    )
    placed = quantiles(frequencies, by, probabilities)
    return _matched(spread, placed, group, few=_few(by)).select(
        *group, "count", "mean", "std", "min", *[quantile_name(p) for p in probabilities], "max"
    )


def describe_columns(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Describe numeric columns of a table.

    ``approx=True`` swaps the exact quartiles for Spark's sketch, in one
    aggregation, for columns with very many distinct values.
    """
    if not approx:
        return describe(value_frequencies(df, columns))
    sketched = (
        df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .filter("value IS NOT NULL AND NOT isnan(value)")
        .groupBy("feature")
        .agg(
            F.expr("count(value) AS count"),
            F.expr("avg(value) AS mean"),
            F.expr("stddev_samp(value) AS std"),
            F.expr("min(value) AS min"),
            F.expr(f"percentile_approx(value, array{QUARTILES}, 10000) AS q"),
            F.expr("max(value) AS max"),
        )
    )
    quartiles = [f"q[{i}] AS {quantile_name(p)}" for i, p in enumerate(QUARTILES)]
    return sketched.selectExpr("feature", "count", "mean", "std", "min", *quartiles, "max")


def histogram(frequencies: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max] per feature, empty bins included.

    The last bin is closed. A constant column gets the range [x - 0.5, x + 0.5].
    """
    extent = (
        frequencies.groupBy("feature")
        .agg(
            F.expr("CAST(min(value) AS DOUBLE) AS a"),
            F.expr("CAST(max(value) AS DOUBLE) AS b"),
            F.expr("sum(n) AS total"),
        )
        # Always true, but it needs n: without n this would be another table to Spark,
        # and the data would be read twice.
        .filter("total > 0")
        .selectExpr("feature", "IF(a = b, a - 0.5D, a) AS lo", "IF(a = b, b + 0.5D, b) AS hi")
    )
    position = f"floor((value - lo) * {bins} / (hi - lo))"
    filled = (
        _matched(frequencies, extent, ["feature"], few=True)
        .groupBy("feature", F.expr(f"CAST(least({position}, {bins - 1}) AS INT) AS bin"))
        .agg(F.expr("sum(n) AS n"))
    )
    frame = extent.selectExpr("*", f"explode(sequence(0, {bins - 1})) AS bin")
    return _matched(frame, filled, ["feature", "bin"], "left", few=True).selectExpr(
        "feature",
        "bin",
        f"lo + (hi - lo) / {bins} * bin AS bin_start",
        f"lo + (hi - lo) / {bins} * (bin + 1) AS bin_end",
        "coalesce(n, 0L) AS count",
    )


def box_fences(frequencies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and the outlier fences 1.5 interquartile ranges beyond them."""
    return quantiles(frequencies, by).selectExpr(
        *map(quoted, [*by, "feature"]),
        "p25 AS q1",
        "p50 AS median",
        "p75 AS q3",
        f"p25 - {WHISKER_REACH}D * (p75 - p25) AS low_fence",
        f"p75 + {WHISKER_REACH}D * (p75 - p25) AS high_fence",
    )


def box_statistics(frequencies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers per (by…, feature): quartiles, whiskers, outlier count.

    A whisker ends at the furthest value inside its fence, but never inside the box.
    """
    group = [*by, "feature"]
    inside = "value BETWEEN low_fence AND high_fence"
    return (
        _matched(frequencies, box_fences(frequencies, by), group, few=_few(by))
        .groupBy(*group, "q1", "median", "q3")
        .agg(
            F.expr(f"least(CAST(min(IF({inside}, value, NULL)) AS DOUBLE), q1) AS whisker_low"),
            F.expr(f"greatest(CAST(max(IF({inside}, value, NULL)) AS DOUBLE), q3) AS whisker_high"),
            F.expr(f"sum(IF({inside}, 0L, n)) AS outliers"),
        )
    )


def outlier_values(frequencies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The values drawn beyond the whiskers, with how often each occurs."""
    group = [*by, "feature"]
    return (
        _matched(frequencies, box_fences(frequencies, by), group, few=_few(by))
        .filter("value < low_fence OR value > high_fence")
        .select(*group, "value", "n")
    )
