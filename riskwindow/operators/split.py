"""Train/test splits and class weights."""

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import lookup, quoted, rows_from

TRAIN, TEST = "train", "test"
_PREFIX_DIGITS = 4  # hex digits that one level adds, so 65,536 hash buckets
_HASH_DIGITS = 32
#: Rows of a class that are put in order at most; identical rows count as one.
ORDERED = 65_536
_COPIES_PER_ROW = 100_000


def random_split(
    df: DataFrame, test_share: float = S.TEST_SHARE, seed: int = S.SEED
) -> tuple[DataFrame, DataFrame]:
    """Bernoulli split. Which rows go where depends on the partitioning of ``df``."""
    train, test = df.randomSplit([1 - test_share, test_share], seed=seed)
    return train, test


def label_counts(df: DataFrame, label: str = S.INCIDENT) -> dict[int, int]:
    """Rows per class; one row for each class reaches the driver."""
    rows = df.groupBy(quoted(label)).agg(F.expr("count(*) AS n")).collect()
    return _checked_classes({value: n for value, n in rows}, label)


def test_sizes(counts: Mapping[int, int], test_share: float = S.TEST_SHARE) -> dict[int, int]:
    """Exact test rows per class: ceil of the share overall, largest remainder per class.

    Ties between remainders go to the smaller label.
    """
    total = sum(counts.values())
    n_test = math.ceil(test_share * total)
    n_train = total - n_test
    if min(counts.values()) < 2:
        raise ValueError("the least populated class has fewer than 2 rows")
    if min(n_test, n_train) < len(counts):
        raise ValueError("the split leaves fewer rows than classes on one side")
    train = {label: n * n_train // total for label, n in counts.items()}
    by_remainder = sorted(counts, key=lambda label: (-(counts[label] * n_train % total), label))
    for label in by_remainder[: n_train - sum(train.values())]:
        train[label] += 1
    return {label: counts[label] - train[label] for label in counts}


def row_hash(df: DataFrame, seed: int = S.SEED) -> str:
    """md5 of the seed and the row.

    A feature table is hashed by its six raw columns, since those determine the
    engineered ones; other tables by all columns.
    """
    raw = set(S.WINDOW_SCHEMA.names)
    own = [c for c in df.columns if c.lower() in raw]
    columns = own if len(own) == len(raw) else df.columns
    cells = [f"coalesce(CAST({quoted(c)} AS STRING), '\\\\N')" for c in columns]
    return f"md5(concat_ws('|', '{seed}', {', '.join(cells)}))"


def stratified_split(
    df: DataFrame,
    label: str = S.INCIDENT,
    test_share: float = S.TEST_SHARE,
    seed: int = S.SEED,
) -> DataFrame:
    """Add a ``split`` column with exactly sized, stratified train and test rows.

    Within each class the rows with the smallest hashes become the test rows.
    One aggregation counts the rows per class and hash prefix; a running sum over
    the prefixes finds the one at which the test rows of a class end, and only that
    row per class reaches the driver. Where that prefix still holds more than ``ORDERED`` rows
    it is lengthened by further digits, each time over its own rows only. All other prefixes are then
    decided row by row without a shuffle, and only the rows of the boundary prefix are
    put in order. There, identical rows travel as one row with a count, so a value
    that fills a third of the table is no burden either. The result does not depend
    on the partitioning.
    """
    columns = [quoted(c) for c in df.columns]
    # As a generator's output, the hash is computed once per row. A plain column
    # would be copied into every filter and projection that mentions it.
    hashed = df.selectExpr("*", f"stack(1, {row_hash(df, seed)}) AS (_hash)")
    boundary, missing, digits = _boundaries(hashed, label, test_share)
    prefix = f"substr(_hash, 1, {digits})"
    edge = lookup(quoted(label), boundary)
    decided = hashed.filter(f"{prefix} <> {edge}").selectExpr(
        *columns, f"IF({prefix} < {edge}, '{TEST}', '{TRAIN}') AS split"
    )
    order = f"OVER (PARTITION BY {quoted(label)} ORDER BY _hash, {', '.join(columns)})"
    to_test = f"{lookup(quoted(label), missing)} - (sum(_copies) {order} - _copies)"
    sided = (
        hashed.filter(f"{prefix} = {edge}")
        .groupBy("_hash", *columns)
        .agg(F.expr("count(*) AS _copies"))
        .selectExpr(*columns, "_copies", f"greatest(least(_copies, {to_test}), 0L) AS _test")
        .selectExpr(
            *columns,
            rows_from(
                ["split", "_rows"],
                [(f"'{TEST}'", "_test"), (f"'{TRAIN}'", "_copies - _test")],
            ),
        )
    )
    return decided.unionByName(_repeat(sided.filter("_rows > 0"), "_rows"))


def with_class_weight(
    df: DataFrame, counts: Mapping[int, int], label: str = S.INCIDENT, weight: str = "weight"
) -> DataFrame:
    """Add the balanced weight n / (classes * rows of the class) of each row's label, as a projection."""
    total = sum(counts.values())
    weights = {value: total / (len(counts) * n) for value, n in counts.items()}
    return df.selectExpr("*", f"{lookup(quoted(label), weights)} AS {quoted(weight)}")


def _boundaries(hashed: DataFrame, label: str, test_share: float) -> tuple[dict, dict, int]:
    """Per class, the prefix at which its test rows end and how many rows of that are test rows; its digits."""
    digits = _PREFIX_DIGITS
    buckets = _counted(hashed, label, digits)
    buckets.persist()  # at most 65,536 rows per class, used twice
    try:
        totals = buckets.groupBy("label").agg(F.expr("sum(n) AS n")).collect()
        counts = _checked_classes({value: n for value, n in totals}, label)
        missing = test_sizes(counts, test_share)
        edges = _edges(buckets, missing)
    finally:
        buckets.unpersist()
    boundary = {value: edge["prefix"] for value, edge in edges.items()}
    missing = {value: missing[value] - edge["below"] for value, edge in edges.items()}
    while digits < _HASH_DIGITS and max(edge["different"] for edge in edges.values()) > ORDERED:
        inside = hashed.filter(f"substr(_hash, 1, {digits}) = {lookup(quoted(label), boundary)}")
        digits += _PREFIX_DIGITS
        edges = _edges(_counted(inside, label, digits), missing)
        boundary = {value: edge["prefix"] for value, edge in edges.items()}
        missing = {value: missing[value] - edge["below"] for value, edge in edges.items()}
    return boundary, missing, digits


def _counted(hashed: DataFrame, label: str, digits: int) -> DataFrame:
    """Rows per class and hash prefix; ``different`` is 1 where all of them are identical."""
    return (
        hashed.groupBy(F.expr(f"{quoted(label)} AS label"), F.expr(f"substr(_hash, 1, {digits}) AS prefix"))
        .agg(F.expr("count(*) AS n"), F.expr("min(_hash) AS lowest"), F.expr("max(_hash) AS highest"))
        .selectExpr("label", "prefix", "n", "IF(lowest = highest, 1L, n) AS different")
    )


def _edges(buckets: DataFrame, missing: Mapping[int, int]) -> dict[int, dict]:
    """Per class, the bucket in which the last of the missing test rows lies."""
    wanted = f"greatest({lookup('label', missing)}, 1)"
    rows = (
        buckets.selectExpr("*", "sum(n) OVER (PARTITION BY label ORDER BY prefix) AS upto")
        .filter(f"{wanted} > upto - n AND {wanted} <= upto")
        .selectExpr("label", "prefix", "upto - n AS below", "different")
        .collect()
    )
    return {row["label"]: row.asDict() for row in rows}


def _checked_classes(classes: dict, label: str) -> dict:
    if None in classes:
        raise ValueError(f"{label!r} has missing values")
    if not classes:
        raise ValueError("there are no rows to split")
    return classes


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, spread over tasks when it is many."""
    columns = [c for c in df.columns if c != times]
    piece = f"explode(sequence(1L, CAST(ceil({times} / {_COPIES_PER_ROW}) AS BIGINT))) AS _piece"
    left = f"{times} - (_piece - 1) * {_COPIES_PER_ROW}"
    return (
        df.selectExpr("*", piece)
        .selectExpr(*map(quoted, columns), f"least({left}, {_COPIES_PER_ROW}L) AS _part")
        .hint("rebalance")
        .selectExpr(*map(quoted, columns), "explode(sequence(1L, _part)) AS _copy")
        .select(*map(quoted, columns))
    )
