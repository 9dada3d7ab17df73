"""Helpers that the text operators share.

A row of a table of documents is known by its **key**: the document id and a
64-bit hash of its text. Rows that agree in both are copies of one row. Unlike
a running number, the key is the same on every read of the table, so work that
is repeated after the loss of an executor gives the same keys.
"""

from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwindow.session import discard, shared_folder

#: Characters that a Python step takes up at a time, besides the text that crosses the limit.
CHUNK_CHARS = 2_000_000


#: Folders of the tables stored since :func:`settled` began; None outside.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder; cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, as a stored table; the tables that were stored on the way to it are deleted, after a failure too."""
    made: list[str] = []
    try:
        before = _MADE.set(made)
        try:
            found = make()
        finally:
            _MADE.reset(before)
        return stored(found, name)
    finally:
        for path in made:
            discard(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: str = "text") -> Column:
    """Null and empty texts get different hashes."""
    return F.xxhash64(F.lit(0), F.col(text))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text_key and the named columns only, so that no other name can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash().alias("text_key"),
        *[F.col(c) for c in columns],
    )


def whole_rows(docs: DataFrame) -> DataFrame:
    """The key, and all columns as one struct named ``row``."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash().alias("text_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )


def same_key(left: DataFrame, right: DataFrame) -> Column:
    """Joins on the key; a missing doc_id equals a missing doc_id."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of about CHUNK_CHARS bytes of text each; no row is split or left out."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        start = total = 0
        for i, n in enumerate(lengths.to_pylist()):
            total += n
            if total >= CHUNK_CHARS:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def bitmap(codes: DataFrame, bits: int) -> np.ndarray:
    """2 ** bits bits, one set for the leading bits of each value of ``code``; built in Spark, in 4 KB parts.

    Its size does not depend on the data: what it does not rule out has to be looked up.
    """
    place = f"(shiftrightunsigned(code, {64 - bits}) + 1)"
    parts = (
        codes.selectExpr(f"bitmap_bucket_number({place}) AS part", f"bitmap_bit_position({place}) AS bit")
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in parts.collect():
        raw = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        start = (row["part"] - 1) * len(raw)
        out[start : start + len(raw)] = raw
    return out


def marked(marks: np.ndarray, codes: np.ndarray, bits: int) -> np.ndarray:
    """Which of the codes (unsigned) may be among those of the bitmap."""
    place = codes >> np.uint64(64 - bits)
    return marks[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 > 0
