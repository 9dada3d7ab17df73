"""Near-duplicate vectors by spherical-cap filters.

**Code.** Vectors are turned by a fixed random rotation and cut into m blocks. Each block has a code
of B random unit vectors; a filter direction is one of them for every block, B ** m directions in
all. Their number grows with the largest label, so that vectors that are not alike seldom meet.

**Lists.** A vector's list holds all filter directions whose inner product with it exceeds a threshold: the cap
height that some ``LISTED`` directions exceed, or, where that is lower, the best product less
``SLACK`` times the spread of the products of two vectors that are just similar enough. List decoding goes block by block,
with the best that the remaining blocks can add as a bound, and never looks at all directions. In few dimensions the
slack covers the greatest difference that is possible; in many, recall is measured (README, tests).

**Join.** Vectors of one label meet at their filters. A crowded filter is dealt out into blocks of some
``BLOCK`` vectors, and each pair of blocks is a group of its own, so no group grows with the data.
Every pair that meets is verified by its cosine in double precision, and counts only at the first of the
filters that its two lists share. A group gives each vector its number of links and the
smallest vector that it reaches there, never pairs. Components come from alternating stars in Spark.

Equal vectors of a label are one class before all this, gathered by shares of their ids; copies link with
each other without a comparison.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without
label or vec_id, link with nothing and are components of their own (kept, with 0 links). Vectors of different
length do not link. Repeated rows are vectors of their own, with links to each other; rows that share a vec_id are one
node of the components and are all kept if it is the smallest. An empty table gives no rows; other columns are not looked at.
"""

import math
from collections.abc import Iterator
from functools import cache
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwindow.llm import common
from riskwindow.llm.simhash import components

SIMILARITY = 0.98
#: Filters that a vector exceeds on average at the cap height; filters for each vector of the largest label.
LISTED, PER_VECTOR = 4, 64
#: Spreads of the difference that a list allows below its vector's best filter.
SLACK = 1.5
#: The mean length of a list never passes this; fewer filters are taken instead.
LONGEST_LIST = 64
BLOCK_WORDS, BLOCK, SHARES = 4096, 512, 1024
_SMALL = 24
_VALID = (
    "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"
    " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    " AND exists(embedding, x -> x <> 0)"
)


class Code(NamedTuple):
    turn: np.ndarray
    words: list[np.ndarray]  # for each block, B directions in its dimensions
    cuts: np.ndarray
    height: float
    slack: float


def _code(dim: int, blocks: int, size: int, similarity: float) -> Code:
    draw = np.random.default_rng([7, dim, blocks, size])
    turn = np.linalg.qr(draw.standard_normal((dim, dim)))[0]
    cuts = np.linspace(0, dim, blocks + 1).astype(int)
    words = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        w = draw.standard_normal((size, b - a))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / math.sqrt(blocks))
    share = min(0.5, LISTED / size**blocks)
    gap = math.sqrt(2 - 2 * similarity) / math.sqrt(dim)
    return Code(turn, words, cuts, NormalDist().inv_cdf(1 - share) / math.sqrt(dim), SLACK * gap)


@cache
def code(dim: int, filters: int, similarity: float = SIMILARITY) -> Code:
    """A code of about so many filters; of fewer where lists would grow too long (few dimensions)."""
    blocks = max(1, min(dim, math.ceil(math.log(max(filters, 2)) / math.log(BLOCK_WORDS))))
    size = max(2, math.ceil(filters ** (1 / blocks)))
    probes = np.random.default_rng(dim).standard_normal((48, dim))
    while True:
        made = _code(dim, blocks, size, similarity)
        if size <= 2 or np.mean([len(x) for x in lists(probes, made)]) <= LONGEST_LIST:
            return made
        size = max(2, size * 2 // 3)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def lists(vectors: np.ndarray, made: Code) -> Iterator[np.ndarray]:
    """For each vector the sorted numbers of the filters that it exceeds."""
    size = len(made.words[0])
    step = max(1, 4_000_000 // (size * len(made.words)))
    for at in range(0, len(vectors), step):
        turned = unit(vectors[at : at + step]) @ made.turn
        scores = [turned[:, a:b] @ w.T for a, b, w in zip(made.cuts[:-1], made.cuts[1:], made.words)]
        best = np.array([s.max(axis=1) for s in scores])  # block, vector
        least = np.minimum(made.height, best.sum(axis=0) - made.slack)
        rest = best.sum(axis=0) - np.cumsum(best, axis=0)  # what the blocks after this one can add
        for i in range(turned.shape[0]):
            reached, number = np.zeros(1), np.zeros(1, dtype=np.int64)
            for b, s in enumerate(scores):
                need = least[i] - rest[b, i] - reached
                some = np.flatnonzero(s[i] >= need.min())
                some = some[np.argsort(-s[i, some], kind="stable")]
                taken = np.searchsorted(-s[i, some], -need, side="right")
                which = np.repeat(np.arange(len(reached)), taken)
                place = np.arange(len(which)) - np.repeat(np.cumsum(taken) - taken, taken)
                reached = reached[which] + s[i, some[place]]
                number = number[which] * size + some[place]
            yield np.sort(number)


# Classes of equal vectors, with their lists ---------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def decoded(classes: DataFrame, filters: int, similarity: float) -> DataFrame:
    """The classes, with the array of their filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            length = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            found = [None] * len(length)
            for dim in np.unique(length).tolist():
                rows = np.flatnonzero(length == dim)
                made = code(dim, filters, similarity)
                for row, x in zip(rows, lists(_matrix(vectors.take(pa.array(rows)), dim), made)):
                    found[row] = x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "filters"]
            )

    schema = T.StructType([*classes.schema.fields, T.StructField("filters", T.ArrayType(T.LongType()))])
    return classes.mapInArrow(run, schema)


def groups(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of classes at each filter that they share with another, dealt out to pairs of blocks; sorted by group."""
    members = classes.selectExpr("label", "size(embedding) AS dim", "rep", "code", "explode(filters) AS filter")
    cells = members.groupBy("label", "dim", "filter", F.expr("pmod(code, 64)").alias("share")).agg(
        F.collect_list(F.struct("rep", "code")).alias("members")
    )
    cells = common.stored(cells, "members")
    totals = cells.groupBy("label", "dim", "filter").agg(F.sum(F.size("members")).alias("total")).filter("total > 1")
    dealt = (
        cells.join(totals, ["label", "dim", "filter"])
        .selectExpr("label", "dim", "filter", f"(total - 1) DIV {int(block)} + 1 AS blocks", "inline(members)")
        .selectExpr("*", "pmod(xxhash64(code, rep, filter), blocks) AS block")
        .selectExpr("*", "explode(sequence(0L, blocks - 1)) AS other")
        .selectExpr("dim", "filter", "least(block, other) AS low", "greatest(block, other) AS high", "block", "rep", "code")
    )
    keys = ["label", "dim", "filter", "low", "high"]
    joined = dealt.join(classes.select("rep", "code", "label", "copies", "embedding", "filters"), ["rep", "code"])
    return joined.repartition(*keys).sortWithinPartitions(*keys)


def _owned(left: np.ndarray, right: np.ndarray, lists_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the first filter that two lists share is the one at hand; lists are sorted and padded by -1."""
    out = np.zeros(len(left), dtype=bool)
    step = max(1, 8_000_000 // max(1, lists_.shape[1] ** 2))
    for i in range(0, len(left), step):
        a, b, f = lists_[left[i : i + step]], lists_[right[i : i + step]], at[i : i + step]
        earlier = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a >= 0) & (a < f[:, None])
        out[i : i + step] = ~earlier.any(axis=1)
    return out


def _few_pairs(starts: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, similarity: float) -> Iterator[tuple]:
    """Pairs of rows that are similar enough of small groups, all groups of a size at once."""
    for size in np.unique(sizes).tolist():
        i, j = np.triu_indices(size, 1)
        begin = starts[sizes == size]
        step = max(1, 200_000 // max(1, len(i)))
        for at in range(0, len(begin), step):
            a = (begin[at : at + step, None] + i).ravel()
            b = (begin[at : at + step, None] + j).ravel()
            near = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= similarity
            yield a[near], b[near]


def _many_pairs(vectors: np.ndarray, lists_: np.ndarray, at: int, similarity: float) -> Iterator[tuple]:
    """Pairs of one large group that are similar enough and share no filter before this one, by products of matrices."""
    earlier = (lists_ >= 0) & (lists_ < at)
    shared, times = np.unique(lists_[earlier], return_counts=True)
    shared = shared[times > 1]
    row, place = np.nonzero(earlier)
    values = lists_[row, place]
    column = np.minimum(np.searchsorted(shared, values), max(0, len(shared) - 1))
    known = shared[column] == values if len(shared) else np.zeros(len(values), dtype=bool)
    has = np.zeros((len(vectors), max(1, len(shared))), dtype=np.float32)
    has[row[known], column[known]] = 1
    for start in range(0, len(vectors), 512):
        part = slice(start, start + 512)
        a, b = np.nonzero((vectors[part] @ vectors.T >= similarity) & (has[part] @ has.T == 0))
        a += start
        yield a[a < b], b[a < b]


def _reached(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches by the links."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[left], least[right])
        after = least.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == least).all():
            return least
        least = after


def _linked(table: pa.Table, starts: np.ndarray, similarity: float) -> Iterator[pa.RecordBatch]:
    """rep, code, links, root of the rows of whole groups that have links."""
    ends = np.append(starts[1:], len(table))
    dims = table.column("dim").to_numpy()
    group = np.repeat(np.arange(len(starts)), ends - starts)
    for dim in np.unique(dims[starts]).tolist():
        rows = np.flatnonzero(dims == dim)
        some = table.take(pa.array(rows)).combine_chunks()
        column = lambda name: some.column(name).to_numpy()  # noqa: B023, E731
        vectors = unit(_matrix(some.column("embedding").combine_chunks(), dim))
        filters = some.column("filters").combine_chunks()
        length = pc.list_value_length(filters).to_numpy()
        padded = np.full((len(rows), max(1, int(length.max()))), -1, dtype=np.int64)
        padded[np.arange(padded.shape[1]) < length[:, None]] = filters.flatten().to_numpy()
        begin = np.flatnonzero(np.diff(group[rows], prepend=-1))
        sizes = np.diff(np.append(begin, len(rows)))
        block, low, high, at = column("block"), column("low"), column("high"), column("filter")
        found = []
        for a, b in _few_pairs(begin[sizes <= _SMALL], sizes[sizes <= _SMALL], vectors, similarity):
            own = _owned(a, b, padded, at[a])
            found.append((a[own], b[own]))
        for start, size in zip(begin[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
            own = slice(start, start + size)
            found += [(start + a, start + b) for a, b in _many_pairs(vectors[own], padded[own], at[start], similarity)]
        left, right = (np.concatenate(x) for x in zip(*found)) if found else (begin[:0], begin[:0])
        across = (low[left] == high[left]) | (block[left] != block[right])
        left, right = left[across], right[across]
        if not len(left):
            continue
        rep, copies = column("rep"), column("copies")
        links = np.zeros(len(rows), dtype=np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        root = rep[_reached(len(rows), left, right)]
        has = links > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[has]), pa.array(column("code")[has]), pa.array(links[has]), pa.array(root[has])],
            names=["rep", "code", "links", "root"],
        )


def verified(grouped: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """rep, code, links, root: links of each class in each group, and a class that it reaches there."""
    keys = ["label", "dim", "filter", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # rows of the last group, which the next batch may go on with
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
            new = np.zeros(len(table), dtype=bool)
            new[:1] = True
            for key in keys:
                values = table.column(key)
                new[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy()
            starts = np.flatnonzero(new)
            waiting = table.slice(starts[-1]) if len(starts) else table
            if len(starts) > 1:
                yield from _linked(table.slice(0, starts[-1]), starts[:-1], similarity)
        if waiting is not None and len(waiting):
            yield from _linked(waiting, np.zeros(1, dtype=np.int64), similarity)

    return grouped.mapInArrow(run, "rep long, code long, links long, root long")


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of a table of vec_id, embedding, label."""
    rows = vectors.selectExpr("CAST(vec_id AS BIGINT) AS vec_id", "embedding", "label", f"coalesce({_VALID}, false) AS valid")
    alone = rows.filter("NOT valid").selectExpr(
        "vec_id", "0L AS n_links", "vec_id AS component_id", "true AS kept"
    )
    share = F.expr(f"pmod(xxhash64(vec_id), {SHARES})").alias("share")
    cells = rows.filter("valid").groupBy("label", "embedding", share).agg(F.collect_list("vec_id").alias("ids"))
    cells = common.stored(cells.drop("share"), "copies")
    classes = (
        cells.groupBy("label", "embedding")
        .agg(F.min(F.array_min("ids")).alias("rep"), F.sum(F.size("ids")).alias("copies"))
        .withColumn("code", F.expr("xxhash64(label, embedding)"))
    )
    largest = cells.groupBy("label").count().agg(F.max("count").alias("n")).first()["n"] or 1
    found = common.stored(decoded(classes, largest * PER_VECTOR, similarity), "decoded")
    linked = common.stored(verified(groups(found, block), similarity), "linked")
    counts = linked.groupBy("rep", "code").agg(F.sum("links").alias("links"))
    named = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct())
    results = (
        found.select("label", "embedding", "rep", "code", "copies")
        .join(counts, ["rep", "code"], "left")
        .join(named, F.col("rep") == F.col("node"), "left")
        .selectExpr("label", "embedding", "coalesce(links, 0L) + copies - 1 AS n_links", "coalesce(root, rep) AS component_id")
    )
    of_rows = cells.join(results, ["label", "embedding"]).selectExpr("explode(ids) AS vec_id", "n_links", "component_id")
    return of_rows.selectExpr("*", "vec_id = component_id AS kept").unionByName(alone)


def op12_cap_filters(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))


#: All pairs of a label, and reachability by recursion.
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN links ON links.a = vec_id
"""
