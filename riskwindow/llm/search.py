"""Ranked lexical search, term at a time with limited accumulators.

**Scores.** A term is a run of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. Each term
of an item adds w * ((10 ** 9 tf) div (1000 tf + 20 m)) to a document that holds it, where w falls with the number of
documents that hold the term and m grows with the document's length. All sums are whole numbers.

**Statistics.** One reading of all documents counts them, their terms, and the documents of each term that an item
has; a task sends one row for each term.

**Search.** A second reading searches the documents where they lie. A task turns what it has read into posting lists of the
items' terms, a shard of some ``POSTINGS`` of them at a time. For each item it goes through the lists
from the rarest term to the most frequent one. A document gets an accumulator when a list first brings it, but no
longer once the largest amounts that the remaining lists can add do not reach the ``first``-th best
partial score (or the ``first``-th best score of the task's earlier shards): no document without an accumulator
can come among the first ones then. Accumulators that are there are updated to their exact scores. Each
task sends its first documents of each item; these are ranked in two rounds.

Items are taken in blocks of some ``BLOCK`` bytes of terms, each searched against all documents, so what a task gets
of them is bounded; documents are never compared with each other.

Defined results: null, empty and blank texts have no terms; such items have no rows and such documents no rank.
Rows of the same item_id are one item with the terms of all of them, a missing item_id included. Repeated rows
of documents are documents of their own and ranked apart. Among equal scores the smaller doc_id comes first,
a missing one last. Other columns are not looked at. A very long text is read in parts and counts as one document.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common
from riskwindow.llm import words as W

FIRST = 50
#: Bytes of terms of items that are searched at once; postings of a shard.
BLOCK, POSTINGS = 8 << 20, 2_000_000
#: Shares by document in which the first documents of all tasks are ranked before they meet.
SHARES = 256
#: All of ASCII but letters and digits.
KINDS = W.kinds(bytes(c for c in range(128) if not chr(c).isalnum()))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the different terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in W.words(batch.column("text"), KINDS):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(found.text)), found.word.cast(pa.binary())],
                    names=["item_id", "term"],
                )

    named = items.selectExpr("CAST(item_id AS BIGINT) AS item_id", "text")
    return named.mapInArrow(run, "item_id long, term binary").distinct()


def postings(batch: pa.RecordBatch, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text has; and text, number and occurrences of those that are among the given ones."""
    length = np.zeros(batch.num_rows, dtype=np.int64)
    held = [np.empty(0, dtype=np.int64)]
    for found in W.words(batch.column("text"), KINDS):
        ids, different = W.numbered(found.word)
        length += np.bincount(found.text, minlength=batch.num_rows)
        known = pc.fill_null(pc.index_in(different, value_set=terms), -1).to_numpy(zero_copy_only=False)
        number = known[ids].astype(np.int64)
        some = number >= 0
        held.append(found.text[some] * len(terms) + number[some])
    both, times = np.unique(np.concatenate(held), return_counts=True)
    return length, both // len(terms), both % len(terms), times


def statistics(docs: DataFrame, terms: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and for each given term the documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        holding = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for chunk in common.chunks([batch]):
                length, _, number, _ = postings(chunk, terms)
                n += int((length > 0).sum())
                total += int(length.sum())
                holding += np.bincount(number, minlength=len(terms))
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(([-2, -1], some)), pa.int64()),
                pa.array(np.concatenate(([n, total], holding[some])), pa.int64()),
            ],
            names=["number", "count"],
        )

    counted = docs.select("text").mapInArrow(run, "number long, count long")
    found = {r["number"]: r["count"] for r in counted.groupBy("number").agg(F.sum("count").alias("count")).collect()}
    holding = np.array([found.get(i, 0) for i in range(len(terms))], dtype=np.int64)
    return found.get(-2, 0), found.get(-1, 0), holding


def weight(n: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * holding + 1)))


class Best:
    """The first documents of an item so far: highest scores first, then smaller ids, missing ids last."""

    def __init__(self, first: int):
        self.first = first
        self.score = np.empty(0, dtype=np.int64)
        self.doc = np.empty(0, dtype=np.int64)
        self.unnamed = np.empty(0, dtype=bool)

    def least(self) -> int:
        """What a document must reach to come among the first ones."""
        return int(self.score[-1]) if len(self.score) == self.first else 0

    def add(self, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> None:
        if len(score) > self.first:
            some = score >= np.partition(score, len(score) - self.first)[len(score) - self.first]
            score, doc, unnamed = score[some], doc[some], unnamed[some]
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        unnamed = np.concatenate([self.unnamed, unnamed])
        order = np.lexsort((doc, unnamed, -score))[: self.first]
        self.score, self.doc, self.unnamed = score[order], doc[order], unnamed[order]


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, first: int, least: int) -> np.ndarray:
    """Scores of the documents of a shard from lists of (documents, amounts), rarest term first.

    Those without an accumulator have 0. ``least`` is a score that a document must reach anyway.
    """
    scores = np.zeros(documents, dtype=np.int64)
    largest = [int(amounts.max()) if len(amounts) else 0 for _, amounts in lists]
    rest = sum(largest)
    open_ = rest >= least
    for (docs, amounts), most in zip(lists, largest):
        if open_:
            scores[docs] += amounts
        else:
            has = scores[docs] > 0
            scores[docs[has]] += amounts[has]
        rest -= most
        if open_:
            partial = scores[scores > 0]
            kth = int(np.partition(partial, len(partial) - first)[len(partial) - first]) if len(partial) >= first else 0
            open_ = rest >= max(kth, least)
    return scores


def _searched(shard: list[tuple], items: list[np.ndarray], weights: np.ndarray, n: int, total: int, best: list[Best]) -> None:
    """Search a shard of (ids, missing ids, lengths, documents, numbers, occurrences) for all items."""
    ids, unnamed, length = (np.concatenate([s[i] for s in shard]) for i in range(3))
    before = np.cumsum([0] + [len(s[0]) for s in shard[:-1]])
    docs = np.concatenate([s[3] + b for s, b in zip(shard, before)])
    number, times = (np.concatenate([s[i] for s in shard]) for i in (4, 5))
    size = 100 - 50 + (50 * length * n) // total
    amounts = weights[number] * ((1_000_000_000 * times) // (1000 * times + 20 * size[docs]))
    order = np.argsort(number, kind="stable")
    docs, amounts = docs[order], amounts[order]
    cuts = np.searchsorted(number[order], np.arange(len(weights) + 1))
    for terms, found in zip(items, best):
        lists = [(docs[cuts[t] : cuts[t + 1]], amounts[cuts[t] : cuts[t + 1]]) for t in terms]
        scores = accumulated(lists, len(ids), found.first, found.least())
        some = np.flatnonzero((scores > 0) & (scores >= found.least()))
        if len(some):
            found.add(scores[some], ids[some], unnamed[some])


def search(docs: DataFrame, names: list[int | None], items: list[np.ndarray], terms: pa.Array, first: int) -> DataFrame:
    """item_id, doc_id, score: each task's first documents of each item of a block; items are arrays of term numbers."""
    n, total, holding = statistics(docs, terms)
    weights = np.array([weight(n, int(h)) for h in holding], dtype=np.int64)
    items = [np.array(sorted(t, key=lambda i: (holding[i], i)), dtype=np.int64) for t in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(first) for _ in items]
        shard, held = [], 0
        for batch in batches:
            for chunk in common.chunks([batch]):
                length, text, number, times = postings(chunk, terms)
                doc = chunk.column("doc_id")
                unnamed = doc.is_null().to_numpy(zero_copy_only=False)
                ids = pc.fill_null(doc, 0).to_numpy(zero_copy_only=False)
                shard.append((ids, unnamed, length, text, number, times))
                held += len(text) + len(ids)
                if held >= POSTINGS:
                    _searched(shard, items, weights, n, total, best)
                    shard, held = [], 0
        if shard and total:
            _searched(shard, items, weights, n, total, best)
        for name, found in zip(names, best):
            if len(found.score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(found.score), pa.int64()),
                        pa.array(found.doc, pa.int64(), mask=found.unnamed),
                        pa.array(found.score, pa.int64()),
                    ],
                    names=["item_id", "doc_id", "score"],
                )

    named = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return named.mapInArrow(run, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: the first documents of each item."""
    found = common.stored(item_terms(items), "item-terms")
    size = found.agg(F.sum(F.octet_length("term") + 16).alias("n")).first()["n"] or 0
    blocks = int(size) // BLOCK + 1
    placed = found.withColumn("block", F.expr(f"pmod(xxhash64(item_id), {blocks})"))
    parts = [_block(docs, placed.filter(F.col("block") == b), first) for b in range(blocks)]
    rows = reduce(DataFrame.unionByName, parts)
    order = "ORDER BY score DESC, doc_id NULLS LAST"
    share = f"PARTITION BY item_id, pmod(xxhash64(doc_id), {SHARES})"
    near = rows.selectExpr("*", f"row_number() OVER ({share} {order}) AS place").filter(f"place <= {int(first)}")
    last = near.selectExpr("item_id", "doc_id", "score", f"row_number() OVER (PARTITION BY item_id {order}) AS rank")
    return last.filter(f"rank <= {int(first)}").select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, placed: DataFrame, first: int) -> DataFrame:
    """Search one block of items, whose terms are bounded by BLOCK bytes and the longest item."""
    of_item: dict = {}
    numbers: dict[bytes, int] = {}
    for row in placed.select("item_id", "term").collect():
        of_item.setdefault(row["item_id"], []).append(numbers.setdefault(bytes(row["term"]), len(numbers)))
    if not numbers:
        return docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    names = sorted(of_item, key=lambda i: (i is None, i))
    terms = pa.array(list(numbers), pa.large_binary())
    return search(docs, names, [of_item[i] for i in names], terms, first)


def op13_search(spark, sf_dir: str) -> DataFrame:
    return ranked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[0-9a-z\x{80}-\x{10FFFF}]+')"""
#: Every document that shares a term with an item is scored.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM i) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * total.n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, total GROUP BY term, total.n),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * tf.n * total.n) // total.l)))) AS BIGINT) AS score
      FROM i JOIN tf USING (term) JOIN weights USING (term), total GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""
