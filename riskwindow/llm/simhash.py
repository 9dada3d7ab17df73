"""SimHash near-duplicates by covering locality-sensitive hashing.

**Fingerprint.** A-Z become lower case, words are runs of anything but ASCII white
space, shingles are three words joined by a space (a shorter text is one shingle). A bit
is 1 if more than half of the shingles' XXH64 hashes (seed 42) have it.

**Tables.** Every bit position i gets a random non-zero label m(i) of r + 1 bits. Table v,
for each non-zero v of r + 1 bits, keeps the positions with <m(i), v> = 1 (mod 2) and
ignores the others. The labels of r differing positions span at most r dimensions, so
some v is orthogonal to all of them: that table ignores every difference, and the pair
meets there. With r = 3 this takes 15 tables of about 34 kept bits, and no pair is missed.

**Large buckets.** Copies are merged into one fingerprint before. A bucket with more than
``BUCKET`` distinct fingerprints is dealt out again by the same construction over the
positions that its table ignores. Positions that both levels ignore number at most
``64 - kept``; the tables are chosen so that this is at most 16, hence no bucket of the
second level holds over 65,536 fingerprints, whatever the data.

**Links.** A bucket gives a spanning forest of its links, never all pairs. Components come
from alternating large and small stars over these, in Spark.

Defined results: a null, empty or blank text has fingerprint 0 and is linked like any
other; repeated rows each get a row of the result; a null doc_id counts only where a
component has no other; an empty table gives no rows. Other columns are not looked at.
"""

import random
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

WORDS, RADIUS, BUCKET = 3, 3, 4096
SEED = 42
BITS = 64


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens])
        starts = np.concatenate(([0], ends[:-words])).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    return _majority(np.array(hashes, dtype="<u8"))


def _majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 60_000):  # sums of one step fit 16 bits
        part = hashes[at : at + 60_000].view(np.uint8)
        bits = np.unpackbits(part, bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.uint16)
    chosen = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(chosen.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_key, fingerprint (long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())],
                names=["doc_id", "text_key", "fingerprint"],
            )

    return common.keyed(docs, "text").mapInArrow(
        run, "doc_id long, text_key long, fingerprint long"
    )


@cache
def covering(radius: int, positions: tuple[int, ...], seed: int = 7) -> tuple[int, ...]:
    """One mask of kept positions per table, among the given positions."""
    labels = list(range(1, 1 << (radius + 1)))
    draw = random.Random(seed)
    # Labels are dealt out evenly, so that each table keeps about half of the positions.
    dealt = (labels * (len(positions) // len(labels) + 1))[: len(positions)]
    draw.shuffle(dealt)
    masks = []
    for v in labels:
        kept = [p for p, m in zip(positions, dealt) if (m & v).bit_count() % 2]
        masks.append(sum(1 << p for p in kept))
    return tuple(masks)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


@cache
def _second(radius: int) -> tuple[tuple[int, tuple[int, ...]], ...]:
    """For each table of the first level: its mask, and the masks over what it ignores."""
    tables = []
    for mask in covering(radius, tuple(range(BITS))):
        ignored = tuple(p for p in range(BITS) if not mask >> p & 1)
        tables.append((mask, tuple(mask | m for m in covering(radius, ignored))))
    return tuple(tables)


def _keys(masks: list[int]) -> Column:
    """An array of (table, kept bits) for the tables' masks."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("part"),
                F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits"),
            )
            for i, m in enumerate(masks)
        ]
    )


def _bucketed(distinct: DataFrame, radius: int, bucket: int) -> DataFrame:
    """part, bits, fingerprint: buckets of two or more fingerprints, each of bounded size."""
    tables = _second(radius)
    first = distinct.select(
        "fingerprint", F.inline(_keys([mask for mask, _ in tables]))
    )
    sizes = first.groupBy("part", "bits").count().filter("count > 1")
    shared = first.join(sizes, ["part", "bits"])
    small = shared.filter(F.col("count") <= bucket).select("part", "bits", "fingerprint")
    inner = F.array(*[_keys(list(masks)) for _, masks in tables])
    large = shared.filter(F.col("count") > bucket).select(
        "fingerprint", (F.col("part") * 100 + 100).alias("outer"), F.inline(inner[F.col("part")])
    )
    return small.unionByName(
        large.select((F.col("outer") + F.col("part")).alias("part"), "bits", "fingerprint")
    )


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) of the parts of one bucket, for distinct values.

    Values are taken off a list of those not yet reached, so each pair is compared once.
    """
    left = np.sort(values.astype(np.int64)).view(np.uint64)
    members, roots = [], []
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), dtype=bool)
            for x in front:
                near |= np.bitwise_count(left ^ x) <= radius
            front, left = left[near], left[~near]
            members.append(front)
            roots.append(np.full(len(front), root))
    if not members:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(members).view(np.int64), np.concatenate(roots).view(np.int64)


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """a, b: links between distinct fingerprints whose closure holds every link within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            for values in batch.column("members"):
                a, b = forest(values.values.to_numpy(zero_copy_only=False), radius)
                out_a.append(a)
                out_b.append(b)
            a = np.concatenate(out_a) if out_a else np.empty(0, np.int64)
            b = np.concatenate(out_b) if out_b else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    buckets = (
        _bucketed(distinct, radius, bucket)
        .groupBy("part", "bits")
        .agg(F.collect_set("fingerprint").alias("members"))
        .filter("size(members) > 1")
        .select("members")
    )
    return buckets.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for the nodes of a table of links a, b; a root is its component's smallest.

    Each round hangs every neighbour that is not smaller than a node onto the node's smallest
    neighbour, then every smaller one. Rounds end when the links are stars, which
    takes a number of rounds that is logarithmic in the longest path in practice.
    """
    spark = edges.sparkSession
    current = common.stored(edges.filter("a <> b"), "links")
    before = None
    while True:
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = both.join(
            least.select("a", F.least("a", "least").alias("least")), "a"
        ).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(low, "a").select(
            F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("least").alias("b"),
        )
        current = common.stored(moved.filter("a <> b").distinct(), "links")
        state = current.agg(
            F.count("*").alias("n"),
            F.count_distinct("a").alias("nodes"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("check"),
        ).first()
        if state == before or state["n"] == 0:
            break
        before = state
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def clusters(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, text_key, fingerprint, component_id of every row."""
    prints = common.stored(fingerprints(docs, words), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    parts = components(links(distinct.select("fingerprint"), radius, bucket))
    joined = distinct.join(parts, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    joined = common.stored(joined, "roots")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(ids, "root").select("fingerprint", "component_id", "root")
    return prints.join(named, "fingerprint").select(
        "doc_id", "text_key", "fingerprint", "component_id", "root"
    )


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of docs with the smallest doc_id of their component, one row for each component."""
    found = common.stored(clusters(docs, words, radius), "clusters")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    first = first.select(
        "root", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"), "n"
    ).filter("n > 1")
    ranked = found.join(first, "root")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
    verdicts = (
        ranked.groupBy("doc_id", "text_key")
        .agg(F.bool_or(is_first).alias("first"), F.count("*").alias("copies"))
        .filter("NOT first OR copies > 1")
    )
    verdicts = common.stored(verdicts, "verdicts")
    rows = common.whole_rows(docs)
    losers = verdicts.filter("NOT first")
    kept = rows.join(losers, common.same_key(rows, losers), "left_anti")
    repeated = verdicts.filter("first")
    if repeated.isEmpty():
        return kept.select("row.*")
    single = kept.join(repeated, common.same_key(kept, repeated), "left_anti").select("row")
    several = kept.join(repeated, common.same_key(kept, repeated), "left_semi")
    return single.unionByName(several.dropDuplicates(["doc_id", "text_key"]).select("row")).select("row.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    found = clusters(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
