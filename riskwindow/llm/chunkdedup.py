"""Substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: h = 2 h + gear[byte] modulo 2^32, over a
window of the last 16 bytes. A chunk ends at the first byte, ``SHORTEST`` or more after its start, where the
hash's top bits are zero, and at ``LONGEST`` bytes at the latest; never inside a character. As the
window is no longer than the shortest chunk, the ends follow the content: after an insertion the old ends
come back. A 128-bit digest tells chunks apart.

Of each chunk the first document (smallest doc_id) keeps its first copy. Copies elsewhere are repeated; where
repeated chunks that follow each other come to ``RUN`` characters or more, the span is cut out.
Shorter runs stay: they are common phrases, not passages. Digests that several documents have are marked in a bitmap
of fixed size, so that only chunks that may be repeated are shuffled a second time.

Defined results: null texts stay null, empty ones empty; both have no chunks; rows with the same doc_id are one
document, whose rows do not take chunks from each other; a null doc_id comes last; every row gets a result; an empty
table gives none. Spans are in code points, the end exclusive. Other columns are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

SHORTEST, LONGEST, TOP_BITS, RUN = 24, 128, 4, 80
WINDOW = 16
BITS = 26
LAST = 2**63 - 1


def _gear() -> np.ndarray:
    """256 numbers that look random, by the SplitMix64 rule."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolled(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: windows of 1, 2, 4, ... bytes, each from two of half the length."""
    h, width = GEAR[raw], 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, 2 * width
    return h


def ends(raw: np.ndarray, marks: np.ndarray, begin: int, stop: int) -> list[int]:
    """Ends (exclusive) of the chunks of raw[begin:stop]; marks: the places after which a chunk may end."""
    out, at = [], begin
    marked = iter(marks)
    mark = next(marked, stop)
    while stop - at > SHORTEST:
        while mark < at + SHORTEST:
            mark = next(marked, stop)
        end = min(mark, at + LONGEST, stop)
        while end < stop and raw[end] & 0xC0 == 0x80:
            end -= 1
        out.append(end)
        at = end
    if at < stop:
        out.append(stop)
    return out


def cut(texts: list[str | None]) -> list[tuple[list[int], list[bytes]]]:
    """For each text the ends of its chunks in code points, and their digests."""
    coded = [t.encode() if t else b"" for t in texts]
    joined = b"".join(coded)
    raw = np.frombuffer(joined, dtype=np.uint8)
    if not len(raw):
        return [([], []) for _ in texts]
    starts = (raw & 0xC0) != 0x80
    able = (rolled(raw) >> np.uint32(32 - TOP_BITS)) == 0
    able[:-1] &= starts[1:]
    marks = np.flatnonzero(able) + 1
    points = np.concatenate(([0], np.cumsum(starts)))
    bounds = np.concatenate(([0], np.cumsum([len(c) for c in coded])))
    first = np.searchsorted(marks, bounds, side="right")
    marks, digest, out = marks.tolist(), xxhash.xxh3_128_digest, []
    for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        own = ends(raw, marks[first[i] : first[i + 1]], lo, hi)
        at = points[own] - points[lo]
        out.append((at.tolist(), [digest(joined[a:b]) for a, b in zip([lo, *own], own)]))
    return out


def chunked(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, text_key, place (doc_id, or the last number), and of its chunks

    ends, high and low (halves of the digests), and again (numbers of those that it already had before).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches):
            found = cut(batch.column("text").to_pylist())
            again = []
            for _, digests in found:
                known: set = set()
                again.append([i for i, d in enumerate(digests) if d in known or known.add(d)])
            sizes = np.array([len(e) for e, _ in found])
            halves = np.frombuffer(b"".join(d for _, own in found for d in own), dtype=np.int64).reshape(-1, 2)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            flat = np.array([x for e, _ in found for x in e], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pc.fill_null(batch.column("doc_id"), LAST),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    pa.ListArray.from_arrays(offsets, pa.array(halves[:, 0].copy())),
                    pa.ListArray.from_arrays(offsets, pa.array(halves[:, 1].copy())),
                    pa.array(again, pa.list_(pa.int32())),
                ],
                names=["doc_id", "text_key", "place", "ends", "high", "low", "again"],
            )

    return common.keyed(docs, "text").mapInArrow(
        run,
        "doc_id long, text_key long, place long, ends array<int>, high array<long>, low array<long>, again array<int>",
    )


def spans_of(chunks: list[tuple[int, int]], least: int = RUN) -> list[tuple[int, int]]:
    """Spans of at least so many characters made of neighbours among the given chunks (start, end)."""
    out: list[list[int]] = []
    for start, end in sorted(set(chunks)):
        if out and out[-1][1] == start:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out if b - a >= least]


def _perhaps(chunks: DataFrame, marks: np.ndarray) -> DataFrame:
    """place, text_key, start, end, high, low of the chunks that the bitmap does not rule out."""
    sent = chunks.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, ends = (batch.column(c) for c in ("high", "low", "ends"))
            owner = pc.list_parent_indices(high).to_numpy()
            high, low, ends = (x.flatten().to_numpy(zero_copy_only=False) for x in (high, low, ends))
            starts = np.concatenate(([0], ends[:-1])).astype(np.int32)
            starts[np.concatenate(([True], owner[1:] != owner[:-1]))[: len(starts)]] = 0
            hit = np.flatnonzero(common.marked(sent.value, high.view(np.uint64), BITS))
            rows = pa.array(owner[hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("place").take(rows), batch.column("text_key").take(rows),
                 *(pa.array(x[hit]) for x in (starts[: len(ends)], ends, high, low))],
                names=["place", "text_key", "start", "end", "high", "low"],
            )

    return chunks.select("place", "text_key", "ends", "high", "low").mapInArrow(
        run, "place long, text_key long, start int, end int, high long, low long"
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_chunks, n_repeated, n_cut, spans (array of start and end) and text_key of every row.

    ``n_repeated`` counts all repeated chunks, ``n_cut`` those in the spans.
    """
    chunks = common.stored(chunked(docs), "chunks")
    each = chunks.select("place", F.inline(F.arrays_zip("high", "low")))
    seen = each.groupBy("high", "low").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    shared = common.stored(seen.filter("first < last").select("high", "low", "first"), "shared")
    marks = common.bitmap(shared.select(F.col("high").alias("code")), BITS)
    later = _perhaps(chunks, marks).join(shared, ["high", "low"]).filter("place > first")
    inside = chunks.filter("size(again) > 0").select(
        "place",
        "text_key",
        F.expr("inline(transform(again, i -> struct(IF(i > 0, ends[i - 1], 0) AS start, ends[i] AS end)))"),
    )
    hits = (
        later.select("place", "text_key", "start", "end")
        .unionByName(inside)
        .groupBy("place", "text_key")
        .agg(F.collect_set(F.struct("start", "end")).alias("hits"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [[(x["start"], x["end"]) for x in own] for own in batch.column("hits").to_pylist()]
            found = [spans_of(own) for own in hits]
            starts = [np.sort(np.array([a for a, _ in own])) for own in hits]
            cut = [
                int(sum(np.searchsorted(own, b) - np.searchsorted(own, a) for a, b in spans))
                for own, spans in zip(starts, found)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("place"),
                    batch.column("text_key"),
                    pc.cast(pc.list_value_length(batch.column("hits")), pa.int64()),
                    pa.array(cut, pa.int64()),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in own] for own in found],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                ],
                names=["place", "text_key", "n_repeated", "n_cut", "spans"],
            )

    spans = hits.mapInArrow(
        run, "place long, text_key long, n_repeated long, n_cut long, spans array<struct<start:int,end:int>>"
    )
    counts = chunks.select("doc_id", "text_key", "place", F.size("ends").cast("long").alias("n_chunks"))
    return counts.join(spans, ["place", "text_key"], "left").select(
        "doc_id",
        "text_key",
        "n_chunks",
        F.coalesce("n_repeated", F.lit(0).cast("long")).alias("n_repeated"),
        F.coalesce("n_cut", F.lit(0).cast("long")).alias("n_cut"),
        F.coalesce("spans", F.array()).alias("spans"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), n_chunks, n_repeated, spans, kept (the text without the spans), of every row."""
    found = common.stored(repeated_spans(docs).dropDuplicates(["doc_id", "text_key"]), "spans")
    rows = common.whole_rows(docs)
    joined = rows.join(found, common.same_key(rows, found), "left").select("row", "n_chunks", "n_repeated", "spans")
    # What is left: from each span's end to the next one's start.
    kept = """CASE WHEN size(spans) > 0 THEN array_join(transform(sequence(0, size(spans)), i -> substr(row.text,
        IF(i > 0, spans[i - 1].end, 0) + 1,
        IF(i < size(spans), spans[i].start, length(row.text)) - IF(i > 0, spans[i - 1].end, 0))), '')
        ELSE row.text END"""
    return joined.select("*", F.expr(kept).alias("kept"))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_chunks, n_repeated (chunks that are cut), n_common (repeated ones too short to go), spans."""
    return repeated_spans(common.table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chunks",
        F.col("n_cut").alias("n_repeated"),
        F.expr("n_repeated - n_cut").alias("n_common"),
        F.expr("array_join(transform(spans, x -> concat(x.start, ':', x.end)), ',')").alias("spans"),
    )
