"""Line dedup by pairwise alignment.

Documents that overlap are found through anchors, the lines are aligned by patience diff, and
the common blocks leave the later document (the one with the larger doc_id).

**Anchors.** From each line on, and up to each line, as many lines as reach ``BLOCK`` characters, two at least;
two lines of ``PAIR`` characters or more that follow each other, blank lines between or not; a line of ``LONG``
characters or more; a line of ``BLOCK`` characters or more that is the only one of its document; all these
however common they are. Also a line of ``LINE`` characters or more that is rare (in at most ``max(RARE,
RARE_SHARE x documents)`` documents). So a short common line alone (a licence notice) makes no pair, and every
other common block has an anchor over each of its lines. A document is paired with the **first** document of
each of its anchors and with no other: the pairs grow with the lines, not with the square of a group of
copies, and as the first holder of a block never loses it, one copy of every block stays.

**Meeting.** The lines of a first holder are sent once for every ``PARTNERS`` of its documents, not with each of them, and
come before theirs in a sorted partition. So a hot first holder is dealt out over tasks, and a task holds the
lines of one first holder and one batch at a time.

**Alignment.** Equal lines at both ends, then lines that are unique on both sides in
longest increasing order, then the gaps between these in the same way. Consecutive
aligned lines make a block; blocks of ``BLOCK`` characters or more are deleted.

**Repeated and moved blocks.** What the alignment leaves is sought in the whole first holder: runs of equal lines
of ``BLOCK`` characters or more, of two lines or with one of ``LONG`` characters. So a run that *any* earlier
document has is deleted, whatever the order of blocks. A shorter line that is alone is deleted where some
place of it in the first holder lies between the aligned lines around it; one that has moved stays.

Lines are compared without the white space around them; blank lines are no anchors. Defined results:
a null text stays null; an empty one stays empty; repeated rows (same id and text) count as one
document and get the same result; a null doc_id is later than any other; an empty table gives none.
"""

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

LINE, LONG, PAIR, BLOCK = 20, 200, 40, 50
RARE, RARE_SHARE = 16, 0.005
PARTNERS, SALTS = 256, 64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LINES = "split(text, '\\n')"


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal lines a[i] = b[j] that patience diff aligns, increasing in both."""
    found, open_ = [], [(0, len(a), 0, len(b))]
    while open_:
        alo, ahi, blo, bhi = open_.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            found.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            found.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        times_a, times_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        where = {a[i]: i for i in range(alo, ahi) if times_a[a[i]] == 1}
        common_lines = [
            (where[b[j]], j) for j in range(blo, bhi) if times_b[b[j]] == 1 and b[j] in where
        ]
        last_a, last_b = alo, blo
        for i, j in _increasing(common_lines):
            open_.append((last_a, i, last_b, j))
            found.append((i, j))
            last_a, last_b = i + 1, j + 1
        if last_b > blo:
            open_.append((last_a, ahi, last_b, bhi))
    return sorted(found)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of the pairs, given in order of j, in which i increases too."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int | None] = []
    for k, (i, _) in enumerate(pairs):
        at = bisect_left(tails, i)
        before.append(ends[at - 1] if at else None)
        if at == len(tails):
            tails.append(i)
            ends.append(k)
        else:
            tails[at], ends[at] = i, k
    out = []
    k = ends[-1] if ends else None
    while k is not None:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def blocks(a: list[int], b: list[int], sizes: list[int], least: int = BLOCK) -> list[tuple[int, int]]:
    """First and last line in b of each common block of at least so many characters; they may overlap."""
    out: list[list[int]] = []
    last = None
    order = aligned(a, b)
    for i, j in order:
        if last == (i - 1, j - 1):
            out[-1][1] = j
        else:
            out.append([j, j])
        last = (i, j)
    found = [(lo, hi) for lo, hi in out if sum(sizes[lo : hi + 1]) >= least]
    return found + _not_aligned(a, b, sizes, least, order, found)


def _not_aligned(
    a: list[int], b: list[int], sizes: list[int], least: int, order: list[tuple[int, int]], found: list[tuple[int, int]]
) -> list[tuple[int, int]]:
    """Blocks that the alignment leaves, as they are repeated or have moved."""
    gone = {j for lo, hi in found for j in range(lo, hi + 1)}
    known = set(a)
    left = [j for j, x in enumerate(b) if sizes[j] and j not in gone and x in known]
    if not left:
        return []
    more = []
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    after = [j for _, j in order]
    for j in left:
        if sizes[j] >= least:
            k = bisect_left(after, j)
            lo = order[k - 1][0] if k else -1
            hi = order[k][0] if k < len(order) else len(a)
            at = bisect_right(places := where[b[j]], lo)
            if sizes[j] >= LONG or at < len(places) and places[at] < hi:
                more.append((j, j))
    following = set(zip(a, a[1:]))
    if any((b[j - 1], b[j]) in following for j in left if j) or any(
        (b[j], b[j + 1]) in following for j in left if j + 1 < len(b)
    ):
        for lo, hi in common_runs(a, b):
            own = sizes[lo : hi + 1]
            if sum(own) >= least and (sum(x > 0 for x in own) > 1 or max(own) >= LONG):
                more.append((lo, hi))
    return more


def common_runs(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """First and last line in b of each longest run that is somewhere in a; by the suffix automaton of a, in linear time."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for x in a:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and x not in step[p]:
            step[p][x] = now
            p = link[p]
        if p != -1:
            q = step[p][x]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(x) == q:
                    step[p][x] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    out = []
    state = n = 0
    for j, x in enumerate(b):
        before = n
        while state and x not in step[state]:
            state = link[state]
            n = length[state]
        if x in step[state]:
            state, n = step[state][x], n + 1
        else:
            n = 0
        if before and n != before + 1:
            out.append((j - before, j - 1))
    if n:
        out.append((len(b) - n, len(b) - 1))
    return out


def hashed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, lines (hashes), sizes (characters): one row for each key."""
    trimmed = f"transform({_LINES}, x -> trim(BOTH ' \\t\\r' FROM x))"
    return (
        common.keyed(docs, "text")
        .filter("text IS NOT NULL AND text <> ''")
        .selectExpr("doc_id", "text_key", f"{trimmed} AS trimmed")
        .selectExpr(
            "doc_id",
            "text_key",
            "transform(trimmed, x -> xxhash64(x)) AS lines",
            "transform(trimmed, x -> length(x)) AS sizes",
        )
        .dropDuplicates(["doc_id", "text_key"])
    )


def windows(lines: np.ndarray, sizes: np.ndarray, ends: np.ndarray):
    """Document number, hash, whether it counts when common, of each anchor, once a document.

    The documents lie one behind the other; ``ends`` says where each ends.
    """
    n = len(lines)
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    filled = np.flatnonzero(sizes > 0)
    total = np.concatenate(([0], np.cumsum(sizes)))
    # From each line on, and up to each line, as few lines as reach BLOCK; two at least.
    first, last = filled[:-1], filled[1:]
    to = np.maximum(np.searchsorted(total, total[first] + BLOCK) - 1, last)
    since = np.minimum(np.searchsorted(total, total[last + 1] - BLOCK, side="right") - 1, first)
    lo, hi = np.concatenate((first, since)), np.concatenate((to, last))
    there = (lo >= 0) & (hi < n)
    lo, hi = lo[there], hi[there]
    there = owner[lo] == owner[hi]
    lo, hi = lo[there], hi[there]
    power, back = np.full((2, n + 1), 1, dtype=np.uint64)
    power[1:], back[1:] = _BASE, _INVERSE
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(lines * power[:n])))
    code = (sums[hi + 1] - sums[lo]) * back[lo]
    code ^= code >> np.uint64(29)
    # Two lines that are no such window, or with blank lines between that may differ.
    two = owner[first] == owner[last]
    two &= (sizes[first] + sizes[last] >= PAIR) & ((sizes[first] + sizes[last] < BLOCK) | (last > first + 1))
    code = np.concatenate((code, lines[first[two]] * _BASE ^ lines[last[two]]))
    lo = np.concatenate((lo, first[two]))
    alone = np.flatnonzero(sizes >= LINE)
    # A document of one line and blank ones counts as a whole, by another hash.
    whole = alone[(np.bincount(owner[filled], minlength=len(ends))[owner[alone]] == 1) & (sizes[alone] >= BLOCK)]
    who = np.concatenate((owner[lo], owner[alone], owner[whole]))
    code = np.concatenate((code, lines[alone], ~lines[whole]))
    always = np.ones(len(who), dtype=bool)
    always[len(lo) : len(lo) + len(alone)] = sizes[alone] >= LONG
    order = np.lexsort((code, who))
    who, code, always = who[order], code[order], always[order]
    new = np.ones(len(who), dtype=bool)
    new[1:] = (who[1:] != who[:-1]) | (code[1:] != code[:-1])
    return who[new], code[new], always[new]


def anchors(lines: DataFrame) -> DataFrame:
    """place (orders documents), always (whether it counts when common), anchor; each once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column("lines")).to_numpy(zero_copy_only=False))
            who, code, always = windows(
                batch.column("lines").flatten().to_numpy(zero_copy_only=False).view(np.uint64),
                batch.column("sizes").flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                ends.astype(np.int64),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(who)), batch.column("text_key").take(pa.array(who)),
                 pa.array(always), pa.array(code.view(np.int64))],
                names=["doc_id", "text_key", "always", "anchor"],
            )

    return (
        lines.select("doc_id", "text_key", "lines", "sizes")
        .mapInArrow(run, "doc_id long, text_key long, always boolean, anchor long")
        .selectExpr("struct(doc_id IS NULL AS none, doc_id, text_key) AS place", "always", "anchor")
    )


def pairs(lines: DataFrame) -> DataFrame:
    """first, place: documents that share an anchor, each with the first one that has it."""
    n = lines.count()
    rare = max(RARE, int(RARE_SHARE * n))
    held = anchors(lines)
    # Stored, so that the join has a plain shuffle on both sides and a hot anchor can be split.
    firsts = common.stored(
        held.groupBy("anchor")
        .agg(F.min("place").alias("first"), F.count("*").alias("n"), F.bool_or("always").alias("always"))
        .filter((F.col("n") > 1) & (F.col("always") | (F.col("n") <= rare)))
        .select("anchor", "first"),
        "firsts",
    )
    return held.join(firsts, "anchor").filter("place <> first").select("first", "place").distinct()


def meetings(lines: DataFrame) -> DataFrame:
    """Lines of first holders and of the documents paired with them, each first holder's before those of its block.

    first, block, place (null for the first holder itself), lines, sizes (null for the first holder).
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    sides = lines.select(place.alias("place"), "lines", "sizes")
    # Stored, as three steps read the pairs; a row is two keys.
    found = common.stored(pairs(lines), "pairs")
    blocks_of = found.groupBy("first").agg(F.expr(f"CAST(ceil(count(*) / {PARTNERS}) AS BIGINT)").alias("n_blocks"))
    # First holders of several blocks are few; their pairs meet the number of blocks in SALTS parts.
    several = blocks_of.filter("n_blocks > 1").withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    partners = (
        found.withColumn("salt", F.expr(f"pmod(xxhash64(place), {SALTS}L)"))
        .join(several, ["first", "salt"], "left")
        .withColumn("block", F.expr("pmod(xxhash64(place), coalesce(n_blocks, 1L))"))
        .join(sides, "place")
        .select("first", "block", "place", "lines", "sizes")
    )
    firsts = (
        blocks_of.withColumn("block", F.explode(F.expr("sequence(0L, n_blocks - 1)")))
        .join(sides.withColumnRenamed("place", "first"), "first")
        .selectExpr("first", "block", "CAST(NULL AS STRUCT<none: BOOLEAN, doc_id: BIGINT, text_key: BIGINT>) AS place",
                    "lines", "CAST(NULL AS ARRAY<INT>) AS sizes")
    )
    met = firsts.unionByName(partners).repartition("first", "block")
    return met.sortWithinPartitions("first", "block", F.col("place").asc_nulls_first())


def deletions(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, runs (array of first and last line) of the documents that lose lines."""
    lines = common.stored(hashed_lines(docs), "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[int] = []
        for batch in batches:
            place, rows, sizes = (batch.column(c) for c in ("place", "lines", "sizes"))
            ids, keys, runs = [], [], []
            for i, is_first in enumerate(place.is_null().to_pylist()):
                if is_first:
                    before = rows[i].as_py()
                    continue
                own = blocks(before, rows[i].as_py(), sizes[i].as_py())
                if own:
                    ids.append(place[i]["doc_id"].as_py())
                    keys.append(place[i]["text_key"].as_py())
                    runs.append([{"lo": lo, "hi": hi} for lo, hi in own])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(runs, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
                ],
                names=["doc_id", "text_key", "runs"],
            )

    cut = meetings(lines).mapInArrow(run, "doc_id long, text_key long, runs array<struct<lo:int,hi:int>>")
    return cut.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def without_blocks(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), kept (the text that is left), n_lines, n_deleted, of every row."""
    cut = common.stored(deletions(docs), "deletions")
    rows = common.whole_rows(docs)
    # What is cut grows with the texts, so the texts meet it by a shuffle at every size.
    joined = rows.join(cut.hint("merge"), common.same_key(rows, cut), "left").select("row", "runs")
    return joined.selectExpr("row", "runs", "row.text AS text").selectExpr(
        "row",
        "text",
        f"CASE WHEN text = '' THEN array() ELSE {_LINES} END AS lines",
        "flatten(transform(runs, x -> sequence(x.lo, x.hi))) AS gone",
    ).selectExpr(
        "row",
        """CASE WHEN gone IS NULL THEN text ELSE array_join(transform(
             array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\\n') END AS kept""",
        "CAST(coalesce(size(lines), 0) AS BIGINT) AS n_lines",
        "CAST(coalesce(size(array_distinct(gone)), 0) AS BIGINT) AS n_deleted",
    )


def drop_blocks(docs: DataFrame) -> DataFrame:
    """The rows of docs with shorter texts; a document whose every line is elsewhere goes."""
    left = without_blocks(docs).filter("n_deleted = 0 OR kept RLIKE '\\\\S'")
    columns = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == "text":
            old = F.col("kept")
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            old = F.when(F.col("n_deleted") > 0, F.length("kept").cast(kind)).otherwise(old)
        columns.append(old.alias(c))
    return left.select(*columns)


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return without_blocks(docs).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "n_lines",
        "n_deleted",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )
