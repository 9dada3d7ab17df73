"""Benchmark decontamination by template canonicalisation.

**Templates.** White space and the marks around a word fall away, letters become lower case, and
typed placeholders replace what a re-parameterised question changes: numbers (digits and
number words), names (given names of a short list, and capitalised words inside a sentence) and
units (of a short list, after a number). What a placeholder replaces is its slot value.

**Windows.** Every ``WINDOW`` consecutive template words of an item make a window; windows with
more placeholders than words are no templates. A window with placeholders is also taken **verbatim**, by its
bare words in lower case: so copies are found however many numbers and names they hold, and wherever a
capitalised word is a name on one side only. A shorter item is one window, from ``LEAST`` words on; still
shorter items cannot be told from common phrases and match nothing.

**Join.** A bitmap of ``2 ** BITS`` bits marks the hashes of the benchmark's windows (8 MB at any size
of the benchmark, the only thing broadcast). Windows of documents that the bitmap rules out end in the
task that made them; the others meet the benchmark in a hash join, which is exact.

**Stems.** A window that more than ``STEM`` items share (the same instructions before every question) would pair each
document that has it with all of them. So a document first meets items by their other windows only. Where one
of these brings an item, its common windows are looked for at the places of the document that lie on the same
diagonal. What common windows alone may cover is decided once for all items that share a whole stretch of them:
such a stretch, with its slot values numbered by first appearance, is one row of a table of stems.

**Slots.** Matches of a document and an item that lie on one diagonal (same distance between the two
positions) make a run; gaps of up to a window are allowed. In a run, each slot value of the item must
stand for one value of the document, and different values for different ones. A run that
covers ``COVER`` template words, or the whole of a shorter item, makes the document contaminated.

Defined results: null and empty texts match nothing; repeated rows each get the result of their text; an
empty benchmark or table of documents matches nothing; items with the same text all match. Memory is bounded
by a chunk of texts (``common.CHUNK_CHARS``) and the longest text. Other columns are not looked at.
"""

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

WINDOW, LEAST, COVER, BITS = 8, 5, 13, 26
#: Items that may share a window before it counts as one of a stem.
STEM = 16
#: Different words whose templates a worker keeps; beyond that it starts anew.
MEMO = 150_000

NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion half twice dozen".split()
)
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres "
    "mg g kg t oz lb lbs gram grams kilogram kilograms pound pounds ton tons ounce ounces "
    "ml l liter liters litre litres gallon gallons cup cups "
    "ms s sec min h hr second seconds minute minutes hour hours day days week weeks month months year years "
    "mph kph percent degree degrees dollar dollars cent cents euro euros usd eur gbp $ € £ %".split()
)
NAMES = frozenset(
    "alice bob carol dave eve anna ben clara david emma frank grace henry isabel jack james jane jim "
    "joe john jose julia kate lisa lucy maria mark mary max mike nina oliver paul peter robert sam sara "
    "sarah sophie tim tom".split()
)
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?")
_MEASURE = re.compile(r"\W*(\d[\d.,]*)(mm|cm|km|mg|kg|lbs?|ml|mph|%|€|£)\W*")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_MARKS = "\"'()[]{}<>.,;:!?-_*#%$&|~/\\«»“”„"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_PLAIN, _NUM, _NAME, _UNIT = range(4)
#: Flags beside the kind: a name unless it starts a sentence; a unit if a number precedes;
#: nothing but marks; a sentence may end with it; a number and a unit in one.
_CAPITAL, _MEASURED, _BLANK, _ENDS, _TWO = 4, 8, 16, 32, 64


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 42)


_KIND = np.array([0, *(_digest(f"<{k}>") for k in ("number", "name", "unit"))], dtype=np.uint64)


class _Words(dict):
    """word -> place in the lists of values (hash of the bare word in lower case) and flags; fills itself."""

    def __init__(self):
        self.value: list[int] = []
        self.flags: list[int] = []
        self.parts: dict[int, tuple[int, int]] = {}  # of a number and a unit in one

    def __missing__(self, word: str) -> int:
        bare = word.strip(_MARKS)
        if not bare.isalpha():
            bare = "" if not bare else word if word in UNITS else _EDGES.sub("", word)
        low = bare.lower()
        if not bare:
            flags = _BLANK
        elif low in NUMBER_WORDS or not bare.isalpha() and _NUMBER.fullmatch(bare):
            flags = _NUM
        elif low == bare:
            flags = _PLAIN
        else:
            flags = _NAME if low in NAMES else _CAPITAL * (bare[0].isupper() and bare[1:].islower())
        if low in UNITS or word in UNITS:
            flags = flags & ~_BLANK | _MEASURED
        if word[-1] in ".!?:\"')]»”" and word.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":"):
            flags |= _ENDS
        parts = None
        if word[-1] not in "0123456789" and not bare.isalpha() and (both := _MEASURE.fullmatch(word)):
            parts = self[both[1]], self[both[2]]
            flags |= _TWO
        at = len(self.value)
        if parts:
            self.parts[at] = parts
        self.value.append(_digest(low or word))
        self.flags.append(flags)
        self[word] = at
        return at


def templates(texts: list[str | None], words: _Words):
    """Of all texts in a row: text number, template hash, kind, slot value of each template word."""
    if len(words) > MEMO:
        words.clear()
        words.__init__()
    cut = [t.replace("\n", " . ").split() if t else [] for t in texts]
    sizes = np.array([len(own) for own in cut], dtype=np.int64)
    rows = np.fromiter(
        map(words.__getitem__, chain.from_iterable(cut)), dtype=np.int32, count=int(sizes.sum())
    )
    owner = np.repeat(np.arange(len(cut), dtype=np.int32), sizes)
    flags = np.array(words.flags, dtype=np.uint8)[rows]
    two = np.flatnonzero(flags & _TWO)
    if len(two):
        parts = np.array([words.parts[r] for r in rows[two].tolist()], dtype=np.int32)
        times = np.ones(len(rows), dtype=np.int64)
        times[two] = 2
        ends = flags[two] & _ENDS
        rows, owner = np.repeat(rows, times), np.repeat(owner, times)
        at = two + np.arange(len(two))
        rows[at], rows[at + 1] = parts[:, 0], parts[:, 1]
        flags = np.array(words.flags, dtype=np.uint8)[rows]
        flags[at + 1] |= ends
    starts = np.ones(len(rows), dtype=bool)
    starts[1:] = (flags[:-1] & _ENDS > 0) | (owner[1:] != owner[:-1])
    whole = np.flatnonzero(flags & _BLANK == 0)
    # A blank word between passes on that a sentence starts.
    seen = np.cumsum(starts)[whole]
    starts = np.ones(len(whole), dtype=bool)
    starts[1:] = seen[1:] > seen[:-1]
    rows, owner, flags = rows[whole], owner[whole], flags[whole]
    value = np.array(words.value, dtype=np.uint64)[rows]
    kind = flags & 3
    kind[(flags & _CAPITAL > 0) & ~starts] = _NAME
    after = np.zeros(len(kind), dtype=bool)
    after[1:] = (kind[:-1] == _NUM) & (owner[1:] == owner[:-1])
    kind[(flags & _MEASURED > 0) & after] = _UNIT
    return owner, np.where(kind == _PLAIN, value, _KIND[kind]), kind, value


def windows(owner: np.ndarray, code: np.ndarray, kind: np.ndarray, value: np.ndarray, length: int):
    """First words and hashes of the windows of a length that lie in one text.

    Templates that hold enough words, then the windows with placeholders verbatim.
    """
    n = len(code) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    slots = np.concatenate(([0], np.cumsum(kind != _PLAIN)))
    slots = slots[length:] - slots[:n]
    whole = owner[:n] == owner[length - 1 :]
    template, verbatim = np.flatnonzero(whole & (2 * slots <= length)), np.flatnonzero(whole & (slots > 0))
    return (
        np.concatenate((template, verbatim)),
        np.concatenate((_hashes(code, length)[template], _hashes(value, length)[verbatim])),
    )


def _hashes(words: np.ndarray, length: int) -> np.ndarray:
    n = len(words) - length + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        total = total * _BASE + words[k : k + n]
    total = (total ^ (total >> np.uint64(31))) * _MIX
    total ^= total >> np.uint64(29)
    return total + np.uint64(length)


_FOUND = pa.struct([("at", pa.int32()), ("code", pa.int64()), ("slots", pa.list_(pa.int64()))])


def _slots(kind: np.ndarray, value: np.ndarray, at: int, length: int) -> list[int]:
    """Slot values of an item's window by place; 0 where a word stands."""
    part = np.where(kind[at : at + length] == _PLAIN, np.uint64(0), value[at : at + length] | np.uint64(1))
    return part.view(np.int64).tolist()


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, words (of the template), length, at, code, slots: every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in common.chunks(batches):
            ids = batch.column("item_id").to_pylist()
            owner, code, kind, value = templates(batch.column("text").to_pylist(), words)
            first = np.searchsorted(owner, np.arange(len(ids) + 1))
            out = []
            for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                if hi - lo < LEAST:
                    continue
                length = min(WINDOW, hi - lo)
                own = slice(lo, hi)
                for at, h in zip(*windows(owner[own], code[own], kind[own], value[own], length)):
                    out.append(
                        {
                            "item_id": ids[i],
                            "words": hi - lo,
                            "length": length,
                            "at": int(at),
                            "code": int(h.view(np.int64)),
                            "slots": _slots(kind[own], value[own], at, length),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            ("item_id", pa.int64()),
            ("words", pa.int32()),
            ("length", pa.int32()),
            ("at", pa.int32()),
            ("code", pa.int64()),
            ("slots", pa.list_(pa.int64())),
        ]
    )
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, words int, length int, at int, code long, slots array<long>"
    )


def suspects(docs: DataFrame, marks: np.ndarray, lengths: list[int]) -> DataFrame:
    """doc_id, text_key, at, code, slots (values): windows of documents that the bitmap does not rule out."""
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in common.chunks(batches):
            owner, code, kind, value = templates(batch.column("text").to_pylist(), words)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            rows, found = [], []
            for length in lengths:
                at, hashes = windows(owner, code, kind, value, length)
                hit = common.marked(sent.value, hashes, BITS)
                for i, h in zip(at[hit].tolist(), hashes[hit].view(np.int64).tolist()):
                    rows.append(own := int(owner[i]))
                    # All values, as a placeholder of the item may be a word here.
                    values = (value[i : i + length] | np.uint64(1)).view(np.int64).tolist()
                    found.append({"at": i - int(first[own]), "code": h, "slots": values})
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_key").take(rows),
                 *pa.array(found, _FOUND).flatten()],
                names=["doc_id", "text_key", "at", "code", "slots"],
            )

    return common.keyed(docs, "text").mapInArrow(
        run, "doc_id long, text_key long, at int, code long, slots array<long>"
    )


def covered(matches: list[tuple[int, int, list[int], list[int]]], words: int) -> int:
    """Most template words that a run of matches (item place, document place, slots of both) covers."""
    best = 0
    runs: dict[int, list] = {}
    for at, place, ours, theirs in sorted(matches, key=lambda m: m[:2]):
        line = place - at
        run = runs.get(line)
        new = [(x, y) for x, y in zip(ours, theirs) if x]
        if run is not None and at <= run[1] + WINDOW and _agrees(run[2], run[3], new):
            run[4] += at + len(ours) - max(at, run[1])
            run[1] = at + len(ours)
        elif _agrees(there := {}, back := {}, new):
            run = runs[line] = [at, at + len(ours), there, back, len(ours)]
        else:
            continue
        best = max(best, run[4])
    return min(best, words)


def _agrees(there: dict, back: dict, new: list[tuple[int, int]]) -> bool:
    """Adds pairs of slot values to a one-to-one mapping; false, and nothing added, if they contradict."""
    more_there, more_back = {}, {}
    for x, y in new:
        if there.get(x, more_there.get(x, y)) != y or back.get(y, more_back.get(y, x)) != x:
            return False
        more_there[x], more_back[y] = y, x
    there.update(more_there)
    back.update(more_back)
    return True


_KEY = ("doc_id", "text_key")


def _scored(pairs: DataFrame, owner: str, kind: str) -> DataFrame:
    """doc_id, text_key, the owner of the windows, words, shared: template words that a run of matches covers."""
    grouped = pairs.groupBy(*_KEY, owner, "words").agg(
        F.collect_set(F.struct("item_at", "at", "item_slots", "slots")).alias("matches")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [
                covered([tuple(m.values()) for m in own], words)
                for own, words in zip(batch.column("matches").to_pylist(), batch.column("words").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in (*_KEY, owner, "words")] + [pa.array(shared, pa.int32())],
                names=[*_KEY, owner, "words", "shared"],
            )

    return grouped.mapInArrow(run, f"doc_id long, text_key long, {owner} {kind}, words int, shared int").filter(
        F.col("shared") >= F.least(F.lit(COVER), "words")
    )


def _same_row(left: str, right: str) -> str:
    return f"{left}.doc_id <=> {right}.doc_id AND {left}.text_key = {right}.text_key"


def _by_items(found: DataFrame, items: DataFrame, common_codes: DataFrame) -> DataFrame:
    """Matches with items that a window of few items brings, with their windows of stems on the same diagonals."""
    own = items.select("item_id", "words", F.col("at").alias("item_at"), "code", F.col("slots").alias("item_slots"))
    few, many = own.join(common_codes, "code", "left_anti"), own.join(common_codes, "code", "left_semi")
    columns = [*_KEY, "item_id", "words", "item_at", "at", "item_slots", "slots"]
    rare = found.join(few, "code").select(*columns)
    lines = rare.selectExpr(*_KEY, "item_id", "at - item_at AS line").distinct()
    wanted = lines.join(many, "item_id").selectExpr("*", "line + item_at AS place")
    same = F.expr(f"{_same_row('w', 'f')} AND w.place = f.at AND w.code = f.code")
    more = wanted.alias("w").join(found.alias("f"), same).selectExpr(
        "w.doc_id", "w.text_key", "w.item_id", "w.words", "w.item_at", "f.at", "w.item_slots", "f.slots"
    )
    return _scored(rare.unionByName(more), "item_id", "long").select(*_KEY, "item_id", "shared", "words")


def stems(items: DataFrame, common_codes: DataFrame) -> DataFrame:
    """item_id, words, stem, windows: stretches of windows that many items share; equal ones have the same stem.

    Windows are placed from the stretch's first one, and slot values numbered by first appearance. A stretch ends
    where no run of matches can go on.
    """
    own = (
        items.join(common_codes, "code", "left_semi")
        .groupBy("item_id", "words")
        .agg(F.sort_array(F.collect_set(F.struct("at", "code", "slots"))).alias("windows"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for part in _stretches(row["windows"]):
                    named: dict[int, int] = {0: 0}
                    part = [
                        {"at": w["at"] - part[0]["at"], "code": w["code"],
                         "slots": [named.setdefault(x, len(named)) for x in w["slots"]]}
                        for w in part
                    ]
                    # Shorter items must be covered whole, so they are stems of their own.
                    stem = xxhash.xxh128_hexdigest(repr((min(row["words"], COVER), part)).encode())
                    out.append({"item_id": row["item_id"], "words": row["words"], "stem": stem, "windows": part})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    window = pa.struct([("at", pa.int32()), ("code", pa.int64()), ("slots", pa.list_(pa.int64()))])
    schema = pa.schema(
        [("item_id", pa.int64()), ("words", pa.int32()), ("stem", pa.string()), ("windows", pa.list_(window))]
    )
    return own.mapInArrow(
        run, "item_id long, words int, stem string, windows array<struct<at:int,code:long,slots:array<long>>>"
    )


def _stretches(windows: list[dict]) -> Iterator[list[dict]]:
    """Windows in order, cut where one begins more than a window behind the furthest end so far."""
    part, end = [], 0
    for w in windows:
        if part and w["at"] > end + WINDOW:
            yield part
            part = []
        part.append(w)
        end = max(end, w["at"] + len(w["slots"])) if len(part) > 1 else w["at"] + len(w["slots"])
    if part:
        yield part


def _by_stems(found: DataFrame, items: DataFrame, common_codes: DataFrame) -> DataFrame:
    """Matches by windows of stems alone: documents meet each different stem once, whatever number of items has it."""
    known = common.stored(stems(items, common_codes), "stems")
    different = known.groupBy("stem").agg(F.first("windows").alias("windows"), F.max("words").alias("words"))
    parts = different.select("stem", "words", F.inline("windows").alias("item_at", "code", "item_slots"))
    hits = found.join(parts, "code").select(*_KEY, "stem", "words", "item_at", "at", "item_slots", "slots")
    # All items of a stem need the same cover, so what reaches the longest one's reaches any.
    reached = _scored(hits, "stem", "string").select(*_KEY, "stem", "shared")
    return reached.join(known.select("stem", "item_id", "words"), "stem").select(
        *_KEY, "item_id", F.least("shared", "words").alias("shared"), "words"
    )


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, shared, words: template words that documents share with items, if enough."""
    items = common.stored(item_windows(benchmark), "items")
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())
    found = suspects(docs, common.bitmap(items, BITS), lengths)
    holders = items.groupBy("code").agg(F.count_distinct("item_id").alias("n"))
    common_codes = common.stored(holders.filter(F.col("n") > STEM).select("code"), "stem-codes")
    if common_codes.isEmpty():
        own = items.select("item_id", "words", F.col("at").alias("item_at"), "code", F.col("slots").alias("item_slots"))
        return _scored(found.join(own, "code"), "item_id", "long").select(*_KEY, "item_id", "shared", "words")
    found = common.stored(found, "suspects")
    return (
        _by_items(found, items, common_codes)
        .unionByName(_by_stems(found, items, common_codes))
        .groupBy(*_KEY, "item_id", "words")
        .agg(F.max("shared").alias("shared"))
        .select(*_KEY, "item_id", "shared", "words")
    )


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, items (sorted ids of the items that the document contains)."""
    return (
        matches(docs, benchmark)
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that contain no item."""
    found = common.stored(verdicts(docs, benchmark).select("doc_id", "text_key"), "contaminated")
    rows = common.whole_rows(docs)
    return rows.join(found, common.same_key(rows, found), "left_anti").select("row.*")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (common.table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = common.stored(verdicts(docs, benchmark), "contaminated")
    keys = common.keyed(docs)
    none = F.array().cast("array<bigint>")
    return keys.join(found, common.same_key(keys, found), "left").select(
        keys["doc_id"],
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", none).alias("item_ids"),
    )
