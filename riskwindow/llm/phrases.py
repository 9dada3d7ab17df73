"""Collocations by mergeable Misra-Gries summaries, counted exactly in a second pass.

**Words.** A-Z become lower case; texts are cut into pieces at ``.,;:!?`` and line ends, pieces
into words at spaces and tabs. A phrase is two to four words that follow each other in a piece.
Everything is counted for each language apart; a missing language is ``und``.

**First pass.** Every n-gram is known by a 64-bit hash. A task sums equal ones of what it has read and sends
each part of the hash space one block of hashes and counts. A part merges its blocks into a Misra-Gries
summary: where more keys than its capacity remain, the count next beyond the capacity is taken off all
keys, and those without a rest go. The part's mass (all its occurrences) divided by more than the capacity
bounds what any key can lose, and the capacity is the mass divided by the threshold, so that this is
less than the threshold: **every n-gram that occurs ``threshold`` times survives**. The survivors are
then summed over the part's blocks, which leaves those whose hashes do occur that often. One and two words
come first; three and four words only where all their pairs of words were left, as a phrase
cannot occur more often than its pairs.

**Second pass.** The texts are read again and every n-gram whose hash was left is counted by its words,
exactly: a task numbers the different words and phrases of a part of the text, no hash decides, and sends each part of
the hash space one table of its counts. The hashes reach the tasks as a bitmap of at most 2 ** ``BITS`` bits; what it does
not rule out is counted too and falls below the threshold in the end.

**Scores.** Each cut of a phrase gives floor(2000000 a / (l + r)) in decimals of 38 digits; the lowest one
counts. Candidates inside a longer one with at least 80 % of their occurrences go; the first ones of each
language stay, taken in rounds over shares of bounded size.

Defined results: null, empty and blank texts have no words and change nothing; repeated rows are
counted as often as they stand there; equal scores are ordered by count, then by bytes of the phrase;
an empty table gives no rows. Other columns than text and language are not looked at. A very long text is taken in parts
that end where a piece ends.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common
from riskwindow.llm import words as W

THRESHOLD, LONGEST, FIRST, SHARE = 30, 4, 2000, 80
KINDS = W.kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Bytes of text for each part of the hash space; n-grams that a task sums before it sends them.
PART, FLUSH = 16 << 20, 4_000_000
#: Rows of counts that a task holds before it sends them.
HELD = 600_000
#: The largest bitmap has 2 ** BITS bits (128 MB).
BITS = 30
#: Rows that a window orders at once when the first ones of a language are sought.
ORDERED = 200_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)


def _mixed(before: np.ndarray, more: np.ndarray) -> np.ndarray:
    x = before * _FACTOR + more
    return (x ^ (x >> _HALF)) * _FACTOR


def _hashes(values: list, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(v, seed) for v in values], dtype=np.uint64)


class _Part:
    """A part of a chunk of texts: numbered words, and hashes of the n-grams that begin at each word."""

    def __init__(self, found: W.Words, lang: np.ndarray, names: list[str]):
        self.ids, self.different = W.numbered(found.word)
        self.piece, self.word = found.piece, found.word
        self.lang = lang[found.text]
        self._word_hash = _hashes(self.different.to_pylist(), 0)[self.ids]
        first = _mixed(_hashes([n.encode() for n in names], 1)[self.lang], self._word_hash)
        self._grams = [first]

    def hashes(self, n: int) -> np.ndarray:
        """Of n-grams that begin at the words 0, 1, ... whether or not a piece ends inside."""
        while len(self._grams) < n:
            m = len(self._grams)
            self._grams.append(_mixed(self._grams[-1][:-1], self._word_hash[m:]))
        return self._grams[n - 1]

    def whole(self, n: int) -> np.ndarray:
        """Which n-grams lie in one piece."""
        if n > len(self.piece):
            return np.zeros(0, dtype=bool)
        return self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Part, list[str]]]:
    for batch in batches:
        for chunk in common.chunks([batch]):
            lang = pc.fill_null(chunk.column("lang").cast(pa.string()), "und").dictionary_encode()
            names = lang.dictionary.to_pylist()
            numbers = lang.indices.to_numpy(zero_copy_only=False)
            for found in W.words(chunk.column("text"), KINDS):
                yield _Part(found, numbers, names), names


# First pass ---------------------------------------------------------------


def blocks(docs: DataFrame, sizes: tuple[int, ...], parts: int, pairs: np.ndarray | None = None, bits: int = 0) -> DataFrame:
    """part, hashes, counts: n-grams of these sizes, summed over what a task has read.

    With a bitmap of pairs of words, only n-grams whose pairs are all marked are sent.
    """

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(_place(found, parts), np.arange(parts + 1))
        rows = [(p, found[a:b], counts[a:b]) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _, _ in rows], pa.int32()),
                pa.array([h.tobytes() for _, h, _ in rows], pa.binary()),
                pa.array([c.astype(np.uint32).tobytes() for _, _, c in rows], pa.binary()),
            ],
            names=["part", "hashes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part, _ in _parts(batches):
            marked = common.marked(pairs, part.hashes(2), bits) if pairs is not None and len(part.ids) > 1 else None
            for size in sizes:
                keep = part.whole(size)
                if marked is not None:
                    keep = keep.copy()
                    for at in range(size - 1):
                        keep &= marked[at : at + len(keep)]
                if keep.any():
                    held.append(part.hashes(size)[keep])
                    n += len(held[-1])
            if n >= FLUSH:
                yield sent(held)
                held, n = [], 0
        if held:
            yield sent(held)

    return docs.mapInArrow(run, "part int, hashes binary, counts binary")


def merged(summary: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, counts: np.ndarray, capacity: int):
    """A Misra-Gries summary and more counts as one summary of at most ``capacity`` keys."""
    keys, at = np.unique(np.concatenate([summary[0], hashes]), return_inverse=True)
    sums = np.zeros(len(keys), dtype=np.int64)
    np.add.at(sums, at, np.concatenate([summary[1], counts.astype(np.int64)]))
    if len(keys) > capacity:
        place = len(keys) - capacity - 1
        sums -= np.partition(sums, place)[place]
        stay = sums > 0
        keys, sums = keys[stay], sums[stay]
    return keys, sums


def survivors(parts: list[tuple[np.ndarray, np.ndarray]], threshold: int) -> np.ndarray:
    """Keys that may occur ``threshold`` times in blocks of (keys, counts), by a summary of bounded size."""
    capacity = sum(int(c.sum(dtype=np.int64)) for _, c in parts) // threshold
    summary = (np.empty(0, np.uint64), np.empty(0, np.int64))
    if not capacity:
        return summary[0]
    waiting, n = [], 0
    for i, block in enumerate(parts):
        waiting.append(block)
        n += len(block[0])
        if n >= max(capacity, 100_000) or i + 1 == len(parts):  # small blocks are merged together
            hashes, counts = (np.concatenate(x) for x in zip(*waiting))
            summary = merged(summary, hashes, counts, capacity)
            waiting, n = [], 0
    return summary[0]


def frequent_hashes(sent: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """code: hashes that occur ``threshold`` times or more, from the blocks of all tasks."""

    def run(table: pa.Table) -> pa.Table:
        held = [
            (np.frombuffer(h.as_py(), np.uint64), np.frombuffer(c.as_py(), np.uint32))
            for h, c in zip(table.column("hashes"), table.column("counts"))
        ]
        keys = survivors(held, threshold)
        sums = np.zeros(len(keys), dtype=np.int64)
        for hashes, counts in held if len(keys) else ():
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            same = keys[at] == hashes
            sums[at[same]] += counts[same]  # a block holds each key once
        return pa.table({"code": pa.array(keys[sums >= threshold].view(np.int64))})

    return sent.groupBy("part").applyInArrow(run, "code long")


# Second pass --------------------------------------------------------------


def counted(docs: DataFrame, marks: np.ndarray, bits: int, parts: int, longest: int = LONGEST) -> DataFrame:
    """part, counts: counts by words of the n-grams that the bitmap marks, a table of each part of the hash space.

    A task sums what it has read before it sends it. A row with no words has the number of all words of its language.
    """

    def sent(found: pa.Table) -> Iterator[pa.RecordBatch]:
        number = found.column("part").to_numpy()
        order = np.argsort(number, kind="stable")
        cuts = np.searchsorted(number[order], np.arange(parts + 1))
        found = found.drop_columns(["part"])
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                block = _written(found.take(pa.array(order[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([block], pa.binary())], names=["part", "counts"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part, names in _parts(batches):
            held.append(_exact(part, names, marks, bits, parts, longest))
            n += held[-1].num_rows
            if n >= HELD:
                held = [_summed(held)]
                n = held[0].num_rows
                if 2 * n >= HELD:
                    yield from sent(held[0])
                    held, n = [], 0
        if held:
            yield from sent(_summed(held))

    return docs.mapInArrow(run, "part int, counts binary")


def totals(sent: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """lang, words, phrase, f from the tables of all tasks, of those that reach the threshold."""

    def run(table: pa.Table) -> pa.Table:
        found = pa.concat_tables([pa.ipc.open_stream(b.as_py()).read_all() for b in table.column("counts")])
        found = _summed([found])
        often = pc.or_(pc.greater_equal(found["f"], threshold), pc.equal(found["words"], 0))
        return found.filter(often).drop_columns(["part"])

    return sent.groupBy("part").applyInArrow(run, "lang string, words int, phrase string, f long")


def _written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _summed(tables: list[pa.Table]) -> pa.Table:
    """One row for each phrase; ``part`` follows from lang and phrase, where it is given."""
    whole = pa.concat_tables(tables)
    more = [("part", "min")] if "part" in whole.column_names else []
    found = whole.group_by(["lang", "words", "phrase"]).aggregate([("f", "sum"), *more])
    part = found["part_min"] if more else pa.array(np.zeros(found.num_rows, np.int32))
    columns = [found["lang"], found["words"], found["phrase"], found["f_sum"], part]
    return pa.table(columns, names=["lang", "words", "phrase", "f", "part"])


def _place(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash space, which is cut into a power of two."""
    if parts == 1:
        return np.zeros(len(hashes), dtype=np.int32)
    return (hashes >> np.uint64(65 - parts.bit_length())).astype(np.int32)


def _exact(part: _Part, names: list[str], marks: np.ndarray, bits: int, parts: int, longest: int) -> pa.Table:
    tables = []

    def add(lang: np.ndarray, words: int, phrase: pa.Array, counts: np.ndarray, place: np.ndarray) -> None:
        tables.append(
            pa.table(
                {
                    "lang": pa.array(names).take(pa.array(lang)),
                    "words": pa.array(np.full(len(counts), words, dtype=np.int32)),
                    "phrase": phrase,
                    "f": pa.array(counts.astype(np.int64)),
                    "part": pa.array(place),
                }
            )
        )

    total = np.bincount(part.lang, minlength=len(names))
    of_lang = _place(_hashes([n.encode() for n in names], 1), parts)
    add(np.arange(len(names)), 0, pa.array([""] * len(names)), total, of_lang)
    at = np.arange(len(part.ids))
    number = part.lang.astype(np.int64)  # of the phrase before its last word
    for n in range(1, longest + 1):
        left = len(part.ids) - n + 1
        number, at = number[at < left], at[at < left]
        if not len(at):
            break
        take = part.whole(n)[at] & common.marked(marks, part.hashes(n)[at], bits)
        number, at = number[take], at[take]
        if not len(at):
            break
        _, first, number, counts = np.unique(
            number * len(part.different) + part.ids[at + n - 1], return_index=True, return_inverse=True, return_counts=True
        )
        begin = at[first]
        wording = [part.different.take(pa.array(part.ids[begin + i])) for i in range(n)]
        phrase = pc.binary_join_element_wise(*wording, pa.scalar(b" ", pa.large_binary())) if n > 1 else wording[0]
        place = _place(part.hashes(n)[begin], parts)
        add(part.lang[begin], n, phrase.cast(pa.binary()).cast(pa.string()), counts, place)
    return pa.concat_tables(tables)


def frequencies(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """lang, words, phrase, f of every word and phrase with f >= threshold, and of all words (words = 0)."""
    spark = docs.sparkSession
    texts = docs.select("text", "lang")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = 1 << max(0, (size // PART).bit_length())
    short = tuple(range(1, min(longest, 2) + 1))
    low = common.stored(frequent_hashes(blocks(texts, short, parts), threshold), "frequent")
    found = low
    if longest > 2:
        marks, bits = _bitmap(low)
        more = blocks(texts, tuple(range(3, longest + 1)), parts, marks, bits)
        found = low.unionByName(common.stored(frequent_hashes(more, threshold), "frequent"))
    marks, bits = _bitmap(found)
    return totals(counted(texts, marks, bits, parts, longest), threshold)


def _bitmap(codes: DataFrame) -> tuple[np.ndarray, int]:
    bits = min(BITS, max(20, (codes.count() * 32).bit_length()))
    return common.bitmap(codes, bits), bits


# Scores -------------------------------------------------------------------


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, first: int = FIRST, share: int = SHARE
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language."""
    known = common.stored(frequencies(docs, threshold, longest), "phrases")
    found = known.filter("words > 1").selectExpr("lang", "words", "phrase", "f AS a", "split(phrase, ' ') AS w")
    joined = lambda start, n: f"array_join(slice(w, {start}, {n}), ' ')"
    cuts = found.selectExpr("*", "explode(sequence(1, words - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", f"{joined('1', 'k')} AS left", f"{joined('k + 1', 'words - k')} AS right"
    )
    parts = known.filter("words > 0")
    scored = (
        cuts.join(parts.selectExpr("lang", "phrase AS left", "f AS l"), ["lang", "left"])
        .join(parts.selectExpr("lang", "phrase AS right", "f AS r"), ["lang", "right"])
        .selectExpr("lang", "phrase", "a", "k", "l", "r", "CAST(a AS DECIMAL(20, 0)) * 2000000 DIV (CAST(l AS DECIMAL(20, 0)) + r) AS score")
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = found.filter("words > 2").selectExpr("lang", "a", "w", "words", "explode(sequence(2, words - 1)) AS n")
    inner = inner.selectExpr("*", "explode(sequence(1, words - n + 1)) AS start").selectExpr(
        "lang", f"{joined('start', 'n')} AS phrase", "a"
    )
    within = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = scored.join(within, ["lang", "phrase"], "left").filter(
        f"longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {int(share)}"
    )
    ranked = _first(alone.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"), first)
    total = known.filter("words = 0").selectExpr("lang", "f AS n")
    return ranked.join(total, "lang").selectExpr(
        "lang", "CAST(rank AS BIGINT) AS rank", "phrase", "a", "l", "r", "n", "CAST(score AS BIGINT) AS score"
    )


def _first(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language, in rounds over shares by hash that hold some ORDERED rows."""
    rows = common.stored(rows, "scored")
    shares = rows.count() // ORDERED + 1
    order = "ORDER BY score DESC, a DESC, phrase"
    while shares > 1:
        place = f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), {shares}) {order})"
        rows = rows.selectExpr("*", f"{place} AS place").filter(f"place <= {int(first)}").drop("place")
        shares = shares * int(first) // ORDERED + 1 if shares * int(first) // ORDERED + 1 < shares else 1
    return rows.selectExpr("*", f"row_number() OVER (PARTITION BY lang {order}) AS rank").filter(f"rank <= {int(first)}")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


#: Pieces, words and all n-grams by lists; sums of 128 bits.
ORACLE_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, n, unnest(list_transform(range(1, len(w) - n + 2),
                                            lambda i: array_to_string(w[i : i + n - 1], ' '))) AS phrase
      FROM w, range(1, 5) AS r(n) WHERE len(w) >= n),
f AS (SELECT lang, n AS words, phrase, count(*) AS f FROM g GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
cuts AS (SELECT c.*, k, array_to_string(w[1 : k], ' ') AS lp, array_to_string(w[k + 1 : words], ' ') AS rp
         FROM c, range(1, 4) AS r(k) WHERE k < words),
scored AS (SELECT cuts.lang, cuts.words, cuts.phrase, a, k, x.f AS l, y.f AS r,
                  CAST(CAST(a AS HUGEINT) * 2000000 // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp
                     JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
best AS (SELECT * FROM scored
         QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, a, n, unnest(list_transform(range(1, words - n + 2),
                                                   lambda i: array_to_string(w[i : i + n - 1], ' '))) AS phrase
           FROM c, range(2, 4) AS r(n) WHERE n < words),
longer AS (SELECT lang, phrase, max(a) AS a FROM inner_ GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase)
         WHERE longer.a IS NULL OR 100 * CAST(longer.a AS HUGEINT) < 80 * CAST(best.a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
