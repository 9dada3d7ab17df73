"""Language identification by compression.

Every language gets a dictionary of its most common words. A text is compressed by
zstandard with each dictionary as raw content, and the language whose dictionary
gives the fewest bytes is chosen. Texts are encoded whole, in blocks of ``BLOCK`` bytes, so
that the dictionary counts for the end of a long text as much as for its start. A few whole bytes
tell little about a short text; one of at most ``SHORT`` bytes is therefore encoded after each of
``CONTEXTS`` stretches of the dictionary, and what it adds there is summed up. Where
the runner-up needs hardly more bytes, the decision is **rejected** (``accepted`` is false). ``MARGIN`` was chosen
on labelled rows that neither the dictionaries nor the measured accuracy come from.

Dictionaries are learnt from a bounded sample: about ``SAMPLE`` different texts per
language, chosen by the hash of the text, whole. Words are counted in Spark; what
reaches the driver is at most ``DICTIONARY`` bytes for each value of ``lang``.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not accepted;
with nothing learnt every text is. Ties go to the alphabetically first language and are
not accepted. Repeated rows each get a result; an empty table gives none; rows with a null
lang are predicted like others and not learnt from. Other columns are not looked at.
"""

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwindow.llm import common

SAMPLE = 800
DICTIONARY = 32_768
BLOCK = 4096
LEVEL = 6
MARGIN = 0.02
SHORT, CONTEXTS = 256, 8
UNDETERMINED = "und"

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_FINE = 1 << 40


def normalise(text: str) -> str:
    """Lower-case words with one space between them; a letter's combining marks are part of its word, and
    digits and punctuation count for no language.
    """
    return _OTHER.sub(" ", text.lower())


def dictionaries(labelled: DataFrame, sample: int = SAMPLE, size: int = DICTIONARY) -> dict[str, bytes]:
    """language -> its common words, the most common last, where a reference to them is shortest."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", common.text_hash().alias("text_key")
    )
    # Of different texts, as copies are drawn together.
    different = rows.select("lang", "text_key").distinct()
    counts = {r["lang"]: r["count"] for r in different.groupBy("lang").count().collect()}
    if not counts:
        return {}
    shares = F.create_map(
        *[F.lit(x) for k, n in counts.items() for x in (k, min(_FINE, _FINE * sample // n))]
    )
    drawn = rows.filter(F.pmod(F.col("text_key"), F.lit(_FINE)) < shares[F.col("lang")])
    texts = drawn.groupBy("lang", "text_key").agg(F.first("text").alias("text"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = set(normalise(text).split())
                langs += [lang] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.string())], names=["lang", "word"]
            )

    counted = (
        texts.select("lang", "text").mapInArrow(words, "lang string, word string")
        .groupBy("lang", "word").count()
        .withColumn("bytes", F.octet_length("word") + 1)
    )
    place = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    ranked = counted.withColumn("place", F.row_number().over(place)).filter(
        F.col("place") <= size // 2  # no word takes less than two bytes with its space
    )
    before = Window.partitionBy("lang").orderBy("place")
    chosen = ranked.withColumn("total", F.sum("bytes").over(before)).filter(F.col("total") <= size)
    by_lang: dict[str, list] = {lang: [] for lang in counts}
    for row in chosen.select("lang", "word", "place").collect():
        by_lang[row["lang"]].append((row["place"], row["word"]))
    return {
        lang: (" " + " ".join(w for _, w in sorted(found, reverse=True)) + " ").encode()
        for lang, found in sorted(by_lang.items())
    }


class Model:
    """Compressors of all languages, in alphabetical order."""

    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        self.langs, self.compressors, self.contexts = [], [], []
        for lang, raw in content.items():
            words = zstandard.ZstdCompressionDict(raw.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            self.langs.append(lang)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=level, dict_data=words, write_content_size=False, write_checksum=False
                )
            )
            step = len(raw) // (CONTEXTS + 1)
            # Of different lengths, so that the same bits do not end in the same byte each time.
            before = [raw[i * step :][: 64 + i] for i in range(CONTEXTS)]
            self.contexts.append([(b, len(self.compressors[-1].compress(b))) for b in before])

    def sizes(self, text: str, block: int = BLOCK) -> list[int]:
        raw = normalise(text).encode()
        if len(raw) <= SHORT:
            return [
                sum(len(c.compress(before + b" " + raw)) - own for before, own in contexts)
                for c, contexts in zip(self.compressors, self.contexts)
            ]
        parts = [raw[i : i + block] for i in range(0, len(raw), block)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, margin."""
        if not self.langs or text is None or not _LETTER.search(text):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        unit = 1 + max(best, 0) / 64
        score = 1 / sum(2.0 ** ((best - s) / unit) for s in sizes)
        margin = (sizes[order[1]] - best) / max(sizes[order[1]], 1) if len(order) > 1 else 1.0
        return self.langs[order[0]], score, margin


def classify(frame: DataFrame, content: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """A frame with a column ``text`` as it is, and lang_pred, score, margin, accepted instead of the text."""
    others = [c for c in frame.columns if c != "text"]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name != "text"]
        + ["lang_pred string", "score double", "margin double", "accepted boolean"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(content)
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            lang, score, gap = (list(x) for x in zip(*found)) if found else ([], [], [])
            yes = [k != UNDETERMINED and g >= margin for k, g in zip(lang, gap)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in others],
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(gap, pa.float64()),
                    pa.array(yes, pa.bool_()),
                ],
                names=[*others, "lang_pred", "score", "margin", "accepted"],
            )

    return frame.mapInArrow(run, schema)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def keep_accepted(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The rows of docs whose language is clear; learns from all labelled rows of docs."""
    verdicts = classify(common.keyed(docs, "text"), dictionaries(docs), margin)
    rejected = common.stored(
        verdicts.filter("NOT accepted").select("doc_id", "text_key").distinct(), "rejected"
    )
    rows = common.whole_rows(docs)
    return rows.join(rejected, common.same_key(rows, rejected), "left_anti").select("row.*")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(), F.lit(False))
    content = dictionaries(docs.filter(~out).select("text", "lang"))
    return classify(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), "text"), content
    )
