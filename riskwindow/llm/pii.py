"""Personal data by weak supervision, in SQL functions only.

**Candidates.** Four strict patterns (email, ip, card, phone) give the base spans; a match that fails
its check (parts of an address over 255, wrong count of digits, Luhn) is no base span but
still a candidate. Loose patterns give more: card numbers inside a failed match, phone
numbers without a country code, addresses with the signs spelt out.

**Labelers.** Four vote on each candidate, 1 for personal data, -1 against, 0 for no opinion: the
strict patterns, gazetteers (top-level domains, card issuers, reserved addresses), the words and
characters around, and the shape of the number. Votes are counted by pattern; there are at most
4 x 3^4 patterns. Expectation-maximisation over the counts estimates for each kind the share of
true spans and each labeler's hit rates on true and false ones, and with these a probability per pattern.

**Classifier.** A naive Bayes classifier over hashed features of the span and its neighbours (shape, length,
neighbouring words and characters; ``BUCKETS`` of them) is trained with the probabilities as soft labels, and
decides on every candidate that is no base span. Base spans stay whatever it says.

**Overlaps.** A candidate of a loose pattern gives way to any base span, and of two added spans of one kind
that overlap the longer stays. Matches of one pattern never overlap, so an index of the matches by blocks of the
text gives those around a span, and each span meets only the ones that it may touch. The work grows with the text
and its spans, never with pairs of spans.

Candidates of a document are one array in a stored narrow table; the two fitted models are scalar subqueries.
No row is shuffled but counts. Patterns are written so that they neither recurse nor go back over long runs.

Defined results: null and empty texts have no spans; every row gets a result, repeated or not; an
empty table gives none. Spans are in code points, the end exclusive. Other columns are not looked at.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

KINDS = ("email", "ip", "card", "phone")
BUCKETS = 4096
ROUNDS = 25
LABELERS = 4

#: The same matches as the plain patterns, without recursion and repeated attempts: a match can only
#: begin where a run of its characters begins or where the last match has ended.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9][0-9\x20-]{12})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[\[({]at[\])}]\x20?)"
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z0-9-]{1,63}){1,8}",
    "card": r"(?<![0-9])[0-9]{13,19}(?![0-9])",
    "phone": r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}[\x20.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: A cheap sign without which a pattern cannot match.
SIGN = {"email": "instr(text, '@') > 0", "ip": "instr(text, '.') > 0", "card": "true", "phone": "instr(text, '+') > 0"}
LOOSE_SIGN = {
    "email": "text RLIKE '[({\\\\[]at[)}\\\\]]'",
    "card": "size(card) > 0 AND text RLIKE '[0-9]{13}'",
    "phone": "text RLIKE '[0-9]{3}[ .-][0-9]{4}'",
}

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|co|us|uk|de|fr|es|it|nl|eu|ch|at|be|pl|se|no|fi|dk|pt|ca|au|jp|cn|in|br|ru"
_ISSUERS = "^(4|5[1-5]|2[2-7]|3[47]|3[068]|6(011|4|5))"
_RESERVED = "^(0|10|127|169[.]254|192[.]168|224|255)[.]"
_FOR = "(e-?mail|mail|contact|phone|tel|telephone|call|cell|mobile|fax|card|visa|mastercard|credit|address|host|server|ip)"
_AGAINST = "(version|release|section|chapter|page|figure|isbn|issn|doi|order|invoice|token|password|key|sha|md5|hash|license)"


def _text(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """Whether a string of 1 to 19 digits passes the check sum."""
    return f"""aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum + CASE
        WHEN i % 2 = 1 THEN CAST(substr({digits}, -i, 1) AS INT)
        WHEN CAST(substr({digits}, -i, 1) AS INT) > 4 THEN 2 * CAST(substr({digits}, -i, 1) AS INT) - 9
        ELSE 2 * CAST(substr({digits}, -i, 1) AS INT) END) % 10 = 0"""


def _passes(kind: str) -> str:
    """The check of a strict match ``x.hit`` with its digits ``x.digits``."""
    return {
        "email": "true",
        "ip": f"x.hit RLIKE {_text(f'^(?:{_PART}[.]){{3}}{_PART}$')}",
        "card": f"CASE WHEN length(x.digits) BETWEEN 14 AND 19 THEN {_luhn('x.digits')} ELSE false END",
        "phone": "length(x.digits) BETWEEN 10 AND 15",
    }[kind]


def _votes(kind: str, strict: bool) -> str:
    """The labelers' votes on a candidate x."""
    pattern = "CASE WHEN x.base THEN 1 ELSE -1 END" if strict else "0"
    gazetteer = {
        "email": f"CASE WHEN lower(x.hit) RLIKE '(?:[.]|dot[)}}\\\\]] ?)({_DOMAINS})$' THEN 1 ELSE -1 END",
        "ip": f"CASE WHEN x.hit RLIKE '{_RESERVED}' THEN -1 ELSE 0 END",
        "card": f"CASE WHEN x.digits RLIKE '{_ISSUERS}' THEN 1 ELSE -1 END",
        "phone": "CASE WHEN x.digits RLIKE '^0{3}|^1?[01]' AND length(x.digits) < 12 THEN -1 ELSE 0 END",
    }[kind]
    # A digit, letter or sign right beside a candidate says that it is part of something longer.
    joined = "x.before RLIKE '[0-9A-Za-z_=/#]$' OR x.after RLIKE '^[0-9A-Za-z_=/]'"
    context = f"""CASE WHEN lower(x.before) RLIKE '{_AGAINST}[^a-z0-9]{{0,5}}$' THEN -1
        WHEN {joined} THEN -1
        WHEN lower(x.before) RLIKE '(^|[^a-z]){_FOR}[^a-z0-9]{{1,4}}([a-z]{{1,6}}[^a-z0-9]{{1,3}}){{0,2}}$' THEN 1
        ELSE 0 END"""
    plain = "x.digits RLIKE '^(.)\\\\1*$' OR instr('01234567890123456789', x.digits) > 0"
    shape = {
        "email": "CASE WHEN x.hit RLIKE '^[^@]*[A-Za-z]' THEN 1 ELSE -1 END",
        "ip": f"CASE WHEN x.hit RLIKE {_text(f'^(?:{_PART}[.]){{3}}{_PART}$')} THEN 1 ELSE -1 END",
        "card": f"""CASE WHEN {plain} THEN -1 WHEN length(x.digits) BETWEEN 13 AND 19 AND {_luhn('x.digits')}
            THEN 1 ELSE -1 END""",
        "phone": f"CASE WHEN {plain} THEN -1 WHEN length(x.digits) BETWEEN 10 AND 15 THEN 1 ELSE -1 END",
    }[kind]
    return f"array({pattern}, {gazetteer}, {context}, {shape})"


def _features(kind: str) -> str:
    """Hash buckets of the features of a candidate x."""
    shape = "regexp_replace(regexp_replace(x.hit, '[0-9]+', '9'), '[A-Za-z]+', 'a')"
    named = {
        "shape": shape,
        "digits": "CAST(length(x.digits) AS STRING)",
        "word before": "regexp_extract(lower(x.before), '([\\\\p{L}0-9]+)[^\\\\p{L}0-9]*$', 1)",
        "sign before": "regexp_replace(regexp_replace(right(x.before, 1), '[\\\\p{L}]', 'a'), '[0-9]', '9')",
        "sign after": "regexp_replace(regexp_replace(left(x.after, 1), '[\\\\p{L}]', 'a'), '[0-9]', '9')",
    }
    return "array(" + ", ".join(
        f"CAST(pmod(xxhash64('{kind} {name}', {value}), {BUCKETS}) AS INT)" for name, value in named.items()
    ) + ")"


def _located(rows: DataFrame, name: str, pattern: str, sign: str) -> DataFrame:
    """Adds an array of hit, start, end, before and after for the matches of a pattern in ``text``.

    The texts between matches and the matches give the places by running sums, taken from blocks of
    64 and of 4,096, so that very many matches in one text stay cheap.
    """
    hits, between, steps = f"{name}_hits", f"{name}_between", f"{name}_steps"
    rows = rows.withColumn(hits, F.expr(f"CASE WHEN {sign} THEN regexp_extract_all(text, {_text(pattern)}, 0) END"))
    rows = rows.withColumn(between, F.expr(f"CASE WHEN size({hits}) > 0 THEN split(text, {_text(pattern)}, -1) END"))
    rows = rows.withColumn(
        steps,
        F.expr(f"transform({hits}, (x, i) -> length({between}[i]) + IF(i > 0, length({hits}[i - 1]), 0))"),
    )
    blocks, parts = f"{name}_blocks", f"{name}_parts"
    total = lambda column, start, n: f"aggregate(slice({column}, {start}, {n}), 0, (a, x) -> a + x)"
    for made, summed in ((blocks, steps), (parts, blocks)):
        each = f"transform(sequence(0, size({summed}) DIV 64), b -> {total(summed, 'b * 64 + 1', 64)})"
        rows = rows.withColumn(made, F.expr(each))
    # Two uses of each sum keep the optimizer from writing its definition into the lambda, where it
    # would be computed for each match.
    place = " + ".join(
        f"IF(size({column}) > 0, {total(column, start, n)}, 0)"
        for column, start, n in (
            (parts, 1, "i DIV 4096"),
            (blocks, "(i DIV 4096) * 64 + 1", "(i DIV 64) % 64"),
            (steps, "(i DIV 64) * 64 + 1", "i % 64 + 1"),
        )
    )
    found = F.expr(
        f"""transform(transform({hits}, (h, i) -> struct(
            h AS hit, {place} AS start, right({between}[i], 40) AS before, left({between}[i + 1], 20) AS after)),
          x -> struct(x.hit AS hit, x.start AS start, x.start + length(x.hit) AS end, x.before AS before,
            x.after AS after, regexp_replace(x.hit, '[^0-9]', '') AS digits))"""
    )
    return rows.withColumn(name, F.coalesce(F.when(F.size(hits) > 0, found), F.array())).drop(
        hits, between, steps, blocks, parts
    )


_CANDIDATE = (
    "array<struct<kind:string,nth:int,start:int,end:int,base:boolean,loose:boolean,votes:array<int>,features:array<int>>>"
)


def _index(spans: str) -> str:
    """For each block of 64 characters, how many of the spans begin before it; up to the last one's block.

    ``spans`` is a column of spans in order that do not overlap.
    """
    before = f"IF(i > 0, {spans}[i - 1].start DIV 64, -1)"
    return f"flatten(transform({spans}, (x, i) -> array_repeat(i, CAST(x.start DIV 64 - {before} AS INT))))"


def _around(spans: str, index: str) -> str:
    """The spans that x may overlap: from the last one that begins before its first block."""
    count = f"size({spans})"
    first = f"greatest(coalesce(get({index}, CAST(x.start DIV 64 AS INT)), {count}), 1)"
    behind = f"coalesce(get({index}, CAST((x.end - 1) DIV 64 + 1 AS INT)), {count})"
    return f"slice({spans}, {first}, greatest({behind} - {first} + 1, 0))"


def _indexed(rows: DataFrame, columns: list[str]) -> DataFrame:
    for column in columns:
        rows = rows.withColumn(f"{column}_index", F.expr(f"CASE WHEN size({column}) > 0 THEN {_index(column)} END"))
    return rows


def _touches(column: str, test: str) -> str:
    """Whether a span y of the column that overlaps x passes a test."""
    near = _around(column, f"{column}_index")
    overlap = "x.start < y.end AND y.start < x.end"
    return f"(size({column}) > 0 AND exists({near}, y -> {overlap} AND {test}))"


def _judged(kind: str, column: str, strict: bool) -> str:
    """Candidates of a kind as structs with votes and features."""
    checked = f"transform({column}, x -> struct(x.*, {_passes(kind) if strict else 'false'} AS base))".replace(
        "x.*", "x.hit AS hit, x.start AS start, x.end AS end, x.before AS before, x.after AS after, x.digits AS digits"
    )
    return f"""transform({checked}, x -> struct('{kind}' AS kind, {KINDS.index(kind)} AS nth, x.start AS start,
        x.end AS end, x.base AS base, {'false' if strict else 'true'} AS loose, {_votes(kind, strict)} AS votes,
        {_features(kind)} AS features))"""


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and found (an array of candidates) of every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    for kind in KINDS:
        rows = _located(rows, kind, STRICT[kind], SIGN[kind])
    for kind in LOOSE:
        rows = _located(rows, f"loose_{kind}", LOOSE[kind], LOOSE_SIGN[kind])
    # A run of digits that is a whole match of the strict pattern is a candidate already.
    rows = rows.withColumn("whole_card", F.expr("CASE WHEN size(loose_card) > 0 THEN card END"))
    same = _touches("whole_card", "y.start = x.start AND y.end = x.end")
    rows = _indexed(rows, ["whole_card"]).withColumn(
        "loose_card", F.expr(f"filter(loose_card, x -> NOT coalesce({same}, false))")
    )
    strict = ", ".join(_judged(kind, kind, True) for kind in KINDS)
    loose = ", ".join(_judged(kind, f"loose_{kind}", False) for kind in LOOSE)
    rows = rows.select(
        "doc_id",
        F.expr(f"CAST(concat({strict}) AS {_CANDIDATE})").alias("strict"),
        F.expr(f"CAST(concat({loose}) AS {_CANDIDATE})").alias("loose"),
    )
    for n, kind in enumerate(KINDS):
        rows = rows.withColumn(
            f"base_{kind}", F.expr(f"CASE WHEN size(loose) > 0 THEN filter(strict, x -> x.base AND x.nth = {n}) END")
        )
    rows = _indexed(rows, [f"base_{kind}" for kind in KINDS])
    covered = " OR ".join(f"coalesce({_touches(f'base_{kind}', 'true')}, false)" for kind in KINDS)
    return rows.select("doc_id", F.expr(f"concat(strict, filter(loose, x -> NOT ({covered})))").alias("found"))


_MODEL = "struct<prior:double,hit:array<double>,clear:array<double>>"


def _posterior(model: str, votes: str) -> str:
    """Probability that a candidate with these votes is true."""
    true = f"""aggregate(sequence(0, {LABELERS - 1}), {model}.prior, (p, l) -> p * CASE {votes}[l]
        WHEN 1 THEN {model}.hit[l] WHEN -1 THEN 1 - {model}.hit[l] ELSE 1D END)"""
    false = f"""aggregate(sequence(0, {LABELERS - 1}), 1 - {model}.prior, (p, l) -> p * CASE {votes}[l]
        WHEN -1 THEN {model}.clear[l] WHEN 1 THEN 1 - {model}.clear[l] ELSE 1D END)"""
    return f"(({true}) / (({true}) + ({false})))"


def reliabilities(spans: DataFrame) -> DataFrame:
    """kind, model: what expectation-maximisation makes of the counted vote patterns; a row per kind.

    ``spans`` has kind and votes. Rates start at 0.8; four right votes for each wrong one are added to
    every count, so that a labeler without votes keeps that rate and none reaches 0 or 1.
    """
    counted = spans.groupBy("kind", "votes").count().groupBy("kind").agg(
        F.sort_array(F.collect_list(F.struct("votes", F.col("count").cast("double").alias("n")))).alias("patterns")
    )
    expected = f"transform(patterns, x -> struct(x.votes AS votes, x.n AS n, {_posterior('m', 'x.votes')} AS p))"
    rate = """transform(sequence(0, {last}), l ->
        (4 + aggregate(e, 0D, (a, x) -> a + IF(x.votes[l] = {vote}, x.n * {weight}, 0D)))
        / (5 + aggregate(e, 0D, (a, x) -> a + IF(x.votes[l] <> 0, x.n * {weight}, 0D))))"""
    step = f"""transform(array({expected}), e -> struct(
        (1 + aggregate(e, 0D, (a, x) -> a + x.n * x.p)) / (2 + aggregate(e, 0D, (a, x) -> a + x.n)) AS prior,
        {rate.format(last=LABELERS - 1, vote=1, weight='x.p')} AS hit,
        {rate.format(last=LABELERS - 1, vote=-1, weight='(1 - x.p)')} AS clear))[0]"""
    start = f"named_struct('prior', 0.5D, 'hit', array_repeat(0.8D, {LABELERS}), 'clear', array_repeat(0.8D, {LABELERS}))"
    return counted.select(
        "kind",
        F.expr(
            f"aggregate(sequence(1, {ROUNDS}), CAST({start} AS {_MODEL}), (m, i) -> CAST({step} AS {_MODEL}))"
        ).alias("model"),
    )


def classifier(spans: DataFrame) -> DataFrame:
    """One row: bias, and weights (one for each bucket), from features and probability p of each span."""
    totals = spans.agg(
        F.coalesce(F.sum("p"), F.lit(0.0)).alias("yes"), F.coalesce(F.sum(1 - F.col("p")), F.lit(0.0)).alias("no")
    )
    rows = spans.select("p", F.explode("features").alias("bucket")).groupBy("bucket").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")
    )
    # At most BUCKETS rows.
    weights = rows.agg(F.map_from_entries(F.collect_list(F.struct("bucket", F.struct("yes", "no")))).alias("known"))
    return weights.select(
        F.coalesce("known", F.map_from_arrays(F.array(), F.array())).alias("known"),
        totals.select("yes").scalar().alias("yes"),
        totals.select("no").scalar().alias("no"),
    ).selectExpr(
        "ln((yes + 1) / (no + 1)) AS bias",
        f"""transform(sequence(0, {BUCKETS - 1}), b ->
            coalesce(ln((known[b].yes + 0.5) / (yes + 1)) - ln((known[b].no + 0.5) / (no + 1)), 0D)) AS weights""",
    )


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of start, nth, kind, end, base, in order) of every row."""
    found = common.stored(candidates(docs), "candidates")
    each = found.select(F.explode("found").alias("x")).select("x.kind", "x.votes", "x.features")
    models = common.stored(reliabilities(each), "reliabilities")
    judged = each.join(F.broadcast(models), "kind")  # a row for each of the four kinds
    weighted = judged.select("features", F.expr(_posterior("model", "votes")).alias("p"))
    fitted = common.stored(classifier(weighted), "classifier")
    whole = found.select(
        "doc_id",
        F.col("found"),
        fitted.select(F.struct("bias", "weights")).scalar().alias("model"),
    )
    place = "struct(x.start AS start, x.nth AS nth, x.kind AS kind, x.end AS end, x.base AS base, x.loose AS loose)"
    rows = whole.select(
        "doc_id",
        F.expr(
            f"""array_sort(transform(filter(found, x -> x.base OR
                aggregate(x.features, model.bias, (s, f) -> s + model.weights[f]) > 0), x -> {place}))"""
        ).alias("all"),
    )
    # Of added spans of one kind that overlap, the longest stays; failed matches give way to cards inside.
    sides = [(kind, KINDS.index(kind), side) for kind in LOOSE for side in ("loose", "failed")]
    for kind, n, side in sides:
        test = "x.loose" if side == "loose" else "NOT x.loose AND NOT x.base"
        rows = rows.withColumn(f"{side}_{kind}", F.expr(f"filter(all, x -> x.nth = {n} AND {test})"))
    rows = _indexed(rows, [f"{side}_{kind}" for kind, _, side in sides])
    shorter = " OR ".join(
        f"(x.nth = {n} AND {'NOT x.loose' if side == 'loose' else 'x.loose'} AND "
        f"{_touches(f'{side}_{kind}', 'y.end - y.start > x.end - x.start')})"
        for kind, n, side in sides
    )
    return rows.select(
        "doc_id",
        F.expr(f"transform(filter(all, x -> x.base), x -> {_PLACE})").alias("base"),
        F.expr(f"transform(filter(all, x -> x.base OR NOT ({shorter})), x -> {_PLACE})").alias("spans"),
    )


_PLACE = "struct(x.start AS start, x.nth AS nth, x.kind AS kind, x.end AS end, x.base AS base)"


def op5_pii(spark, sf_dir: str) -> DataFrame:
    said = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    return spans(common.table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        *[f"CAST(size(filter(base, x -> x.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS],
        f"sha2({said.format('base')}, 256) AS base_sha256",
        f"{said.format('spans')} AS spans",
    )
