"""Resolution of not-modified revisits in web archives.

A revisit (status 304) stores no body. Its page is the latest earlier full response (status 200) of the same
canonical URL, found by an as-of join, provided the validators agree: the entity tags under weak comparison
if the revisit has one, else the Last-Modified dates. The resolved record has the response's body
and its headers, updated by those headers of the revisit that a 304 may change.

**As-of join without large groups.** Time is cut into slices of about ``SLICE`` records over all URLs, by
quantiles of the times; records of one time stay together. The driver holds the bounds of at most ``MOST`` slices; a
table of more is cut again inside each of them, by quantiles that Spark takes for each slice. Beyond ``MOST`` x
``MOST`` x ``SLICE`` records (about 10^11) slices grow. A window
over (URL, slice) finds the latest response in a revisit's own slice; the latest response of each (URL, slice), at
most one row each, gives the one to go back to from slices without. So a URL that holds a third of all
records is spread over all slices. Windows see times and ids only; bodies are joined at the end.

Records: record_id, url, ts (long), kind (``response`` or ``revisit``), headers (map), body. Defined results: each revisit
gives one row, repeated or not; without URL or time, or without an earlier response, its outcome is ``no response``;
with validators that disagree ``changed``, with none ``unverified``; else ``resolved``. At equal times a response counts
as not earlier; of several responses at the latest time the largest record_id is taken. Header names compare
without case. An empty table gives no rows. Other columns are not looked at.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

SLICE = 100_000
MOST = 1024
#: Headers that a not-modified response may update.
PERMITTED = (
    "age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning",
)
TRACKING = "^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"

_CANONICAL = f"""concat(
    regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)),
                                  '^(?:[^@]*@)?(?:www[.])?', ''), ':(?:80|443)?$', ''),
    regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1), '/+$', ''),
    array_join(transform(array_sort(filter(split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'),
        x -> x <> '' AND NOT lower(x) RLIKE '{TRACKING}')), (x, i) -> concat(IF(i = 0, '?', '&'), x)), ''))"""


def _named(headers: str) -> str:
    """A map with header names in lower case; of names that then agree the last counts."""
    entries = f"map_entries({headers})"
    return f"""map_from_entries(filter(transform({entries}, e -> struct(lower(e.key) AS key, e.value AS value)),
        (e, i) -> NOT exists(slice({entries}, i + 2, size({entries})), y -> lower(y.key) = e.key)))"""


def prepared(records: DataFrame) -> DataFrame:
    return records.selectExpr(
        "CAST(record_id AS BIGINT) AS record_id",
        "CAST(ts AS BIGINT) AS ts",
        "kind",
        f"{_CANONICAL} AS page",
        f"{_named('coalesce(headers, map())')} AS headers",
        "body",
    )


def _sliced(events: DataFrame) -> DataFrame:
    """The events with their slice of time, which grows with ts; bounds are quantiles of the times."""
    slices = -(-events.count() // SLICE)
    coarse = min(slices, MOST)
    shares = [i / coarse for i in range(1, coarse)]
    bounds = sorted(set(events.approxQuantile("ts", shares, 0.1 / coarse))) if shares else []
    if not bounds:
        return events.withColumn("slice", F.lit(0).cast("long"))
    splits = [-float("inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="ts", outputCol="slice").transform(events)
    cut = cut.withColumn("slice", F.col("slice").cast("long"))
    return cut if slices <= MOST else _cut_again(cut, min(-(-slices // MOST), MOST))


def _cut_again(sliced: DataFrame, parts: int) -> DataFrame:
    """Each slice in so many parts of about the same number of events; at most MOST x MOST bounds are broadcast (8 MB)."""
    shares = ", ".join(f"{i / parts}D" for i in range(1, parts))
    bounds = sliced.groupBy("slice").agg(F.expr(f"percentile_approx(ts, array({shares}), {10 * parts})").alias("bounds"))
    place = f"slice * {MOST} + aggregate(bounds, 0L, (n, b) -> n + IF(b <= ts, 1L, 0L))"
    return sliced.join(F.broadcast(bounds), "slice").select(*[c for c in sliced.columns if c != "slice"], F.expr(place).alias("slice"))


def _latest(events: DataFrame) -> DataFrame:
    """For each revisit (page, ts) the time of the latest earlier response."""
    sliced = _sliced(events)
    own = sliced.selectExpr(
        "*",
        """max(IF(is_response, ts, NULL)) OVER (PARTITION BY page, slice ORDER BY ts
            RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near""",
    ).filter("NOT is_response").select("page", "slice", "ts", "near")
    ends = sliced.groupBy("page", "slice").agg(F.max(F.expr("IF(is_response, ts, NULL)")).alias("last"))
    before = ends.selectExpr(
        "page",
        "slice",
        """max(last) OVER (PARTITION BY page ORDER BY slice
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far""",
    )
    return own.join(before, ["page", "slice"]).select(
        "page", "ts", F.coalesce("near", "far").alias("found")
    ).distinct()


def resolve(records: DataFrame) -> DataFrame:
    """record_id, page, ts, outcome, response_id, headers, body of every revisit."""
    rows = prepared(records)
    revisits = rows.filter("kind = 'revisit'").drop("kind", "body")
    responses = rows.filter("kind = 'response' AND page IS NOT NULL AND ts IS NOT NULL")
    events = rows.filter("page IS NOT NULL AND ts IS NOT NULL AND kind IN ('revisit', 'response')").selectExpr(
        "page", "ts", "kind = 'response' AS is_response"
    ).distinct()
    latest = _latest(common.stored(events, "events"))
    # Which record that is: the largest id of its page and time, and one row of it.
    chosen = responses.groupBy("page", "ts").agg(
        F.max(F.struct("record_id", F.sort_array(F.map_entries("headers")).alias("headers"), "body")).alias("response")
    ).selectExpr(
        "page AS response_page", "ts AS found", "response.record_id AS response_id",
        "map_from_entries(response.headers) AS response_headers", "response.body AS body",
    )
    joined = (
        revisits.join(latest, ["page", "ts"], "left")
        .join(chosen, (F.col("page") == F.col("response_page")) & (chosen["found"] == latest["found"]), "left")
    )
    tag = "regexp_replace({}['etag'], '^W/', '')".format
    judged = joined.withColumn(
        "outcome",
        F.expr(
            f"""CASE WHEN response_page IS NULL THEN 'no response'
                WHEN headers['etag'] IS NOT NULL THEN
                  IF({tag('headers')} <=> {tag('response_headers')}, 'resolved', 'changed')
                WHEN headers['last-modified'] IS NOT NULL THEN
                  IF(headers['last-modified'] <=> response_headers['last-modified'], 'resolved', 'changed')
                ELSE 'unverified' END"""
        ),
    )
    allowed = ", ".join(f"'{h}'" for h in PERMITTED)
    merged = f"""map_concat(map_filter(response_headers, (k, v) -> NOT (k IN ({allowed}) AND map_contains_key(headers, k))),
        map_filter(headers, (k, v) -> k IN ({allowed})))"""
    good = F.col("outcome") == "resolved"
    return judged.select(
        "record_id",
        "page",
        "ts",
        "outcome",
        F.when(good, F.col("response_id")).alias("response_id"),
        F.when(good, F.expr(merged)).alias("headers"),
        F.when(good, F.col("body")).alias("body"),
    )


LAG = 250


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records of crawled pages.

    Every page is a response at the time of its id, and is asked for again ``LAG`` ids later with the validators
    it had; some revisits have a weak tag, a date only, or no validator.
    """
    return pages.selectExpr(
        "page_id", "url", "html", "CAST(page_id DIV 7 AS STRING) AS changed", "concat('\"', md5(html), '\"') AS tag"
    ).selectExpr(
        f"""inline(array(
          struct(page_id AS record_id, url, page_id AS ts, 'response' AS kind, map('ETag', tag, 'Last-Modified', changed,
            'Content-Type', 'text/html', 'Content-Length', CAST(length(html) AS STRING), 'Date', CAST(page_id AS STRING))
            AS headers, html AS body),
          struct(page_id AS record_id, url, page_id + {LAG} AS ts, 'revisit' AS kind, map_filter(map(
            'etag', CASE WHEN page_id % 11 = 0 OR page_id % 5 = 0 THEN NULL WHEN page_id % 4 = 1 THEN concat('W/', tag) ELSE tag END,
            'last-modified', IF(page_id % 11 = 0, NULL, changed), 'content-length', '0',
            'Date', CAST(page_id + {LAG} AS STRING)), (k, v) -> v IS NOT NULL) AS headers, CAST(NULL AS STRING) AS body)))"""
    )


def op4_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """One row per revisit; response_id and body_chars are -1 where none is resolved."""
    found = resolve(records_of_pages(common.table(spark, sf_dir, "pages")))
    return found.select(
        "record_id",
        F.col("page").alias("url_key"),
        "ts",
        "outcome",
        F.coalesce("response_id", F.lit(-1).cast("long")).alias("response_id"),
        F.expr("array_join(transform(array_sort(map_entries(headers)), e -> concat(e.key, ': ', e.value)), '; ')").alias(
            "headers"
        ),
        F.expr("CAST(coalesce(length(body), -1) AS BIGINT)").alias("body_chars"),
    )


ORACLE_SQL = f"""
WITH pages_keyed AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)),
             '^(?:[^@]*@)?(?:www[.])?', ''), ':(?:80|443)?$', '')
    || regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END AS page
  FROM (SELECT *, [x FOR x IN string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&')
          IF x <> '' AND NOT regexp_matches(lower(x), '{TRACKING}')] AS params FROM pages)),
responses AS (
  SELECT page, page_id, html, '"' || md5(html) || '"' AS tag, CAST(page_id // 7 AS VARCHAR) AS changed
  FROM pages_keyed),
revisits AS (
  SELECT page_id AS record_id, page, page_id + {LAG} AS ts,
    CASE WHEN page_id % 11 = 0 OR page_id % 5 = 0 THEN NULL WHEN page_id % 4 = 1 THEN 'W/' || tag ELSE tag END AS tag,
    CASE WHEN page_id % 11 = 0 THEN NULL ELSE changed END AS changed
  FROM responses),
joined AS (
  SELECT v.*, r.page_id AS found, r.tag AS r_tag, r.changed AS r_changed, r.html,
    CASE WHEN r.page_id IS NULL THEN 'no response'
      WHEN v.tag IS NOT NULL THEN CASE WHEN replace(v.tag, 'W/', '') = r.tag THEN 'resolved' ELSE 'changed' END
      WHEN v.changed IS NOT NULL THEN CASE WHEN v.changed = r.changed THEN 'resolved' ELSE 'changed' END
      ELSE 'unverified' END AS outcome
  FROM revisits v LEFT JOIN responses r
    ON r.page = v.page AND r.page_id = (SELECT max(page_id) FROM responses x WHERE x.page = v.page AND x.page_id < v.ts))
SELECT record_id, page AS url_key, ts, outcome,
  CASE WHEN outcome = 'resolved' THEN found ELSE -1 END AS response_id,
  CASE WHEN outcome = 'resolved' THEN 'content-length: ' || length(html) || '; content-type: text/html; date: ' || ts
    || '; etag: ' || coalesce(tag, r_tag) || '; last-modified: ' || coalesce(changed, r_changed) END AS headers,
  CASE WHEN outcome = 'resolved' THEN length(html) ELSE -1 END AS body_chars
FROM joined"""
