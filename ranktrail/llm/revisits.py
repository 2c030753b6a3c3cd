"""Not-modified revisits of web archives, resolved by an as-of join.

A revisit record says that a fetch was answered 304 Not Modified, so its content is that of the
latest earlier full response for the same canonical URL, provided the validators agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktrail.llm.common import pages, stored

SLICES = 1024  # time slices into which the captures of one URL are cut
TRACKING = r"(?i)^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid)(=|$)"
# Headers that RFC 9110 lets a 304 response carry and RFC 9111 lets it update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
REVISIT_LAG = 1000  # captures after which the sample's client asks again


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www.``, default port, fragment, tracking parameters and end slash.

    Host letters A-Z are lowered, remaining parameters sorted. Null stays null.
    """
    rest = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda q: (q != "") & ~F.rlike(q, F.lit(TRACKING))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(host, path, tail)


def same_entity(revisit: str, response: str) -> Column:
    """Do the validators agree: entity tags, compared weakly, or else the modification dates."""
    tag = [F.regexp_replace(F.col(f"{side}.etag"), "^W/", "") for side in (revisit, response)]
    date = [F.col(f"{side}.last_modified") for side in (revisit, response)]
    return F.coalesce(tag[0] == tag[1], date[0] == date[1], F.lit(False))


def merged_headers(stored_headers: Column, update: Column) -> Column:
    """The response's headers, each permitted one replaced or added from the revisit's."""
    allowed = F.map_filter(update, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    rest = F.map_filter(stored_headers, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(rest, allowed)


def resolve_revisits(captures: DataFrame, slices: int = SLICES) -> DataFrame:
    """One row per revisit with the response that stands for it.

    ``captures`` has record_id and ts (long), url, kind (``response`` or ``revisit``), etag and
    last_modified (string), headers (map of lower-case names); record_id is unique among
    responses. The result has record_id, canonical, ts, response_id, response_ts, outcome
    (``resolved``, ``changed`` where the validators disagree or are missing, ``unknown`` without
    an earlier response) and headers: merged if resolved, else the revisit's own.

    Earlier means a lower ts; of equal ones the highest record_id counts. Captures without a url
    or ts match nothing, and responses without a record_id stand for none. Null headers count
    as none. Repeated revisits are resolved each; other columns are ignored; an empty table gives
    no rows. All captures of a URL are cut into time slices, so a busy URL is no single group.
    """
    empty = F.create_map().cast("map<string,string>")
    known = captures.select(
        F.col("record_id").cast("long"),
        F.col("ts").cast("long"),
        "kind",
        "etag",
        "last_modified",
        F.coalesce("headers", empty).alias("headers"),
        canonical_url(F.col("url")).alias("canonical"),
    )
    known = known.filter(F.col("kind").isin("response", "revisit"))
    span = captures.agg(F.min(F.col("ts").cast("long")), F.max(F.col("ts").cast("long"))).first()
    low, high = (span[0] or 0), (span[1] or 0)
    place = F.floor((F.col("ts") - low) / F.lit((high - low) // slices + 1)).cast("int")
    is_response = (F.col("kind") == "response") & F.col("record_id").isNotNull()
    point = F.when(is_response, F.struct("ts", "record_id"))
    light = known.select("kind", "record_id", "ts", "canonical", place.alias("slice"), point.alias("p"))
    light = light.filter(F.col("canonical").isNotNull() & F.col("ts").isNotNull())
    # the latest response before each slice, from one row per URL and slice
    last = light.groupBy("canonical", "slice").agg(F.max("p").alias("p"))
    before = Window.partitionBy("canonical").orderBy("slice")
    carried = last.select(
        "canonical", "slice", F.max("p").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("c")
    )
    inside = (
        Window.partitionBy("canonical", "slice")
        .orderBy("ts")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    found = (
        light.withColumn("p", F.max("p").over(inside))
        .filter(F.col("kind") == "revisit")
        .join(carried, ["canonical", "slice"])
        .select("canonical", "ts", "record_id", F.coalesce("p", "c").alias("p"))
        .select(
            F.col("canonical").alias("k_url"),
            F.col("ts").alias("k_ts"),
            F.col("record_id").alias("k_id"),
            F.col("p.record_id").alias("response_id"),
            F.col("p.ts").alias("response_ts"),
        )
        .distinct()
    )
    revisits = known.filter(F.col("kind") == "revisit").alias("v")
    responses = known.filter(is_response).alias("r")
    joined = revisits.join(
        found,
        (F.col("v.canonical") == F.col("k_url"))
        & (F.col("v.ts") == F.col("k_ts"))
        & F.col("v.record_id").eqNullSafe(F.col("k_id")),
        "left",
    ).join(responses, F.col("response_id") == F.col("r.record_id"), "left")
    resolved = F.col("response_id").isNotNull() & same_entity("v", "r")
    outcome = F.when(F.col("response_id").isNull(), "unknown").when(resolved, "resolved")
    return joined.select(
        F.col("v.record_id").alias("record_id"),
        F.col("v.canonical").alias("canonical"),
        F.col("v.ts").alias("ts"),
        "response_id",
        "response_ts",
        outcome.otherwise("changed").alias("outcome"),
        F.when(resolved, merged_headers(F.col("r.headers"), F.col("v.headers")))
        .otherwise(F.col("v.headers"))
        .alias("headers"),
    )


def sample_captures(docs: DataFrame, lag: int = REVISIT_LAG) -> DataFrame:
    """Each page as a full response and, ``lag`` captures later, a revisit that validates it.

    Another response for the URL may lie in between, and then the validators disagree. Pages
    with a query string carry a modification date instead of an entity tag.
    """
    tag = F.when(~F.contains("url", F.lit("?")), F.md5("html"))
    date = F.when(F.contains("url", F.lit("?")), F.crc32(F.encode("html", "UTF-8")).cast("string"))
    fields = ["kind", "record_id", "ts", "url", "etag", "last_modified", "headers"]

    def headers(*pairs: tuple[str, Column]) -> Column:
        return F.create_map(*[x for name, value in pairs for x in (F.lit(name), value)])

    at = F.col("page_id").cast("string")
    size = F.length("html").cast("string")
    full = headers(
        ("content-type", F.lit("text/html")), ("content-length", size), ("date", at), ("etag", tag)
    )
    short = headers(
        ("content-length", F.lit("0")),
        ("date", (F.col("page_id") + lag).cast("string")),
        ("expires", (F.col("page_id") + 2 * lag).cast("string")),
        ("etag", tag),
    )
    base = docs.select("page_id", "url", "html").withColumns(
        {"etag": tag, "last_modified": date, "record_id": F.col("page_id")}
    )
    responses = base.withColumns({"kind": F.lit("response"), "ts": F.col("page_id"), "headers": full})
    revisits = base.withColumns(
        {"kind": F.lit("revisit"), "ts": F.col("page_id") + lag, "headers": short}
    )
    return responses.select(*fields).unionByName(revisits.select(*fields))


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = stored(sample_captures(pages(spark, sf_dir)), "captures")
    entries = F.array_sort(F.map_entries("headers"))
    text = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return (
        resolve_revisits(captures)
        .withColumn("headers", F.array_join(text, "\n"))
        .withColumnRenamed("record_id", "page_id")
    )


OP5_SQL = r"""
WITH c AS (
  SELECT page_id, url, html,
    lower(regexp_extract(u, '^([^/?]*)', 1)) AS h, regexp_extract(u, '^[^/?]*([^?]*)', 1) AS p,
    regexp_extract(u, '\?(.*)$', 1, 's') AS q
  FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', '', 's'),
    '^[a-z][a-z0-9+.-]*://', '', 'i') AS u FROM pages)
), n AS (
  SELECT page_id, html, CASE WHEN contains(url, '?') THEN NULL ELSE md5(html) END AS etag,
    CASE WHEN contains(url, '?') THEN html END AS dated,
    list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT
      regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid)(=|$)', 'i'))) AS kept,
    regexp_replace(regexp_replace(h, ':(80|443)$', ''), '^www\d*\.', '') || regexp_replace(p, '/+$', '')
      || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical
  FROM c
), m AS (
  SELECT v.page_id, v.canonical, v.page_id + 1000 AS ts, v.etag, v.dated, max(r.page_id) AS response_id
  FROM n v LEFT JOIN n r ON v.canonical = r.canonical AND r.page_id < v.page_id + 1000
  GROUP BY ALL
), j AS (
  SELECT m.*, r.html, r.etag AS r_etag,
    coalesce(m.etag = r.etag, m.dated = r.dated, false) AS same
  FROM m LEFT JOIN n r ON m.response_id = r.page_id
)
SELECT page_id, canonical, ts, response_id, response_id AS response_ts,
  CASE WHEN response_id IS NULL THEN 'unknown' WHEN same THEN 'resolved' ELSE 'changed' END AS outcome,
  CASE WHEN same THEN 'content-length: ' || length(html) || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || ts || chr(10) || coalesce('etag: ' || coalesce(etag, r_etag) || chr(10), '')
    || 'expires: ' || (ts + 1000)
  ELSE 'content-length: 0' || chr(10) || 'date: ' || ts || chr(10)
    || coalesce('etag: ' || etag || chr(10), '') || 'expires: ' || (ts + 1000) END AS headers
FROM j
"""
