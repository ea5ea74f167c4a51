"""Not-modified revisit resolution for web captures (operator 1).

A capture is a full response or a revisit (status 304). For each revisit the
latest earlier full response with the same canonical URL is found (as-of join);
its validators are checked (entity tags by weak comparison, else Last-Modified,
else the payload digest), and the stored headers are updated with the headers
that a 304 response may replace.

Scale: a URL's history is cut into chunks of ``chunk_seconds``. Each chunk's
last response comes from a partial aggregate and is carried over to later
chunks; a window then works within one (URL, chunk), so that a URL with a large
share of all captures is spread over many tasks. Bodies are never moved.

Defined cases: a null or blank URL gives ``no_url``; a null time has no earlier
response; earlier means strictly earlier; of responses at the same time the one
with the largest record id counts; ``no_response`` if there is none,
``not_matched`` if the validators differ, ``no_validator`` if the two have none in
common, else ``resolved``; captures that repeat each get a row; headers of an
unresolved revisit stay its own; null headers count as none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.llm.common import table

# The header fields that a 304 response carries for an update (RFC 9110, section 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www``, default port, fragment, tracking fields and last slash; host in lower case, query fields sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    fields = F.array_sort(F.filter(F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&"), lambda x: (x != "") & ~x.rlike("^utm_")))
    out = F.concat(host, path, F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise(""))
    return F.when(host != "", out)


def _header(headers: str, name: str) -> Column:
    return F.get(F.filter(F.col(headers), lambda h: h["name"] == name), F.lit(0))["value"]


def resolve_revisits(captures: DataFrame, chunk_seconds: int = 86_400) -> DataFrame:
    """A row for each revisit of ``captures`` (record_id, url, time, is_revisit, digest, headers array<struct<name,value>>)."""
    empty = F.array().cast("array<struct<name:string,value:string>>")
    rows = captures.select(
        "record_id", canonical_url(F.col("url")).alias("url"), F.unix_micros(F.col("time").cast("timestamp")).alias("t"),
        F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"), "digest",
        F.array_sort(F.transform(F.coalesce(F.col("headers").cast("array<struct<name:string,value:string>>"), empty),
                                 lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value")))).alias("headers"))
    rows = rows.withColumn("chunk", F.floor(F.col("t") / (chunk_seconds * 1_000_000)))
    response = F.when(~F.col("is_revisit") & F.col("t").isNotNull(), F.struct("t", "record_id", "digest", "headers"))
    findable = rows.filter("url is not null and t is not null")
    chunks = findable.groupBy("url", "chunk").agg(F.max(response).alias("last"), F.max("is_revisit").alias("wanted"))
    before = Window.partitionBy("url").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (chunks.withColumn("last", F.max("last").over(before)).filter("wanted and last is not null")
               .select("url", "chunk", F.col("last.t").alias("t"), F.lit(None).cast(rows.schema["record_id"].dataType).alias("record_id"),
                       F.lit(None).cast("string").alias("digest"), F.lit(None).cast(rows.schema["headers"].dataType).alias("headers"),
                       F.lit(False).alias("is_revisit"), F.col("last").alias("response")))
    own = findable.select("url", "chunk", "t", "record_id", "digest", "headers", "is_revisit", response.alias("response"))
    earlier = Window.partitionBy("url", "chunk").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    found = own.unionByName(carried).withColumn("response", F.max("response").over(earlier)).filter("is_revisit")
    rest = (rows.filter("is_revisit and (url is null or t is null)")
            .select("url", "chunk", "t", "record_id", "digest", "headers", "is_revisit", F.lit(None).cast(found.schema["response"].dataType).alias("response")))
    found = found.unionByName(rest).withColumn("old", F.col("response.headers"))

    tag = lambda c: F.regexp_replace(_header(c, "etag"), "^W/", "")
    etags, dates = tag("headers") == tag("old"), _header("headers", "last-modified") == _header("old", "last-modified")
    digests = F.col("digest") == F.col("response.digest")
    validator = F.when(etags.isNotNull(), "etag").when(dates.isNotNull(), "last-modified").when(digests.isNotNull(), "digest")
    status = (F.when(F.col("url").isNull(), "no_url").when(F.col("response").isNull(), "no_response").when(validator.isNull(), "no_validator")
              .when(F.coalesce(etags, dates, digests), "resolved").otherwise("not_matched"))
    found = found.withColumn("validator", validator).withColumn("status", status)
    new = F.filter("headers", lambda h: h["name"].isin(PERMITTED))
    kept = F.filter("old", lambda h: ~F.array_contains(F.transform(new, lambda x: x["name"]), h["name"]))
    return found.select("record_id", F.col("url").alias("canonical_url"), "status", F.when(F.col("response").isNotNull(), F.col("validator")).alias("validator"),
                        F.when(F.col("status") == "resolved", F.col("response.record_id")).alias("refers_to"),
                        F.when(F.col("status") == "resolved", F.col("response.digest")).alias("payload_digest"),
                        F.when(F.col("status") == "resolved", F.array_sort(F.concat(kept, new))).otherwise(F.col("headers")).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Three captures of each page: its response and two later revisits, some with other validators.

    ``pages`` has neither times nor headers; they follow from page_id and the body.
    """
    p = F.col("page_id")
    k = F.col("k")
    at = lambda k: F.lit(1_704_067_200) + F.pmod(p * 7919, F.lit(2_592_000)) + k * (F.pmod(p, F.lit(11)) + 1) * 21_600
    rows = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    mark = F.concat(F.when(F.pmod(p, F.lit(5)) == 0, "W/").otherwise(""), F.lit('"'), F.substring("digest", 1, 12),
                    F.when((k == 2) & (F.pmod(p, F.lit(4)) == 0), "x").otherwise(""), F.lit('"'))
    day = lambda s: F.date_format(F.timestamp_seconds(s).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = [
        ("Cache-Control", F.concat(F.lit("max-age="), F.pmod(p, F.lit(100)) + k)), ("Content-Length", F.when(k == 0, F.lit("100")).otherwise("0")),
        ("Date", day(at(k))), ("ETag", F.when(F.pmod(p, F.lit(7)) > 0, mark)), ("Last-Modified", F.when(F.pmod(p, F.lit(3)) > 0, day(at(F.lit(0)) - 86_400))),
        ("Server", F.concat(F.lit("s"), k.cast("string"))),
    ]
    headers = F.filter(F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in fields]), lambda h: h["value"].isNotNull())
    return rows.select((p * 3 + k).alias("record_id"), "url", F.timestamp_seconds(at(k)).alias("time"), (k > 0).alias("is_revisit"),
                       F.when((k == 0) | (F.pmod(p, F.lit(2)) == 0), F.col("digest")).alias("digest"), headers.alias("headers"))


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures_of(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    return found.withColumn("headers", F.array_join(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])), "\n"))


_BARE = "regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
_HEADERS = """concat_ws(chr(10), CASE WHEN cc IS NOT NULL THEN 'cache-control: ' || cc END, CASE WHEN cl IS NOT NULL THEN 'content-length: ' || cl END,
 CASE WHEN dt IS NOT NULL THEN 'date: ' || dt END, CASE WHEN et IS NOT NULL THEN 'etag: ' || et END,
 CASE WHEN lm IS NOT NULL THEN 'last-modified: ' || lm END, CASE WHEN sv IS NOT NULL THEN 'server: ' || sv END)"""

SQL = {"op1_revisits": f"""
WITH b AS (SELECT page_id AS p, md5(coalesce(html, '')) AS body, {_BARE} AS bare, unnest([0, 1, 2]) AS k FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www[0-9]*[.]', ''), ':(80|443)$', '') AS host,
      regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
      list_sort([f FOR f IN string_split(regexp_extract(bare, '[?](.*)$', 1), '&') IF f <> '' AND NOT starts_with(f, 'utm_')]) AS fields,
      1704067200 + (p * 7919) % 2592000 + k * (p % 11 + 1) * 21600 AS s, 1704067200 + (p * 7919) % 2592000 - 86400 AS s0 FROM b),
r AS (SELECT p * 3 + k AS record_id, CASE WHEN host <> '' THEN host || path || CASE WHEN len(fields) > 0 THEN '?' || array_to_string(fields, '&') ELSE '' END END AS url,
      s, k > 0 AS rev, CASE WHEN k = 0 OR p % 2 = 0 THEN body END AS digest, 'max-age=' || (p % 100 + k) AS cc, CASE WHEN k = 0 THEN '100' ELSE '0' END AS cl,
      strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS dt,
      CASE WHEN p % 7 > 0 THEN CASE WHEN p % 5 = 0 THEN 'W/' ELSE '' END || '"' || substr(body, 1, 12) || CASE WHEN k = 2 AND p % 4 = 0 THEN 'x' ELSE '' END || '"' END AS et,
      CASE WHEN p % 3 > 0 THEN strftime(make_timestamp(s0 * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS lm, 's' || k AS sv FROM c),
full_ AS (SELECT * FROM r WHERE NOT rev QUALIFY row_number() OVER (PARTITION BY url, s ORDER BY record_id DESC) = 1),
j AS (SELECT r.*, q.record_id AS q_id, q.digest AS q_digest, q.cl AS q_cl, q.sv AS q_sv, q.cc AS q_cc, q.dt AS q_dt, q.et AS q_et, q.lm AS q_lm,
      regexp_replace(r.et, '^W/', '') = regexp_replace(q.et, '^W/', '') AS e, r.lm = q.lm AS l, r.digest = q.digest AS d
      FROM (SELECT * FROM r WHERE rev) r ASOF LEFT JOIN full_ q ON r.url = q.url AND r.s > q.s),
v AS (SELECT *, CASE WHEN e IS NOT NULL THEN 'etag' WHEN l IS NOT NULL THEN 'last-modified' WHEN d IS NOT NULL THEN 'digest' END AS validator FROM j),
w AS (SELECT *, CASE WHEN url IS NULL THEN 'no_url' WHEN q_id IS NULL THEN 'no_response' WHEN validator IS NULL THEN 'no_validator'
      WHEN coalesce(e, l, d) THEN 'resolved' ELSE 'not_matched' END AS status FROM v),
m AS (SELECT record_id, url, status, validator, q_id, q_digest, coalesce(cc, CASE WHEN status = 'resolved' THEN q_cc END) AS cc,
      CASE WHEN status = 'resolved' THEN q_cl ELSE cl END AS cl, dt, coalesce(et, CASE WHEN status = 'resolved' THEN q_et END) AS et,
      coalesce(lm, CASE WHEN status = 'resolved' THEN q_lm END) AS lm, CASE WHEN status = 'resolved' THEN q_sv ELSE sv END AS sv FROM w)
SELECT record_id, url AS canonical_url, status, validator, CASE WHEN status = 'resolved' THEN q_id END AS refers_to,
       CASE WHEN status = 'resolved' THEN q_digest END AS payload_digest, {_HEADERS} AS headers FROM m"""}
