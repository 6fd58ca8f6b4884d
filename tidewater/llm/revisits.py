"""Not-modified revisit resolution for web archives.

A ``revisit`` record says that a URL's content had not changed; it has headers but no body.  An as-of join by canonical
URL finds the latest full response captured before it; validators are compared, and the headers of the 304 that may
update a stored response are merged into that response's.

The as-of join has two levels: captures of a URL fall into buckets of ``BUCKET_S`` seconds.  Each bucket is sorted by
itself, and takes from the buckets before it, of which there is a row each, the last response there was.  A URL with a
third of all captures is thereby dealt out by time, and no join pairs captures.  Bodies aren't moved: a resolved revisit
refers to its response by record id.

Defined results for odd input: a null URL never resolves; responses at the same instant as a revisit aren't earlier;
of responses at one instant the greater record id is the later; null headers are none; a null time sorts before all
others and resolves nothing; repeated rows are captures of their own; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.text import only

BUCKET_S = 3600
#: Header fields of a 304 that don't update the stored response (hop-by-hop fields, and those that describe a body).
NOT_MERGED = ("connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade", "content-encoding", "content-length", "content-range", "content-type", "set-cookie")
#: Patterns that take a URL to its canonical form, in this order.
CANONICAL = (
    (r"#.*$", ""),
    (r"^[a-z]+://", ""),
    (r"^www\.", ""),
    (r"^([^/?]*):(?:80|443)(?=[/?]|$)", r"$1"),
    (r"([?&])(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*", r"$1"),
    (r"&&+", "&"),
    (r"\?&", "?"),
    (r"[?&]+$", ""),
    (r"/(?:index\.html?)?(?=$|\?)", ""),
)


def canonical_url(url: Column) -> Column:
    """Scheme, www, default ports, fragments, tracking parameters and last slashes don't make another URL; the host's case doesn't."""
    out = F.concat(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z]+://)?[^/?#]*", 0)), F.regexp_replace(url, r"^(?:[A-Za-z]+://)?[^/?#]*", ""))
    for pattern, to in CANONICAL:
        out = F.regexp_replace(out, pattern, to)
    return out


def opaque(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def resolve(records: DataFrame, bucket_s: int = BUCKET_S) -> DataFrame:
    """From record_id, kind ('response' or 'revisit'), url, ts and headers (map of lower-case names) to one row per revisit.

    Columns: record_id, canonical_url, refers_to (the response's record_id), outcome ('resolved', 'validator mismatch',
    'no validator' or 'no earlier response') and headers (the merged ones if resolved, else the revisit's own).
    """
    df = only(records, "record_id", "kind", "url", "ts", "headers")
    df = df.withColumn("canonical_url", canonical_url(F.col("url"))).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    df = df.withColumn("bucket", F.floor(F.col("at") / (bucket_s * 1_000_000)))
    # Records without a URL or a time meet no others.
    df = df.withColumn("key", F.when(F.col("canonical_url").isNotNull() & F.col("at").isNotNull(), F.concat(F.lit("u:"), "canonical_url")).otherwise(F.concat(F.lit("r:"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))))
    full = F.when((F.col("kind") == "response") & F.col("at").isNotNull() & F.col("url").isNotNull(), F.struct("at", "record_id", F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified"), F.map_entries("headers").alias("entries")))
    df = df.withColumn("full", full)
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = df.groupBy("key", "bucket").agg(F.max("full").alias("last")).withColumn("carried", F.max("last").over(earlier))
    last = last.select(F.col("key").alias("k2"), F.col("bucket").alias("b2"), "carried")
    within = Window.partitionBy("key", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("near", F.max("full").over(within)).filter(F.col("kind") == "revisit")
    df = df.join(last, (F.col("key") == F.col("k2")) & F.col("bucket").eqNullSafe(F.col("b2")), "left")
    df = df.withColumn("found", F.coalesce("near", "carried"))
    tags = F.col("headers")["etag"].isNotNull() & F.col("found.etag").isNotNull()
    dates = F.col("headers")["last-modified"].isNotNull() & F.col("found.modified").isNotNull()
    outcome = (
        F.when(F.col("found").isNull(), "no earlier response")
        .when(tags, F.when(opaque(F.col("headers")["etag"]) == opaque(F.col("found.etag")), "resolved").otherwise("validator mismatch"))
        .when(dates, F.when(F.col("headers")["last-modified"] == F.col("found.modified"), "resolved").otherwise("validator mismatch"))
        .otherwise("no validator")
    )
    df = df.withColumn("outcome", outcome)
    new = F.map_filter("headers", lambda k, v: ~F.lower(k).isin(*NOT_MERGED))
    stored = F.map_from_entries(F.col("found.entries"))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
    headers = F.when((F.col("outcome") == "resolved") & stored.isNotNull() & F.col("headers").isNotNull(), merged).otherwise(F.col("headers"))
    refers = F.when(F.col("outcome") == "resolved", F.col("found.record_id"))
    return df.select("record_id", "canonical_url", refers.alias("refers_to"), "outcome", headers.alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """An archive of a page table: each page as a response, a minute after the one before, and a revisit of its URL a day and a half later.

    A third of the revisits carries an entity tag, a third a date and a third no validator.
    """
    pages = only(pages, "page_id", "url", "html")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    tag, date = F.md5(F.coalesce("html", F.lit(""))), at.cast("string")
    n = F.length(F.coalesce("html", F.lit(""))).cast("string")
    full = F.create_map(F.lit("etag"), F.concat(F.lit('"'), tag, F.lit('"')), F.lit("last-modified"), date, F.lit("content-length"), n, F.lit("cache-control"), F.lit("max-age=60"))
    again = F.create_map(F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-length"), F.lit("0"))
    which = F.pmod("page_id", F.lit(3))
    again = F.when(which == 0, F.map_concat(again, F.create_map(F.lit("etag"), F.concat(F.lit('W/"'), tag, F.lit('"'))))).when(which == 1, F.map_concat(again, F.create_map(F.lit("last-modified"), date))).otherwise(again)
    rows = F.array(
        F.struct((F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), at.alias("ts"), full.alias("headers")),
        F.struct((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60 + 129_600).alias("ts"), again.alias("headers")),
    )
    return pages.select("url", F.explode(rows).alias("r")).select("r.record_id", "r.kind", "url", "r.ts", "r.headers")


def _canonical_sql() -> str:
    out = r"lower(regexp_extract(url, '^(?:[A-Za-z]+://)?[^/?#]*')) || regexp_replace(url, '^(?:[A-Za-z]+://)?[^/?#]*', '')"
    for pattern, to in CANONICAL:
        # RE2 has no look-ahead: what it would see is put back.
        if "(?=[/?]|$)" in pattern:
            pattern, to = pattern.replace("(?=[/?]|$)", "([/?]|$)"), r"\1\2"
        elif "(?=$|\\?)" in pattern:
            pattern, to = pattern.replace("(?=$|\\?)", "($|\\?)"), r"\1"
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    return out


ORACLE = f"""
WITH base AS (
  SELECT page_id, {_canonical_sql()} AS canonical_url, md5(coalesce(html, '')) AS tag, length(coalesce(html, '')) AS n,
    1700000000 + page_id * 60 AS t, strftime(make_timestamp((1700000000 + page_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS date
  FROM pages),
met AS (
  SELECT r.*, r.t + 129600 AS at, f.page_id AS f_page, f.tag AS f_tag, f.date AS f_date, f.n AS f_n,
    row_number() OVER (PARTITION BY r.page_id ORDER BY f.t DESC, f.page_id DESC) AS k
  FROM base r LEFT JOIN base f ON f.canonical_url = r.canonical_url AND f.t < r.t + 129600),
told AS (
  SELECT *, CASE WHEN f_page IS NULL THEN 'no earlier response'
    WHEN page_id % 3 = 0 THEN CASE WHEN tag = f_tag THEN 'resolved' ELSE 'validator mismatch' END
    WHEN page_id % 3 = 1 THEN CASE WHEN date = f_date THEN 'resolved' ELSE 'validator mismatch' END
    ELSE 'no validator' END AS outcome
  FROM met WHERE k = 1)
SELECT page_id * 2 + 1 AS record_id, canonical_url, CASE WHEN outcome = 'resolved' THEN f_page * 2 END AS refers_to, outcome,
  CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=120;content-length=' || f_n || ';etag=' || CASE WHEN page_id % 3 = 0 THEN 'W/"' || tag || '"' ELSE '"' || f_tag || '"' END || ';last-modified=' || CASE WHEN page_id % 3 = 1 THEN date ELSE f_date END
    ELSE 'cache-control=max-age=120;content-length=0' || CASE WHEN page_id % 3 = 0 THEN ';etag=W/"' || tag || '"' WHEN page_id % 3 = 1 THEN ';last-modified=' || date ELSE '' END END AS headers
FROM told
"""
