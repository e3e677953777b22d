"""URL filters as a temporal list join, in DataFrame functions only.

A list entry is a dated action on a pattern: from that day on the pattern (a host, a domain above it, or host and first path part) is listed or no longer listed. The next entry of the same list and pattern ends it, so entries become validity intervals. A capture is judged by what was active when it was fetched: per list and key of its URL, the latest entry not after the fetch decides (an as-of join), and the capture is blocked when any list then blocks one of its keys.

The as-of join is an equi-join on (key, period): an interval is laid out over the periods (``PERIOD_DAYS`` days) that it touches within the span of the captures, so a capture meets only the entries of its own period, a hot host is spread over all its periods, and no window runs over a host's captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

PERIOD_DAYS = 30
EPOCH = "2024-01-01"


def url_host(url: Column) -> Column:
    """The lower-cased host of a URL, without user, port and a closing dot; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*[^/?#:@.])", 1))


def url_keys(url: Column) -> Column:
    """The patterns that a URL can meet: its host, every domain above it with at least two labels, and host/first path part; distinct, empty for a URL without host."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)), lambda i: F.array_join(F.slice(labels, i, F.greatest(F.lit(0), n - i + 1)), "."))
    first = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", 1)
    with_path = F.when(first != "", F.array(F.concat(host, F.lit("/"), first))).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(above, with_path)))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list_name, pattern, action, valid_from, valid_to) from dated entries (list_name, pattern, day, action).

    Rows with a null are ignored. Patterns are taken as they are: hosts in lower case. Several entries of one list and pattern on one day count as one, the greatest action; an entry that repeats the action before it is kept as an interval of its own. The last interval is open: its valid_to is null.
    """
    dated = entries.select("list_name", "pattern", F.col("day").cast("date").alias("day"), "action").dropna()
    one = dated.groupBy("list_name", "pattern", "day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list_name", "pattern").orderBy("day")
    return one.select("list_name", "pattern", "action", F.col("day").alias("valid_from"), F.lead("day").over(order).alias("valid_to"))


def filter_urls(captures: DataFrame, entries: DataFrame, *, id_col: str = "page_id", url_col: str = "url", fetched_col: str = "fetched", period_days: int = PERIOD_DAYS) -> DataFrame:
    """One row per row of ``captures``: page_id, fetched, host, n_active (entries active for its keys), blocked, blocking (sorted ``list_name:pattern`` that block).

    ``entries`` has list_name, pattern, day, action ('block' or 'allow'). An ``allow`` ends a ``block`` of the same list and pattern and blocks nothing. A null URL or date, or a URL without host, meets no entry. Rows that repeat are each judged. Only the named columns are read.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(fetched_col).cast("date").alias("fetched")).withColumn("row", F.monotonically_increasing_id())
    period = lambda day: F.floor(F.datediff(day, F.lit(EPOCH).cast("date")) / period_days)
    keyed = rows.withColumn("period", period(F.col("fetched"))).withColumn("key", F.explode_outer(url_keys(F.col("url"))))
    span = captures.agg(F.min(F.col(fetched_col).cast("date")).alias("first"), F.max(F.col(fetched_col).cast("date")).alias("last"))
    spans = validity(entries).join(F.broadcast(span))  # one row
    low = period(F.greatest("valid_from", "first"))
    high = period(F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("last")), F.col("last")))
    laid = spans.withColumn("period", F.explode(F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<bigint>"))))
    laid = laid.select(F.col("pattern").alias("of"), F.col("period").alias("in_period"), "list_name", "action", "valid_from", "valid_to")
    # The row number only tells the keys of one row from those of another, so it is made and used on one path.
    active = keyed.join(laid, (F.col("key") == F.col("of")) & (F.col("period") == F.col("in_period")) & (F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))), "left")
    blocks = F.coalesce(F.col("action") == "block", F.lit(False))
    verdict = active.groupBy("row", "page_id", "url", "fetched").agg(F.count("of").alias("n_active"), F.max(blocks).alias("blocked"), F.array_sort(F.collect_set(F.when(blocks, F.concat_ws(":", "list_name", "of")))).alias("blocking"))
    return verdict.select("page_id", "fetched", url_host(F.col("url")).alias("host"), "n_active", "blocked", F.array_join("blocking", ",").alias("blocking"))


def _digits(key: Column, start: int) -> Column:
    """A number below 65536 from four hexadecimal digits of the key's MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), start, 4), 16, 10).cast("int")


def list_entries(captures: DataFrame, url_col: str = "url") -> DataFrame:
    """The dated entries of the query: two lists over the patterns that occur, with days and actions from digests.

    List ``ads`` lists a fifth of the patterns and delists a half of those again; list ``abuse`` lists a tenth, delists and lists again.
    """
    keys = captures.select(F.explode(url_keys(F.col(url_col))).alias("pattern")).distinct()
    at = lambda start, most, plus=0: F.expr(f"date '{EPOCH}'") + (F.lit(plus) + _digits(F.col("pattern"), start) % most)
    entry = lambda name, day, action: F.struct(F.lit(name).alias("list_name"), day.alias("day"), F.lit(action).alias("action"))
    none = F.array().cast("array<struct<list_name:string,day:date,action:string>>")
    pick, again = _digits(F.col("pattern"), 1), _digits(F.col("pattern"), 5)
    rows = F.concat(
        F.when(pick % 5 == 0, F.array(entry("ads", at(9, 200), "block"))).otherwise(none),
        F.when((pick % 5 == 0) & (again % 2 == 0), F.array(entry("ads", at(13, 150, 200), "allow"))).otherwise(none),
        F.when(pick % 10 == 1, F.array(entry("abuse", at(17, 100), "block"), entry("abuse", at(21, 100, 100), "allow"), entry("abuse", at(25, 165, 200), "block"))).otherwise(none),
    )
    return keys.select("pattern", F.explode(rows).alias("e")).select("e.list_name", "pattern", "e.day", "e.action")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is a capture fetched on day ``page_id mod 366`` of 2024, judged by the lists as of that day."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.expr(f"date_add(date '{EPOCH}', cast(pmod(page_id, 366) as int))").alias("fetched"))
    return filter_urls(pages, list_entries(pages))


QUERIES = {"op7_url_filter": op7_url_filter}
ORACLES = {
    "op7_url_filter": """
WITH pages_at AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:@]*[^/?#:@.])', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*/([^/?#]+)', 1) AS first_part
  FROM pages
),
labels AS (SELECT *, string_split(host, '.') AS parts FROM pages_at WHERE host <> ''),
keyed AS (
  SELECT page_id, fetched, unnest(list_distinct(
           list_concat([array_to_string(parts[i:len(parts)], '.') FOR i IN range(1, greatest(2, len(parts)))],
                       CASE WHEN first_part <> '' THEN [host || '/' || first_part] ELSE [] END))) AS key
  FROM labels
),
patterns AS (
  SELECT DISTINCT key AS pattern, md5(key) AS m FROM keyed
),
numbers AS (
  SELECT pattern, [CAST('0x' || substr(m, s, 4) AS INTEGER) FOR s IN [1, 5, 9, 13, 17, 21, 25]] AS d FROM patterns
),
entries AS (
  SELECT 'ads' AS list_name, pattern, DATE '2024-01-01' + d[3] % 200 AS day, 'block' AS action FROM numbers WHERE d[1] % 5 = 0
  UNION ALL SELECT 'ads', pattern, DATE '2024-01-01' + (200 + d[4] % 150), 'allow' FROM numbers WHERE d[1] % 5 = 0 AND d[2] % 2 = 0
  UNION ALL SELECT 'abuse', pattern, DATE '2024-01-01' + d[5] % 100, 'block' FROM numbers WHERE d[1] % 10 = 1
  UNION ALL SELECT 'abuse', pattern, DATE '2024-01-01' + (100 + d[6] % 100), 'allow' FROM numbers WHERE d[1] % 10 = 1
  UNION ALL SELECT 'abuse', pattern, DATE '2024-01-01' + (200 + d[7] % 165), 'block' FROM numbers WHERE d[1] % 10 = 1
),
one AS (SELECT list_name, pattern, day, max(action) AS action FROM entries GROUP BY 1, 2, 3),
spans AS (SELECT *, lead(day) OVER (PARTITION BY list_name, pattern ORDER BY day) AS until FROM one),
active AS (
  SELECT k.page_id, s.list_name, s.pattern, s.action
  FROM keyed k JOIN spans s ON k.key = s.pattern AND k.fetched >= s.day AND (s.until IS NULL OR k.fetched < s.until)
),
verdict AS (
  SELECT page_id, count(*) AS n_active, bool_or(action = 'block') AS blocked,
         array_to_string(list_sort(list_distinct(list(list_name || ':' || pattern) FILTER (action = 'block'))), ',') AS blocking
  FROM active GROUP BY 1
)
SELECT p.page_id, p.fetched, p.host, coalesce(v.n_active, 0) AS n_active, coalesce(v.blocked, false) AS blocked, coalesce(v.blocking, '') AS blocking
FROM pages_at p LEFT JOIN verdict v USING (page_id)
"""
}
