"""URL filters as a temporal join with dated lists.

List entries are dated events: a pattern is added to a list or removed from
it. Events become validity intervals, from an addition's date to the next
event's date of the same pattern and list. A capture is held against the
entries that were active on the date of its fetch: its host, each domain above
it, and its host with the first path part are looked up among the intervals
that contain that date. The most specific entry decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import table

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PART = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)"


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, pattern, since, until`` from events ``list, kind, pattern,
    day, action`` ('add' or 'remove'); ``until`` is exclusive, null if open.

    Of events of one entry on one day a removal wins. The window holds one row
    per entry and day, so no entry's events outgrow the calendar. Events with a
    null in any column are left out."""
    events = (entries.select("list", "kind", "pattern", "day", "action").na.drop()
              .groupBy("list", "kind", "pattern", "day").agg(F.max("action").alias("action")))
    following = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    return (events.withColumn("until", F.lead("day").over(following)).where("action = 'add'")
            .select("list", "kind", "pattern", F.col("day").alias("since"), "until"))


def with_site(captures: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (lower case, '' if there is none) and ``part`` (first path part)."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    return captures.withColumn("host", F.lower(F.regexp_extract(url, HOST, 1))).withColumn(
        "part", F.regexp_extract(url, PART, 1))


def active_entries(sites: DataFrame, spans: DataFrame) -> DataFrame:
    """All entries active for each distinct ``host, part, day`` of ``sites``:
    adds ``list, kind, pattern, since, rank`` (higher: more specific).

    The as-of join runs on distinct (pattern, day), so a host with a third of all
    captures is looked up once per day."""
    sites = sites.select("host", "part", "day").where("host <> '' AND day IS NOT NULL").distinct()
    labels = F.split("host", r"\.")
    # every domain of two labels or more, the host itself among them
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.struct(F.lit("domain").alias("kind"),
                                             F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"),
                                             (F.size(labels) - i + 1).alias("rank")))
    asked = F.concat(F.array(
        F.struct(F.lit("prefix").alias("kind"), F.concat_ws("/", "host", "part").alias("pattern"), F.lit(1000).alias("rank")),
        F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern"), F.lit(999).alias("rank"))), domains)
    probes = sites.select("host", "part", "day", F.explode(asked).alias("p")).select("host", "part", "day", "p.*")
    asked_once = probes.select("kind", "pattern", "day").distinct()
    active = (asked_once.join(spans, ["kind", "pattern"])
              .where((F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))))
    return probes.join(active, ["kind", "pattern", "day"])


def url_filters(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                day_col: str = "fetch_day") -> DataFrame:
    """``page_id, url, host, fetch_day, active_entries, list, kind, pattern,
    active_since, blocked`` for every capture.

    The most specific active entry decides (host and first path part, host,
    longer domain, shorter domain; of equal ones 'allow', then the earliest);
    without any the capture isn't blocked. Null or malformed urls and null days
    match nothing; repeated rows keep rows of their own; extra columns are not
    carried; empty tables give an empty result or no match."""
    rows = with_site(captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                                     F.col(day_col).cast("date").alias("day")))
    found = active_entries(rows, intervals(entries))
    best = F.min(F.struct((-F.col("rank")).alias("rank"), "list", "since", "kind", "pattern"))
    verdict = found.groupBy("host", "part", "day").agg(F.count("*").alias("active_entries"), best.alias("best"))
    return (rows.join(verdict, ["host", "part", "day"], "left")
            .select("page_id", "url", "host", F.col("day").cast("string").alias("fetch_day"),
                    F.coalesce("active_entries", F.lit(0)).cast("long").alias("active_entries"),
                    "best.list", "best.kind", "best.pattern",
                    F.col("best.since").cast("string").alias("active_since"),
                    F.coalesce(F.col("best.list") == "block", F.lit(False)).alias("blocked")))


# The given pages have no fetch dates and there are no lists. Both are derived
# from the pages by digests: a fetch date per page, dated events per site.
_DAYS = "SELECT page_id, url, DATE'2024-01-01' + {page} % 365 AS fetch_day FROM pages"
_EVENTS = """
SELECT list, kind, pattern, DATE'2024-01-01' + day AS day, action FROM (
  SELECT 'block' AS list, 'domain' AS kind, domain AS pattern, {d} % 250 AS day, 'add' AS action FROM names WHERE {d} % 3 = 0
  UNION ALL SELECT 'block', 'domain', domain, {d} % 250 + 20 + {d} % 90, 'remove' FROM names WHERE {d} % 6 = 0
  UNION ALL SELECT 'block', 'domain', domain, {d} % 250 + 130, 'add' FROM names WHERE {d} % 12 = 0
  UNION ALL SELECT 'allow', 'host', host, {h} % 200, 'add' FROM names WHERE {h} % 4 = 0
  UNION ALL SELECT 'allow', 'host', host, {h} % 200 + 30 + {h} % 60, 'remove' FROM names WHERE {h} % 8 = 0
  UNION ALL SELECT 'block', 'host', host, {h} % 200 + 40, 'add' FROM names WHERE {h} % 7 = 0
  UNION ALL SELECT 'block', 'prefix', host || '/' || part, {p} % 300, 'add' FROM names WHERE {p} % 5 = 0
  UNION ALL SELECT 'block', 'prefix', host || '/' || part, {p} % 300 + 45, 'remove' FROM names WHERE {p} % 10 = 0
) AS events"""
_NUMBER = {"spark": "CAST(conv(substr(md5({}), 1, 6), 16, 10) AS INT)",
           "duckdb": "CAST(CAST('0x' || substr(md5({}), 1, 6) AS INTEGER) AS INTEGER)"}


def _filled(sql: str, dialect: str) -> str:
    n = _NUMBER[dialect].format
    return sql.format(page=n("CAST(page_id AS VARCHAR(20))"), d=n("domain || '#'"), h=n("host || '+'"),
                      p=n("host || '/' || part"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = spark.sql(_filled(_DAYS, "spark").replace("FROM pages", "FROM {pages}"), pages=pages)
    names = (with_site(pages).where("host <> ''").select("host", "part").distinct()
             .withColumn("domain", F.substring_index("host", ".", -3)))
    events = spark.sql(_filled(_EVENTS, "spark").replace("FROM names", "FROM {names}"), names=names)
    return url_filters(captures, events)


OP10_SQL = f"""
WITH sites AS (
  SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
         regexp_extract(coalesce(url, ''), '{PART}', 1) AS part FROM pages),
names AS (
  SELECT DISTINCT host, part, array_to_string(list_slice(string_split(host, '.'), greatest(1, len(string_split(host, '.')) - 2),
         len(string_split(host, '.'))), '.') AS domain FROM sites WHERE host <> ''),
events AS ({_filled(_EVENTS, "duckdb")}),
once AS (SELECT list, kind, pattern, day, max(action) AS action FROM events GROUP BY ALL),
spans AS (
  SELECT * FROM (SELECT list, kind, pattern, action, day AS since,
                        lead(day) OVER (PARTITION BY list, kind, pattern ORDER BY day) AS until FROM once)
  WHERE action = 'add'),
captures AS (
  SELECT s.page_id, s.url, s.host, s.part, d.fetch_day AS day, row_number() OVER () AS n
  FROM sites s JOIN ({_filled(_DAYS, "duckdb")}) d ON s.page_id = d.page_id AND s.url IS NOT DISTINCT FROM d.url),
hits AS (
  SELECT c.n, s.list, s.kind, s.pattern, s.since,
         CASE s.kind WHEN 'prefix' THEN 1000 WHEN 'host' THEN 999 ELSE len(string_split(s.pattern, '.')) END AS rank
  FROM captures c JOIN spans s ON s.since <= c.day AND (s.until IS NULL OR c.day < s.until)
   AND CASE s.kind WHEN 'prefix' THEN s.pattern = c.host || '/' || c.part WHEN 'host' THEN s.pattern = c.host
       ELSE s.pattern = c.host OR ends_with(c.host, '.' || s.pattern) END),
best AS (
  SELECT n, count(*) AS active_entries, arg_min({{'l': list, 'k': kind, 'p': pattern, 's': since}},
         {{'r': -rank, 'l': list, 's': since, 'k': kind, 'p': pattern}}) AS b FROM hits GROUP BY n)
SELECT page_id, url, host, CAST(day AS VARCHAR) AS fetch_day, coalesce(active_entries, 0) AS active_entries,
       b.l AS list, b.k AS kind, b.p AS pattern, CAST(b.s AS VARCHAR) AS active_since,
       coalesce(b.l = 'block', false) AS blocked
FROM captures LEFT JOIN best USING (n)"""
