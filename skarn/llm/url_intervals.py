"""URL filters by a temporal list join, in DataFrame operations only.

A list's dated entries, (pattern, action, at), add or remove a pattern. They become validity intervals: a pattern is
active from an ``add`` to the next ``remove``, with repeated adds and removes changing nothing. A pattern is a host
suffix (``example.com`` covers its subdomains) or a host with a path prefix ending in ``/``. Each capture is evaluated as
of its fetch time: its host's suffixes and its URL's path prefixes are looked up by equality, and an interval holds if
``start <= fetched < end``.

An entry and a capture meet in an equi-join on the pattern, which the planner splits where one host holds a large share
of the captures. A capture's own keys number at most its labels and path segments, and their matches are combined by a
grouping on the capture alone.

Defined results: a null or unparsable URL and a null fetch time match nothing. Entries with a null pattern, action or
date are ignored; of entries with the same date, a remove counts last. Hosts compare in lower case without a trailing dot,
user and port; a leading ``www.`` is a label like others. Repeated captures stay rows of their own. Empty lists and empty
captures give empty matches. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Host in lower case; empty if the URL has none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"\.$", "")


def keys_of(url: Column) -> Column:
    """All patterns that would cover the URL: suffixes of its host and its path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    parts = F.split(path, "/")
    prefixes = F.transform(F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: i < F.size(parts)), lambda i: F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    return F.when(F.length(host) > 0, F.array_distinct(F.concat(suffixes, prefixes))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, start, end) from (pattern, action, at); an open interval has a null end."""
    dated = entries.where("pattern is not null and action in ('add', 'remove') and at is not null").select(F.lower("pattern").alias("pattern"), (F.col("action") == "add").alias("adds"), "at").distinct()
    settled = dated.groupBy("pattern", "at").agg(F.every("adds").alias("adds"))  # a remove on the same date counts last
    by = Window.partitionBy("pattern").orderBy("at")
    changes = settled.withColumn("was", F.coalesce(F.lag("adds").over(by), F.lit(False))).where("adds <> was")
    return changes.withColumn("end", F.lead("at").over(by)).where("adds").select("pattern", F.col("at").alias("start"), "end")


def matches(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Every capture with blocked and the active patterns that cover it, the most specific (longest) first."""
    own = captures.select(F.col(id_col).alias("capture"), F.col(url).alias("url"), F.col(fetched).alias("fetched"))
    asked = own.where("url is not null and fetched is not null").select("url", "fetched").distinct()
    asked = asked.select("url", "fetched", F.explode(keys_of(F.col("url"))).alias("pattern"))
    active = asked.join(intervals(entries), "pattern").where("start <= fetched and (end is null or fetched < end)")
    found = active.groupBy("url", "fetched").agg(F.array_sort(F.collect_set(F.struct((-F.length("pattern")).alias("n"), "pattern", "start"))).alias("hits"))
    joined = own.join(found, ["url", "fetched"], "left")
    return joined.select(
        F.col("capture").alias(id_col),
        host_of(F.coalesce("url", F.lit(""))).alias("host"),
        "fetched",
        F.col("hits").isNotNull().alias("blocked"),
        F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits")).cast("long").alias("n_patterns"),
        F.get("hits", F.lit(0))["pattern"].alias("pattern"),
        F.get("hits", F.lit(0))["start"].alias("since"),
    )


#: The query on the pages table, in DuckDB's SQL.
SQL = r"""
WITH own AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched,
    regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', '') AS host,
    regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
hosts AS (
  SELECT DISTINCT host, (length(host) * 37 + ascii(host) * 13) % 240 AS d, length(host) % 3 AS k FROM own WHERE host <> ''),
entries AS (
  SELECT host AS pattern, 'add' AS action, d AS day FROM hosts WHERE k = 0
  UNION ALL SELECT host, 'remove', d + 60 FROM hosts WHERE k = 0
  UNION ALL SELECT host, 'add', d + 120 FROM hosts WHERE k = 0
  UNION ALL SELECT host || '/en/', 'add', d FROM hosts WHERE k = 1
  UNION ALL SELECT host || '/en/', 'remove', d + 30 FROM hosts WHERE k = 1
  UNION ALL SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1), 'add', 300 FROM hosts WHERE k = 2),
settled AS (
  SELECT pattern, DATE '2024-01-01' + CAST(day AS INTEGER) AS day, bool_and(action = 'add') AS adds FROM entries WHERE pattern <> '' GROUP BY ALL),
changes AS (
  SELECT * FROM (SELECT *, coalesce(lag(adds) OVER (PARTITION BY pattern ORDER BY day), false) AS was FROM settled) WHERE adds <> was),
intervals AS (
  SELECT * FROM (SELECT pattern, day AS start, adds, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS "end" FROM changes) WHERE adds),
keys AS (
  SELECT page_id, fetched, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS pattern
  FROM own, unnest(range(1, 1 + len(string_split(host, '.')))) AS t(i) WHERE host <> ''
  UNION
  SELECT page_id, fetched, host || array_to_string(list_slice(string_split(path, '/'), 1, i), '/') || '/'
  FROM own, unnest(range(1, len(string_split(path, '/')))) AS t(i) WHERE host <> ''),
hits AS (
  SELECT page_id, count(*) AS n, min(struct_pack(l := -length(k.pattern), p := k.pattern, s := i.start)) AS best
  FROM keys k JOIN intervals i ON k.pattern = i.pattern AND i.start <= fetched AND ("end" IS NULL OR fetched < "end") GROUP BY page_id)
SELECT page_id, host, CAST(fetched AS VARCHAR) AS fetched, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_patterns, best.p AS pattern, CAST(best.s AS VARCHAR) AS since
FROM own LEFT JOIN hits USING (page_id)
"""
