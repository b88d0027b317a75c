"""URL filters by a temporal list join: dated entries become intervals, captures look up theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import row_struct, table
from tidewatch.sources.work import WorkTables

# How a URL is taken apart. Both engines read these patterns alike.
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)"
_MOST_LABELS = 6


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port and a leading ``www.``; NULL if none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    bare = F.regexp_replace(host, r"^www\.|\.$", "")
    return F.when(bare != "", bare)


def url_keys(url: Column, most_labels: int | None = _MOST_LABELS) -> Column:
    """What list entries may name: the host, its parent domains, and host + first path segment.

    Parent domains have two labels or more and, unless None is given, ``most_labels`` at
    most. ``filter_urls`` looks up all of them.
    """
    host = url_host(url)
    labels = F.split(host, r"\.")
    size = F.size(labels)
    most = size if most_labels is None else F.least(size, F.lit(most_labels))
    suffixes = F.transform(
        F.sequence(F.lit(2), most),
        lambda n: F.array_join(F.slice(labels, -n, n), "."))
    segment = F.regexp_extract(F.regexp_extract(url, _PATH, 1), r"^/([^/]+)", 1)
    prefix = F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment)))
    parents = F.when(size >= 2, suffixes).otherwise(F.array().cast("array<string>"))
    keys = F.concat(
        F.array(host), parents, F.coalesce(prefix, F.array().cast("array<string>")))
    return F.when(host.isNotNull(), F.array_distinct(keys)).otherwise(
        F.array().cast("array<string>"))


def entry_intervals(entries: DataFrame) -> DataFrame:
    """(list, key, from, until): when each entry was active, from dated ``add`` and ``remove`` rows.

    ``entries`` has list, key, day and action. An entry is active from the day of its add up
    to, not including, the day of the next remove. Of several actions on one day the remove
    counts; an add while active and a remove while inactive change nothing. Rows with a
    NULL, or with another action, are left out. Keys are read as ``url_keys`` makes them:
    hosts in any case, first segments in their own. Each (list, key) folds to one row a day
    before it is ordered, so its window is bounded by the calendar.
    """
    host = F.substring_index("key", "/", 1)
    segment = F.col("key").substr(F.char_length(host) + 1, F.char_length("key"))
    days = entries.filter(
        F.col("action").isin("add", "remove") & F.col("list").isNotNull()
        & F.col("key").isNotNull() & F.col("day").isNotNull()
    ).groupBy("list", F.concat(F.lower(host), segment).alias("key"), F.col("day").cast("date").alias("day")).agg(
        F.bool_and(F.col("action") == "add").alias("active"))
    order = Window.partitionBy("list", "key").orderBy("day")
    changes = days.withColumn("was", F.lag("active", 1, False).over(order)).filter(
        F.col("active") != F.col("was"))
    return changes.withColumn("until", F.lead("day").over(order)).filter("active").select(
        "list", "key", F.col("day").alias("from"), "until")


def active_lists(lookups: DataFrame, intervals: DataFrame) -> DataFrame:
    """(key, day, lists): the sorted lists active for each distinct (key, day) looked up.

    The as-of join: a key's interval starts and ends, and the days asked for, are put in
    one order, and a running sum per list says at each day what is active. A key has at
    most one row per list and day, so its window is bounded by the calendar, however many
    captures ask for it.
    """
    asked = lookups.select("key", "day").distinct()
    # Only keys that some entry names are ordered at all.
    named = intervals.select("key", "list").distinct()
    probes = asked.join(named, "key").select(
        "key", "list", "day", F.lit(0).alias("change"), F.lit(True).alias("probe"))
    starts = intervals.select(
        "key", "list", F.col("from").alias("day"), F.lit(1).alias("change"), F.lit(False).alias("probe"))
    ends = intervals.filter("until IS NOT NULL").select(
        "key", "list", F.col("until").alias("day"), F.lit(-1).alias("change"),
        F.lit(False).alias("probe"))
    upto = Window.partitionBy("key", "list").orderBy("day").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    state = probes.unionByName(starts).unionByName(ends).withColumn(
        "open", F.sum("change").over(upto))
    return state.filter(F.col("probe") & (F.col("open") > 0)).groupBy("key", "day").agg(
        F.array_sort(F.collect_set("list")).alias("lists"))


def filter_urls(
    captures: DataFrame, entries: DataFrame, *, url: str = "url", day: str = "day",
    allow: tuple[str, ...] = ("allow",), tables: WorkTables | None = None,
) -> DataFrame:
    """All columns of ``captures`` plus host, lists (sorted) and kept.

    A capture is held against the entries active on its own day for its host, all parent
    domains of two labels or more, and host with first path segment. It is dropped (``kept`` false) if a list
    names it, unless one of the ``allow`` lists does too. A URL without a host and a
    capture without a day match nothing and are kept. Existing columns of the three names
    are replaced; every row gets its own verdict, repeated rows too.

    Captures fold to distinct (URL keys, day) sets before the lookup. What is looked up is
    written: its joins, whose other side has one row per key and day, are then joins of
    two exchanges, in which adaptive execution can split a hot host or domain.
    """
    tables = tables or WorkTables(captures.sparkSession)
    names = ("host", "lists", "kept")
    rows = captures.select(
        row_struct(captures).alias("row"), url_host(F.col(url)).alias("_host"),
        url_keys(F.col(url), None).alias("_keys"), F.col(day).cast("date").alias("_day"))
    asked = rows.filter("_host IS NOT NULL AND _day IS NOT NULL").select("_keys", "_day").distinct()
    exploded = asked.select("_keys", "_day", F.explode("_keys").alias("key")).withColumn(
        "day", F.col("_day"))
    lists = tables.write(active_lists(exploded, entry_intervals(entries)), "active-lists")
    found = exploded.join(lists, ["key", "day"]).groupBy("_keys", "_day").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("lists")))).alias("lists"))
    answers = tables.write(
        found.select(F.col("_keys").alias("k"), F.col("_day").alias("d"), "lists"), "url-answers")
    joined = rows.join(answers, (F.col("_keys") == F.col("k")) & (F.col("_day") == F.col("d")), "left")
    lists_ = F.coalesce("lists", F.array().cast("array<string>"))
    kept = (F.size(lists_) == 0) | F.arrays_overlap(lists_, F.array(*map(F.lit, allow)))
    return joined.select(
        *[F.col("row")[name].alias(name) for name in captures.columns if name not in names],
        F.col("_host").alias("host"), lists_.alias("lists"), kept.alias("kept"))


# The given pages carry no fetch time and no list is given. The query derives both from the
# pages by rule: a day of 2024 from the page's id, and entries for what its hosts, parent
# domains and first segments look like. Dates and rules are parameters of the query alone.
_EPOCH, _DAYS = "2024-01-01", 360


def page_captures(pages: DataFrame) -> DataFrame:
    shift = F.pmod(F.col("page_id") * 7919, F.lit(_DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(_EPOCH).cast("date"), shift).alias("day"))


def page_entries(captures: DataFrame) -> DataFrame:
    """Dated entries: a key of length n is added on day 7 n and removed on day 7 n + 90, added
    again on day 7 n + 200; keys go to lists by their length and number of pages."""
    keys = captures.select(F.explode(url_keys(F.col("url"), None)).alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"))
    size = F.char_length("key")
    chosen = keys.filter((size + F.col("n")) % 3 == 0).select(
        "key", F.when(size % 5 == 0, "allow").when(size % 2 == 0, "adult").otherwise("spam")
        .alias("list"), (size * 7 % 150).cast("int").alias("start"))
    steps = F.array(*[
        F.struct(F.lit(action).alias("action"), F.lit(after).alias("after"))
        for action, after in (("add", 0), ("remove", 90), ("add", 200))])
    return chosen.select("list", "key", "start", F.inline(steps)).select(
        "list", "key", "action",
        F.date_add(F.lit(_EPOCH).cast("date"), F.col("start") + F.col("after")).alias("day"))


def op3_temporal_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page at its fetch day."""
    captures = page_captures(table(spark, folder, "pages"))
    judged = filter_urls(captures, page_entries(captures))
    return judged.select("page_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "host",
                         F.array_join("lists", ",").alias("lists"), "kept")


OP3_SQL = rf"""
WITH captures AS (
       SELECT page_id, url,
              CAST(DATE '{_EPOCH}' + CAST(((page_id * 7919) % {_DAYS} + {_DAYS}) % {_DAYS} AS INTEGER)
                AS DATE) AS day,
              nullif(regexp_replace(lower(regexp_extract(url, '{_HOST}', 1)), '^www\.|\.$', '', 'g'), '')
                AS host,
              regexp_extract(regexp_extract(url, '{_PATH}', 1), '^/([^/]+)', 1) AS segment
       FROM pages),
     keyed AS (
       SELECT DISTINCT page_id, day, key FROM (
         SELECT page_id, day, host AS key FROM captures WHERE host IS NOT NULL
         UNION ALL
         SELECT page_id, day, array_to_string(string_split(host, '.')[-n:], '.')
         FROM (SELECT page_id, day, host,
                      unnest(range(2, len(string_split(host, '.')) + 1)) AS n
               FROM captures WHERE host IS NOT NULL)
         UNION ALL
         SELECT page_id, day, host || '/' || segment FROM captures
         WHERE host IS NOT NULL AND segment <> '')),
     chosen AS (
       SELECT key, length(key) AS size, count(*) AS n FROM keyed GROUP BY key
       HAVING (length(key) + count(*)) % 3 = 0),
     spans AS (
       SELECT key,
              CASE WHEN size % 5 = 0 THEN 'allow' WHEN size % 2 = 0 THEN 'adult' ELSE 'spam' END
                AS list,
              DATE '{_EPOCH}' + CAST(size * 7 % 150 AS INTEGER) AS start
       FROM chosen),
     hits AS (
       SELECT DISTINCT page_id, list
       FROM keyed JOIN spans USING (key)
       WHERE (day >= start AND day < start + 90) OR day >= start + 200),
     lists AS (
       SELECT page_id, string_agg(list, ',' ORDER BY list) AS lists, bool_or(list = 'allow') AS allowed
       FROM hits GROUP BY page_id)
SELECT c.page_id, strftime(c.day, '%Y-%m-%d') AS day, host, coalesce(l.lists, '') AS lists,
       l.lists IS NULL OR allowed AS kept
FROM captures c LEFT JOIN lists l USING (page_id)
"""
