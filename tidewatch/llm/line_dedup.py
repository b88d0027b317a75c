"""Line dedup by site: lines on more than a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm.common import broadcast_if_small, row_struct, table
from tidewatch.sources.work import WorkTables

# White space that does not tell lines apart at their ends.
_ENDS = " \t\r\x0b\x0c"


def _line_hash(line: Column) -> Column:
    """128 bits of a line without white space at its ends; NULL for a blank line."""
    bare = F.trim(line, F.lit(_ENDS))
    return F.when(bare != "", F.struct(
        F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit("line"), bare).alias("h2")
    ))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate_lines(
    docs: DataFrame, *, host: str, text: str = "text", ratio: float, least_pages: int
) -> DataFrame:
    """(host, h1, h2, pages): lines on over ``ratio`` of a host's pages and on ``least_pages`` of them.

    A page counts once for each line it holds, however often. Lines travel as hashes and
    are added up before the shuffle; a host's flagged lines number at most its mean lines
    per page / ``ratio``.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    hashes = F.array_compact(F.transform(_lines(F.col("text")), _line_hash))
    counts = pages.select("host", F.explode(F.array_distinct(hashes)).alias("line")).groupBy(
        "host", F.col("line.h1").alias("h1"), F.col("line.h2").alias("h2")
    ).agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= least_pages)
    hosts = totals.select(F.col("host").alias("_host"), "total")
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).filter(
        F.col("pages") > F.lit(ratio) * F.col("total")
    ).select("host", "h1", "h2", "pages")


def drop_boilerplate(
    docs: DataFrame, *, host: str, text: str = "text", ratio: float = 0.1, least_pages: int = 3,
    tables: WorkTables | None = None,
) -> DataFrame:
    """All columns of ``docs`` with boilerplate lines taken out of ``text``, and ``n_dropped``.

    Every row is a page, also repeated rows; NULL hosts are one host. Blank lines are never
    dropped. NULL text stays NULL; a text of which nothing stays becomes empty; a text that
    loses nothing stays as it is, byte for byte. An existing ``n_dropped`` is replaced.
    """
    spark = docs.sparkSession
    tables = tables or WorkTables(spark)
    flagged = tables.write(
        boilerplate_lines(docs, host=host, text=text, ratio=ratio, least_pages=least_pages),
        "boilerplate",
    )
    rows = docs.select(row_struct(docs).alias("row"))
    rows = rows.withColumn("_p1", F.xxhash64("row")).withColumn(
        "_p2", F.xxhash64(F.lit("page"), "row"))
    whole = F.col("row")[text]
    hashes = F.array_compact(F.transform(_lines(whole), _line_hash))
    held = rows.select("_p1", "_p2", F.col("row")[host].alias("_host"),
                       F.explode(F.array_distinct(hashes)).alias("line"))
    hit = held.join(
        broadcast_if_small(flagged, flagged.count()),
        held["_host"].eqNullSafe(flagged["host"]) & (held["line.h1"] == flagged["h1"])
        & (held["line.h2"] == flagged["h2"]), "left_semi",
    )
    # A page's own flagged lines; pages of equal rows have equal ones.
    per_page = hit.groupBy(F.col("_p1").alias("p1"), F.col("_p2").alias("p2")).agg(
        F.collect_set("line").alias("drop")
    )
    joined = rows.join(
        per_page, (F.col("_p1") == F.col("p1")) & (F.col("_p2") == F.col("p2")), "left"
    )
    every = _lines(whole)
    drop = F.col("drop")
    left = F.filter(every, lambda line: ~F.coalesce(
        F.array_contains(drop, _line_hash(line)), F.lit(False)))
    cleaned = joined.withColumn("left", F.when(drop.isNotNull(), left))
    kept = [name for name in docs.columns if name not in ("n_dropped", text)]
    columns = {name: F.col("row")[name].alias(name) for name in kept}
    columns[text] = F.when(
        drop.isNotNull(), F.array_join("left", "\n")).otherwise(whole).alias(text)
    return cleaned.select(
        *[columns[name] for name in docs.columns if name != "n_dropped"],
        F.when(drop.isNotNull(), F.size(every) - F.size("left")).otherwise(0).alias("n_dropped"),
    )


RATIO, LEAST_PAGES = 0.1, 3


def op6_site_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, host="source", ratio=RATIO, least_pages=LEAST_PAGES)


_BARE = r"trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))"

OP6_SQL = f"""
WITH lines AS (
       SELECT doc_id, source, line, pos, {_BARE} AS bare
       FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) AS pos
             FROM documents)),
     totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
     flagged AS (
       SELECT l.source, bare
       FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
       WHERE bare <> ''
       GROUP BY l.source, bare, total
       HAVING count(DISTINCT doc_id) >= {LEAST_PAGES}
          AND count(DISTINCT doc_id) > CAST({RATIO} AS DOUBLE) * total),
     marked AS (
       SELECT l.*, f.bare IS NOT NULL AS gone
       FROM lines l LEFT JOIN flagged f
         ON l.source IS NOT DISTINCT FROM f.source AND l.bare = f.bare),
     texts AS (
       SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
              CAST(count(*) FILTER (gone) AS INTEGER) AS n_dropped
       FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.source, t.text, coalesce(t.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN texts t USING (doc_id)
"""
