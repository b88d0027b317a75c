"""URL lists and mixing: brute force per row, edge cases, whole results."""

import datetime as dt
import hashlib
import math
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from llm_frames import awkward, documents, with_clashes
from tidewatch.llm import mixing, url_lists
from tidewatch.llm.mixing import example_weights, mix_sources, source_rates
from tidewatch.llm.url_lists import filter_urls, url_host, url_keys

DAY = dt.date(2024, 1, 1)


def at(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def test_url_parts(spark):
    urls = ["HTTPS://User:pw@WWW.Shop.Example.co.uk:8080/a/b?x=/y#z", "http://h", "no url", None, "",
            "http://a.b.c.d.e.f.g.h/", "ftp://x.y/z", "http://www./q"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string").select(
        url_host(F.col("u")), url_keys(F.col("u"))).collect()
    assert [row[0] for row in frame] == [
        "shop.example.co.uk", "h", None, None, None, "a.b.c.d.e.f.g.h", "x.y", None]
    assert set(frame[0][1]) == {"shop.example.co.uk", "co.uk", "example.co.uk",
                                "shop.example.co.uk/a"}
    assert frame[1][1] == ["h"] and frame[2][1] == [] and frame[3][1] == []
    assert "c.d.e.f.g.h" in frame[5][1] and "b.c.d.e.f.g.h" not in frame[5][1]


ENTRIES = [
    ("bad", "x.com", 10, "add"), ("bad", "x.com", 20, "remove"), ("bad", "x.com", 30, "add"),
    ("bad", "x.com", 32, "add"), ("bad", "X.COM", 40, "remove"), ("bad", "x.com", 40, "add"),
    ("allow", "ok.x.com", 12, "add"), ("spam", "x.com/p", 0, "add"), ("spam", "z.org", 5, "remove"),
    ("spam", None, 5, "add"), (None, "x.com", 5, "add"), ("spam", "x.com", None, "add"),
    ("spam", "x.com", 3, "odd"), ("spam", "x.com", 15, "add"), ("spam", "x.com", 15, "remove"),
]


def active(name, key, day):
    state = False
    for d in sorted({e[2] for e in ENTRIES if e[2] is not None}):
        if d > day:
            break
        acts = [e[3] for e in ENTRIES if e[0] == name and (e[1] or "").lower() == key and e[2] == d]
        if "remove" in acts:
            state = False
        elif "add" in acts:
            state = True
    return state


def test_captures_meet_the_entries_of_their_day(spark):
    urls = {"http://x.com/": ["x.com"], "http://ok.x.com/p": ["ok.x.com", "x.com", "ok.x.com/p"],
            "http://x.com/p/q": ["x.com", "x.com/p"], "http://z.org/": ["z.org"], "none": []}
    rows = [(u, at(d), "own") for u in urls for d in range(0, 50)] * 2
    rows += [("http://x.com/", None, "own"), (None, at(3), None)]
    captures = spark.createDataFrame(rows, "url string, day date, lists string")
    entries = spark.createDataFrame(
        [(a, b, at(c), d) for a, b, c, d in ENTRIES], "list string, key string, day date, action string")
    found = filter_urls(with_clashes(captures), entries).collect()
    assert len(found) == len(rows)
    for row in found:
        keys = urls.get(row["url"], [])
        day = None if row["day"] is None else (row["day"] - DAY).days
        want = sorted({n for n in ("bad", "allow", "spam") for k in keys
                       if day is not None and active(n, k, day)})
        assert row["lists"] == want, row
        assert row["kept"] == (not want or "allow" in want)


def test_segments_keep_their_case_and_hosts_do_not(spark):
    entries = spark.createDataFrame(
        [("bad", "Example.COM/Promo", DAY, "add"), ("spam", "example.com/promo", at(5), "add"),
         ("allow", "EXAMPLE.com", at(9), "add"), ("odd", "example.com/Ä/Ö", DAY, "add")],
        "list string, key string, day date, action string")
    urls = {"http://example.com/Promo/x": ["bad"], "http://EXAMPLE.com/promo/x": ["spam"],
            "http://example.com/PROMO": [], "http://example.com/Ä/Ö": []}
    captures = spark.createDataFrame(
        [(u, at(d)) for u in urls for d in (0, 6, 9)], "url string, day date")
    for row in filter_urls(captures, entries).collect():
        day = (row["day"] - DAY).days
        want = [n for n in urls[row["url"]] if n == "bad" or day >= 5] + ["allow"] * (day >= 9)
        assert row["lists"] == sorted(want), row


def test_every_parent_domain_is_looked_up(spark):
    labels = [f"n{i}" for i in range(40)]
    host = ".".join(labels)
    parents = {f"p{n}": ".".join(labels[-n:]) for n in range(2, 41)}
    assert parents["p40"] == host
    entries = spark.createDataFrame(
        [(name, key, DAY, "add") for name, key in parents.items()],
        "list string, key string, day date, action string")
    captures = spark.createDataFrame([(f"http://{host}/a", DAY)], "url string, day date")
    row = filter_urls(captures, entries).first()
    assert row["lists"] == sorted(parents) and not row["kept"]
    seven = entries.filter("list = 'p7'")
    assert filter_urls(captures, seven).first()["lists"] == ["p7"]
    short = spark.createDataFrame([("http://h/a", DAY), ("http://b.h/a", DAY)], "url string, day date")
    assert all(r["kept"] for r in filter_urls(short, seven).collect())


@pytest.mark.parametrize("captures,entries", [(0, 1), (1, 0), (0, 0)])
def test_empty_lists_and_captures(spark, captures, entries):
    left = spark.createDataFrame([("http://x.com/", DAY)] * captures, "url string, day date")
    right = spark.createDataFrame([("bad", "x.com", DAY, "add")] * entries,
                                  "list string, key string, day date, action string")
    assert [r["kept"] for r in filter_urls(left, right).collect()] == [True] * captures


def uniform(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:12], 16) / 2**48


def poisson(rate, u):
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term = term * rate / k
        total += term
    return k


WEIGHTS = [("s0", 3.0), ("s1", 1.0), (None, 0.5), ("absent", 9.0), ("s2", 0.0)]


def test_copies_follow_the_distribution(spark):
    docs = with_clashes(documents(spark))
    weights = spark.createDataFrame(WEIGHTS, "source string, weight double")
    found = mix_sources(docs, weights, seed=5, total=200.0).toPandas()
    sizes = Counter(row[3] for row in awkward())
    known = {s: w for s, w in WEIGHTS if s in sizes and w > 0}
    want = Counter()
    for doc_id, _, _, source, _ in awkward():
        rate = known.get(source, 0) / sum(known.values()) * 200.0 / sizes[source]
        key = "" if doc_id is None else doc_id
        for copy in range(poisson(rate, uniform("count5", key)) if rate else 0):
            want[(doc_id, copy, uniform("place5", key, copy))] += 1
    got = Counter((None if math.isnan(r.doc_id) else int(r.doc_id), r.copy, r.place)
                  for r in found.itertuples())
    assert got == want and found["place"].is_monotonic_increasing
    assert set(found["shard"]) == {"own shard"}


def test_sources_reach_their_weights(spark):
    rows = [(i, "t", None, "big" if i % 10 else "small", 1) for i in range(20_000)]
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    found = mix_sources(documents(spark, rows), weights, seed=1).groupBy("source").count().collect()
    counts = {row[0]: row[1] for row in found}
    assert all(abs(counts[s] - 10_000) < 5 * math.sqrt(10_000 * 5) for s in ("big", "small"))


def test_impossible_rates_are_refused_and_empty_tables_pass(spark):
    weights = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    one = documents(spark, [(1, "t", None, "s", 1)])
    with pytest.raises(ValueError):
        source_rates(one, weights, 1000.0, source="source", weight="weight")
    assert mix_sources(documents(spark, []), weights).count() == 0
    assert mix_sources(one, weights.limit(0)).count() == 0


def test_large_rates_are_drawn_in_parts(spark):
    """Rates of about 2,400 and 70: every copy, as the sum of draws of at most 50 each."""
    rows = [(i, "t", None, "rare" if i < 2 else "some", 1) for i in range(42)]
    weights = spark.createDataFrame([("rare", 5.0), ("some", 3.0)], "source string, weight double")
    found = mix_sources(documents(spark, rows), weights, seed=5, total=7501.0).collect()
    want = Counter()
    for doc_id, _, _, source, _ in rows:
        rate = {"rare": 5.0 / 8.0 * 7501.0 / 2, "some": 3.0 / 8.0 * 7501.0 / 40}[source]
        draws = math.ceil(rate / 50)
        n = sum(poisson(rate / draws, uniform("count5", doc_id, *([k] if k else [])))
                for k in range(draws))
        assert abs(n - rate) < 5 * math.sqrt(rate)
        for copy in range(n):
            want[(doc_id, copy, uniform("place5", doc_id, copy))] += 1
    assert Counter((r["doc_id"], r["copy"], r["place"]) for r in found) == want
    assert max(copy for _, copy, _ in want) > 128


def test_copies_of_one_document_fill_several_chunks(spark):
    weights = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    one = documents(spark, [(1, "t", None, "s", 1)])
    copies = sorted(r["copy"] for r in mix_sources(one, weights, total=20_000.0).collect())
    assert copies == list(range(len(copies))) and abs(len(copies) - 20_000) < 5 * math.sqrt(20_000)


def test_a_single_document_of_a_rare_source_does_not_stop_the_query(spark):
    rows = [(i, "t", None, f"s{i % 20}", 1) for i in range(60_000)] + [(60_000, "t", None, None, 1)]
    docs = documents(spark, rows)
    found = mix_sources(docs, example_weights(docs), seed=1).groupBy("source").count().collect()
    rate = 60_001 / (20 * math.sqrt(3000) + 1)
    counts = {r[0]: r[1] for r in found}
    assert rate > 50 and abs(counts[None] - rate) < 5 * math.sqrt(rate)


def same_as_sql(spark, folder, query, sql, name, rows):
    """Query and SQL over one table; floats to twelve digits."""
    pq.write_table(pa.Table.from_pylist(rows), f"{folder}/{name}.parquet")
    found = query(spark, str(folder)).toPandas()
    with duckdb.connect() as base:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        want = base.execute(sql).df()[found.columns.tolist()]

    def plain(frame):
        return sorted(map(repr, frame.round(12).astype(object).values.tolist()))

    assert plain(found) == plain(want) and len(found)
    return found


def test_sql_looks_up_parents_of_any_number_of_labels(spark, tmp_path):
    """Hosts of up to twelve labels, so that entries for parents of seven and more decide."""
    rows = [{"page_id": i, "url": f"http://{'.'.join(f'n{(i + j) % 3}' for j in range(2 + i % 11))}.org/a{i % 4}/x"}
            for i in range(150)]
    found = same_as_sql(spark, tmp_path, url_lists.op3_temporal_url_lists, url_lists.OP3_SQL, "pages", rows)
    assert not found["kept"].all() and found["kept"].any()


def test_sql_lists_counts_beyond_forty(spark, tmp_path):
    """A source of one document among 2,000 of another has a rate near 44."""
    rows = [{"doc_id": i, "text": "t", "lang": "xx", "source": "rare" if i % 2001 == 0 else "big", "n_chars": 1}
            for i in range(2001)]
    found = same_as_sql(spark, tmp_path, mixing.op4_poisson_mixing, mixing.OP4_SQL, "documents", rows)
    assert found["copy"].max() >= 40
