"""Top-k search, URL filters, the registered queries against SQL, and the pipeline."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from countypanel.llm import topk, url_filters
from countypanel.llm.queries import ORACLE_SQL, QUERIES


def brute_top(rows, k):
    import math

    good = sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
                   if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = set()
    for i, q in good:
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in good if j != i)
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("lists", [2, 3])
def test_top_k_is_exact(spark, lists, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK_ROWS", 30)
    monkeypatch.setattr(topk, "GROUP_ROWS", 4)
    rng = random.Random(lists)
    rows = [(i, [rng.gauss(0, 1) for _ in range(7)]) for i in range(160)]
    rows += [(200 + i, rows[40][1]) for i in range(60)] + [(400 + i, [0.0] * 7) for i in range(30)]  # hot copies and ties
    rows += [(500, None), (501, [None] * 7), (520, [float("nan")] * 7), (540, [float("inf")] + [0.0] * 6), (None, rows[0][1]), rows[0], (560, [1.0, 2.0])]
    data = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, score int")
    exact = [(r.vec_id, r.embedding) for r in data.collect()]
    for k in (5, 400):
        got = topk.top_k(data, F.col("vec_id") % 20 == 0, k=k, lists=lists).collect()
        assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == brute_top(exact, k) and len(got) == len(brute_top(exact, k))
    assert topk.top_k(data.limit(0), F.col("vec_id") % 20 == 0).count() == 0


T = dt.datetime(2024, 1, 10)
HOUR = dt.timedelta(hours=1)


def test_url_filters_follow_the_entries_of_the_moment(spark):
    entry = "list_name string, verdict string, pattern string, action string, dated timestamp_ntz, url string"
    entries = spark.createDataFrame([
        ("a", "block", "bad.example", "add", T, "x"), ("a", "block", "bad.example", "remove", T + 30 * HOUR, "x"),
        ("a", "block", "bad.example", "add", T + 90 * HOUR, "x"), ("b", "allow", "www.bad.example", "add", T + 10 * HOUR, "x"),
        ("b", "allow", "www.bad.example", "remove", T + 20 * HOUR, "x"), ("b", "allow", "www.bad.example", "add", T + 20 * HOUR, "x"),
        ("c", "block", "ok.example/ads", "add", T, "x"), ("c", "block", "ok.example/ads", "add", T + HOUR, "x"),
        ("c", "block", None, "add", T, "x"), ("c", "block", "ok.example", None, T, "x"), ("c", "block", "ok.example", "add", None, "x"),
    ], entry)
    asked = [
        ("http://bad.example/x", -1, "none"), ("http://bad.example/x", 0, "block"), ("https://user@WWW.bad.example:80/?q", 5, "block"),
        ("http://www.bad.example/", 10, "allow"), ("http://www.bad.example/", 20, "block"), ("http://bad.example", 30, "none"),
        ("http://www.bad.example/", 89, "none"), ("http://bad.example", 400, "block"), ("http://ok.example/ads/1?x#y", 50, "block"),
        ("http://ok.example/adsense", 50, "none"), ("http://ok.example/", 50, "none"), ("http://notbad.example/", 0, "none"),
        ("bad.example", 0, "none"), (None, 0, "none"), ("http://bad.example/x", 0, "block"),
    ]
    captures = spark.createDataFrame([(i, u, T + h * HOUR, "k") for i, (u, h, _) in enumerate(asked)] + [(99, "http://bad.example/", None, "k")],
                                     "page_id bigint, url string, fetched_at timestamp_ntz, verdict string")
    for seconds in (3600, 86400 * 7):
        got = {r.page_id: r.verdict for r in url_filters.evaluate(captures, entries, seconds).collect()}
        assert got == {**{i: v for i, (_, _, v) in enumerate(asked)}, 99: "none"}
    assert {r.verdict for r in url_filters.evaluate(captures, entries.limit(0)).collect()} == {"none"}
    assert url_filters.evaluate(captures.limit(0), entries).count() == 0


def test_url_filters_over_any_span_of_time(spark):
    """Against brute force: intervals of every length, a capture centuries off, very long urls and hosts."""
    rng = random.Random(11)
    patterns = ["a.example", "b.a.example", "b.a.example/x", "b.a.example/x/y", "example"]
    urls = ["http://a.example/x", "http://b.a.example/x/y/z", "http://b.a.example/" + "x/" * 20_000, "http://" + "b." * 5_000 + "a.example/", "http://c.test/"]
    spans = [1, 24, 24 * 40, 24 * 400]
    entries = [("l" + str(rng.randrange(2)), rng.choice(["block", "allow"]), rng.choice(patterns), rng.choice(["add", "remove"]),
                T + rng.randrange(rng.choice(spans)) * HOUR) for _ in range(60)]
    asked = [(i, rng.choice(urls), T + rng.randrange(rng.choice(spans)) * HOUR) for i in range(80)]
    asked += [(90, urls[0], dt.datetime(2324, 1, 1)), (91, urls[1], dt.datetime(1824, 1, 1))]
    want = {}
    for page, url, at in asked:
        host, path = url[7:].split("/", 1)
        parts = [p for p in path.split("/") if p]
        labels = host.split(".")
        own = {".".join(labels[i:]) for i in range(len(labels) - 3, len(labels)) if i >= 0} | {host} | {"/".join([host, *parts[:n]]) for n in (1, 2, 3) if n <= len(parts)}
        active = set()
        for name, verdict, pattern in {e[:3] for e in entries}:
            before = [(e[4], e[3] == "remove") for e in entries if e[:3] == (name, verdict, pattern) and e[4] <= at]
            if pattern in own and before and not max(before)[1]:
                active.add((len(pattern), verdict == "block", verdict, pattern, name))
        want[page] = max(active)[2:] if active else ("none", None, None)
    got = url_filters.evaluate(spark.createDataFrame(asked, "page_id bigint, url string, fetched_at timestamp_ntz"), spark.createDataFrame(
        entries, "list_name string, verdict string, pattern string, action string, dated timestamp_ntz"), 3600)
    assert {r.page_id: (r.verdict, r.pattern, r.list_name) for r in got.collect()} == want
    assert {v for v, _, _ in want.values()} == {"none", "block", "allow"}


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_agree_with_their_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels", "events"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = QUERIES[name](spark, folder)
    want = db.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect())))
    assert rows == sorted(map(str, want.select(", ".join(columns)).fetchall())) and rows


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_url_filters"])
def test_native_queries_use_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes, before = [docs.count()], {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        after.write.parquet(path := str(tmp_path / name))
        after = spark.read.parquet(path)
        ids = {r.doc_id for r in after.collect()}
        assert ids <= before
        docs, before = after, ids
        sizes.append(len(ids))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > sizes[4] == sizes[5]
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_passes_odd_rows(spark, documents, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    rows = [(1, None), (2, ""), (2, ""), (None, "some words of a text"), (3, "some words of a text"), (4, "word " * 30_000), (5, "q")]
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 3, 4, 5]
