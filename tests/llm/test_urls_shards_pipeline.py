import datetime
import random
import zlib
from collections import defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import _rows, connect
from silverbrook.llm.common import table
from silverbrook.llm.queries import ORACLES, QUERIES
from silverbrook.llm.sharding import GROUP_SHARE, Splitters, shard, write_shards
from silverbrook.llm.url_filters import (
    STRETCH,
    filter_captures,
    host_intervals,
    laid_out,
    stretch,
    url_host,
    validity_intervals,
)
from silverbrook.session import shared_dir
from tests.llm.test_near_dedup import groups_by_hand

DAY = datetime.date


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf_dir)
    answer = connect(sf_dir).execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, answer.fetchall())


def test_intervals(spark):
    entries = [
        ("l", "host", "A.example", "remove", DAY(2024, 1, 1)),  # changes nothing
        ("l", "host", "a.example", "add", DAY(2024, 1, 2)),
        ("l", "host", "a.example", "add", DAY(2024, 1, 3)),
        ("l", "host", "a.example", "remove", DAY(2024, 1, 5)),
        ("l", "host", "a.example", "add", DAY(2024, 1, 5)),  # a removal loses on the same day
        ("l", "host", "a.example", "remove", DAY(2024, 1, 9)),
        ("m", "domain", "example", "add", DAY(2024, 1, 4)),
        ("l", "host", None, "add", DAY(2024, 1, 4)),
        ("l", "host", "b.example", "add", None),
    ]
    listed = spark.createDataFrame(entries, "list string, scope string, key string, action string, day date")
    got = sorted(tuple(r) for r in validity_intervals(listed).collect())
    assert got == [
        ("l", "host", "a.example", DAY(2024, 1, 2), DAY(2024, 1, 9)),
        ("m", "domain", "example", DAY(2024, 1, 4), None),
    ]
    captures = [
        (1, "http://A.example./x", DAY(2024, 1, 1)),
        (2, "http://user@a.example:80/x", DAY(2024, 1, 2)),
        (3, "https://a.example", DAY(2024, 1, 8)),
        (4, "https://a.example?q", DAY(2024, 1, 9)),
        (5, "https://sub.a.example/", DAY(2024, 1, 2)),
        (6, "https://notexample/", DAY(2024, 1, 8)),
        (7, None, DAY(2024, 1, 8)),
        (8, "no url", DAY(2024, 1, 8)),
        (9, "https://a.example", None),
        (9, "https://a.example", None),
    ]
    seen = spark.createDataFrame(captures, "id long, url string, fetched_on date").selectExpr("*", "1 AS host", "2 AS blocked", "3 AS entries")
    judged = filter_captures(seen, listed)
    assert judged.columns[:6] == seen.columns
    got = {r.id: (r._blocked, [e.list for e in r.active]) for r in judged.collect()}
    assert got == {
        1: (False, []), 2: (True, ["l"]), 3: (True, ["l", "m"]), 4: (True, ["m"]), 5: (False, []),
        6: (False, []), 7: (False, []), 8: (False, []), 9: (False, []),
    }
    assert judged.count() == len(captures)
    assert filter_captures(seen, listed.filter("false")).filter("_blocked").isEmpty()
    assert filter_captures(seen.filter("false"), listed).count() == 0


def test_url_filters_run_no_python(spark):
    plan = QUERIES["op7_url_filters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_hosts(spark):
    urls = {
        "http://[2001:DB8::1]:8080/x": "[2001:db8::1]", "https://u@[::1]": "[::1]", "http://a.b.:80/": "a.b",
        "http://[broken/x": "[broken", "http://": None, "//a.b/c": None, None: None,
    }
    seen = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.host for r in seen.withColumn("host", url_host(F.col("url"))).collect()} == urls


def test_a_hot_host_over_years(spark):
    """One host has nearly all captures and changes its state every other day; no row of the join grows with that."""
    start = DAY(2020, 1, 5)
    days = [start + datetime.timedelta(n) for n in range(1200)]
    entries = [("flip", "host", "hot.example", "add" if n % 4 == 0 else "remove", d) for n, d in enumerate(days[:1100]) if n % 2 == 0]
    entries += [("all", "domain", "example", "add", DAY(1999, 1, 1)), ("v6", "host", "[::1]", "add", days[40]), ("v6", "domain", "1]", "add", days[0])]
    captures = [(n, "http://hot.example/", d) for n, d in enumerate(days)] + [(5000, "http://[::1]/", days[39]), (5001, "http://[::1]/", days[40])]
    listed = spark.createDataFrame(entries, "list string, scope string, key string, action string, day date")
    seen = spark.createDataFrame(captures, "id long, url string, fetched_on date")
    got = {r.id: [e.list for e in r.active] for r in filter_captures(seen, listed).collect()}
    for n in range(1200):
        on = n % 4 in (0, 1) if n < 1100 else False  # the last entry, of day 1,098, removes
        assert got[n] == ["all"] + ["flip"] * on, n
    assert (got[5000], got[5001]) == ([], ["v6"])
    spread = laid_out(validity_intervals(listed), days[0], days[-1])
    held = host_intervals(seen.select(url_host(F.col("url")).alias("host"), stretch(F.col("fetched_on")).alias("stretch")).distinct(), spread)
    assert held.agg(F.max(F.size("entries"))).first()[0] <= STRETCH // 2 + 1 + 1
    assert filter_captures(seen.filter("false"), listed.filter("false")).count() == 0
    assert filter_captures(seen, listed.filter("false")).filter("blocked").isEmpty()


def _check_shards(rows, sizes):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(sizes)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    due, largest = sum(s for s, _ in sizes) / 16, max(s for s, _ in sizes)
    groups = defaultdict(list)
    for r in rows:
        groups[r.size, r.text_crc32].append(r)
    whole = {k: g for k, g in groups.items() if sum(r.size for r in g) <= GROUP_SHARE * due or len(g) == 1}
    assert all(len({r.shard for r in g}) == 1 and not any(r.group_split for r in g) for g in whole.values())
    assert all(all(r.group_split for r in g) for k, g in groups.items() if k not in whole)
    largest = max([largest, *(sum(r.size for r in g) / 2 for g in whole.values())])
    assert all(abs(sum(r.size for r in by_shard.get(s, [])) - due) <= largest for s in range(16))


def _sizes(rows):
    return [(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows]


def test_shards(spark, edge_docs, clashing_docs, edge_rows, no_docs):
    _check_shards(shard(edge_docs).collect(), _sizes(edge_rows))
    assert shard(clashing_docs).count() == len(edge_rows) and shard(no_docs).count() == 0
    # A third of all rows with one text, and rows that agree in id and text.
    rng = random.Random(6)
    rows = [(i, "hot text " * 9) for i in range(1500)] + [(7, "same")] * 300 + [(i, "x" * rng.randint(0, 300)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    _check_shards(shard(docs).collect(), _sizes(rows))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equal_texts_of_the_given_documents_share_a_shard(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    texts = defaultdict(set)
    for r in table(spark, sf_dir, "documents").collect():
        texts[r.text or ""].add(r.doc_id)
    rows = {r.doc_id: r for r in QUERIES["op9_sharding"](spark, sf_dir).collect()}
    _check_shards(list(rows.values()), [(len(t.encode()) + 1, zlib.crc32(t.encode())) for t, ids in texts.items() for _ in ids])
    assert any(len(ids) > 1 for ids in texts.values())
    for ids in texts.values():
        assert len({rows[i].shard for i in ids}) == 1, ids


def test_binary_search_of_splitters():
    rng = np.random.default_rng(0)
    bounds = np.unique(rng.integers(0, 5, (40, 3)), axis=0)
    rows = rng.integers(0, 5, (500, 3))
    want = [sum(tuple(b) <= tuple(r) for b in bounds.tolist()) for r in rows.tolist()]
    assert Splitters(bounds).place(rows).tolist() == want
    assert Splitters(bounds[:0]).place(rows).tolist() == [0] * 500


def test_written_shards_hold_whole_rows(spark, clashing_docs):
    path = shared_dir(spark, "shards")
    write_shards(clashing_docs, path)
    back = spark.read.parquet(path)
    assert back.count() == clashing_docs.count() and set(clashing_docs.columns) <= set(back.columns)


def test_pipeline_stages_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == table(spark, sf_dir, "documents").columns
        kept = {r.doc_id for r in docs.collect()}
        if name == "language_id":
            want = {d for d, t in before.items() if any(map(str.isalpha, t or ""))}
        elif name == "exact_dedup":
            want = set({" ".join((t or "").split()) + "|" * (t[:1].isspace()) + "." * (t[-1:].isspace()): d for d, t in sorted(before.items(), reverse=True)}.values())
        elif name == "near_dedup":
            want = {int(d) for d, _, c in groups_by_hand(list(before.items()), 80) if d == c}
        else:
            items = [" ".join(r.text.split()).lower() for r in table(spark, sf_dir, "benchmark").collect()]
            want = {d for d, t in before.items() if not any(i in " ".join(t.split()).lower() for i in items)}
        assert kept == want, name
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept < set(rows)


def test_pipeline_edge_cases(spark, clashing_docs, no_docs):
    for docs in (clashing_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns and out.count() <= docs.count()
        corpus_pipeline.packing(spark, docs, "").collect()


def test_registered_queries_read_whole_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT count(*) FROM '{sf_dir}/documents.parquet'").fetchall()[0][0]
    for name in ("op2_token_frames", "op3_language_id", "op8_minhash_near_dedup", "op9_sharding"):
        assert QUERIES[name](spark, sf_dir).count() == docs
