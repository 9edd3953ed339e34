import hashlib
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from silverbrook.llm.exact_dedup import build_hash, drop_repeats, exact_dedup, find_slots
from silverbrook.llm.line_dedup import LineRuns, find_drops, line_dedup, rewrite


@given(st.integers(0, 3000), st.integers(0, 2**32 - 1))
@settings(max_examples=20, deadline=None)
def test_hash_is_minimal_and_perfect(n, seed):
    digests = np.random.default_rng(seed).integers(0, 256, (n, 32), dtype=np.uint8)
    digests = np.unique(digests, axis=0)
    levels, slots = build_hash(digests)
    assert sorted(slots.tolist()) == list(range(len(digests)))
    assert (find_slots(levels, digests) == slots).all()


def _normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def _smallest(ids):
    return min((d for d in ids if d is not None), default=None)


def test_exact_dedup_equals_brute_force(edge_docs, edge_rows):
    groups = defaultdict(list)
    for doc, text, *_ in edge_rows:
        groups[_normal(text)].append(doc)
    want = sorted(
        (repr(d), repr(_smallest(groups[_normal(t)])), len(groups[_normal(t)]), hashlib.sha256(_normal(t).encode()).hexdigest())
        for d, t, *_ in edge_rows
    )
    for share in (0.0, 0.5, 1.0):
        got = exact_dedup(edge_docs, share).collect()
        assert want == sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in got)
        # One row of each text is kept, though a row is repeated.
        kept = [r.text_sha256 for r in got if r.kept]
        assert len(kept) == len(set(kept)) == len(groups)


def test_drop_repeats_keeps_columns(clashing_docs, no_docs, edge_rows):
    got = drop_repeats(clashing_docs)
    assert got.columns == clashing_docs.columns
    texts = [_normal(r.text) for r in got.collect()]
    assert sorted(texts) == sorted({_normal(t) for _, t, *_ in edge_rows})
    assert drop_repeats(no_docs).count() == exact_dedup(no_docs).count() == 0


def _lines_by_hand(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))

    owners = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                owners[key(line)].add(2**63 - 1 if doc is None else doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        me = 2**63 - 1 if doc is None else doc
        kept = [x for x in lines if not (len(key(x)) >= 10 and min(owners[key(x)]) != me)]
        out.append((repr(doc), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_line_dedup_equals_brute_force(edge_docs, clashing_docs, edge_rows, no_docs):
    want = _lines_by_hand(edge_rows)
    for docs, batches, fan in ((edge_docs, 1, 2), (edge_docs, 5, 2), (clashing_docs, 4, 3)):
        got = line_dedup(docs, batches, fan).collect()
        assert want == sorted((repr(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got)
    assert line_dedup(no_docs).count() == 0


def test_lines_of_many_rows_without_id(spark):
    shared = [f"a line that several rows share {i}" for i in range(40)]
    rows = [(None, "\n".join([f"a line of row {n} alone", *shared[n % 20 : n % 20 + 10]])) for n in range(200)]
    rows += [(7, "\n".join(shared[:5])), (7, "\n".join(shared[3:8])), (9, "\n".join(shared[:9]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((repr(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in line_dedup(docs).collect())
    assert got == _lines_by_hand(rows)
    # What a row collects is bounded by its own lines.
    drops = find_drops(docs, LineRuns(spark))
    assert max(len(r.drops) for r in drops.collect()) <= 10


def test_runs_are_neither_moved_nor_sorted(spark):
    runs = LineRuns(spark, fan=2, buckets=4)
    for i in range(3):
        batch = spark.createDataFrame([(i, f"common line of text\nline number {i} here")], "doc_id long, text string")
        find_drops(batch, runs)
    assert [len(level) for level in runs.levels] == [1, 1]
    hashes = runs.seen().select("hash").distinct().repartition(4, "hash")
    joined = runs.with_owners(hashes)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("line_run_") == 2 + 2 and plan.count("SortMergeJoin") == 2
    # What is below a join on the side of its run: a scan of the buckets, nothing else.
    sides = plan.split("SortMergeJoin")[1:]
    below_last = sides[0].splitlines()[-4:] + sides[1].splitlines()[-4:]
    assert not any("Exchange" in line or "Sort " in line for line in below_last if "line_run_" in line or "Project" in line)
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning(hash") - plan.count("REPARTITION_BY_NUM") == 1
    assert joined.filter("owner IS NULL").isEmpty()
    names = set(runs.names)
    runs.close()
    assert names and not names & {t.name for t in spark.catalog.listTables()}


def test_runs_are_levelled_and_disjoint(spark):
    runs = LineRuns(spark, fan=2)
    texts = ["common line of text\nline number %d here" % i for i in range(5)]
    dropped = []
    for i, text in enumerate(texts):
        batch = spark.createDataFrame([(i, text)], "doc_id long, text string")
        dropped.append(rewrite(batch, find_drops(batch, runs)).first().n_dropped)
    assert dropped == [0, 1, 1, 1, 1]
    # Five runs with a fan of two: one of level 0 and one of level 2.
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    seen = runs.seen().collect()
    assert len(seen) == len({bytes(r.hash) for r in seen}) == 6


def test_runs_have_a_bucket_for_each_partition_of_a_shuffle(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame = type(spark.range(0))
    dealt = frame.repartition
    # A session may deal rows out to more partitions than were asked for.
    monkeypatch.setattr(
        frame, "repartition", lambda df, n, *by: dealt(df, max(n, 70) if by and isinstance(n, int) else n, *by)
    )
    spark.conf.set("spark.sql.shuffle.partitions", "70")
    try:
        runs = LineRuns(spark)
        rows = [(i, "\n".join(f"line number {i} {j} of many" for j in range(500))) for i in range(2)]
        batch = spark.createDataFrame(rows, "doc_id long, text string")
        find_drops(batch, runs)
        run = runs.runs()[0]
        # One file of a bucket: its order holds, and few files are written.
        assert run.count() == 1000 and len(run.inputFiles()) <= runs.buckets
        plan = runs.with_owners(run.select("hash"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        runs.close()
