import math
from collections import defaultdict

import numpy as np
import pytest

from silverbrook.llm import whitening
from silverbrook.llm.common import table
from silverbrook.llm.queries import QUERIES
from silverbrook.llm.whitening import leading, whiten

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(vectors):
    """(x, exact deviations, covariance) of vectors of equal length."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    return centred, deviations, centred.T @ centred / n


def held(rows):
    """vec_id -> its rows by component."""
    found = defaultdict(list)
    for r in rows:
        found[r.vec_id].append(r)
    return {i: sorted(own, key=lambda r: r.component) for i, own in found.items()}


def check(rows, vectors, components=32):
    """``vectors``: distinct id -> vector."""
    centred, deviations, v = by_hand(list(vectors.values()))
    own = held(rows)
    assert set(own) == set(vectors)
    count = min(components, v.shape[0])
    assert all([r.component for r in rs] == list(range(1, count + 1)) for rs in own.values())
    assert {i: (rs[0].n, rs[0].deviation) for i, rs in own.items()} == {
        i: (len(vectors), d) for i, d in zip(vectors, deviations, strict=True)
    }
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    white = np.array([[r.whitened for r in own[i]] for i in vectors])
    want = centred @ axes / np.sqrt(values)
    signs = np.sign((white * want).sum(axis=0))
    np.testing.assert_allclose(white * signs, want, atol=1e-8)
    explained = np.array([[r.explained for r in own[i]] for i in vectors])
    np.testing.assert_allclose(explained, np.tile(values / np.trace(v), (len(vectors), 1)), rtol=1e-9)
    errors = {r.identity_error for r in rows}
    covariance = white.T @ white / len(white)
    assert len(errors) == 1 and abs(errors.pop() - np.abs(covariance - np.eye(count)).max()) < 1e-12
    assert np.abs(covariance - np.eye(count)).max() < 1e-8


def test_query_against_whole_covariance(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op11_embedding_whitening"](spark, sf_dir)
    assert got.columns == COLUMNS and dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), {r.vec_id: r.embedding for r in table(spark, sf_dir, "embeddings").collect()})


def test_edge_cases(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(0, 3, 5).tolist() for i in range(40)}
    bad = [None, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0], [3e38] * 5]
    rows = [(i, v, 1) for i, v in good.items()] + [(100 + i, v, None) for i, v in enumerate(bad)]
    wide = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 AS n", "'x' AS component", "2 AS kind")
    single = {i: np.float32(v).astype(float).tolist() for i, v in good.items()}
    check(whiten(wide).collect(), single)
    # Shorter vectors count as followed by zeros; ids may repeat or be missing.
    ragged = [(None, [1.0, 2.0], 0), (7, [], 0), (7, [0.0, 0.0, 5.0], 0), (7, [], 0), (8, [1.0, 2.0, 0.0], 0)]
    got = whiten(spark.createDataFrame(ragged, SCHEMA).coalesce(1)).collect()
    assert sorted(repr(r.vec_id) for r in got if r.component == 3) == ["7", "7", "7", "8", "None"]
    same = {repr(r.vec_id): (r.deviation, r.whitened) for r in got if r.component == 1 and r.vec_id != 7}
    assert same["8"] == same["None"]


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0), (2, [], 0)]])
def test_nothing_to_whiten(spark, rows):
    got = whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == COLUMNS and got.count() == 0


def test_no_variance(spark):
    got = whiten(spark.createDataFrame([(i, [1.5, -2.0], 0) for i in range(5)], SCHEMA)).collect()
    assert len(got) == 10
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(5, 0, None, 0.0, None)}
    # One direction varies, and a third of the vectors are equal.
    line = [(i, [float(max(i, 10)), 0.0, 3.0], 0) for i in range(30)]
    got = whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert all(r.explained == (1.0 if r.component == 1 else 0.0) and r.identity_error < 1e-12 for r in got)


def test_entries_beyond_doubles_stay_exact(spark):
    vectors = {1: [2.0**40, 0.015625], 2: [-(2.0**50), 3.0], 3: [0.1, -7.0], 4: [2.0**50 + 1, 0.0]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    own = held(whiten(df).collect())
    assert {i: int(r[0].deviation) for i, r in own.items()} == dict(zip(vectors, by_hand(list(vectors.values()))[1], strict=True))


def test_small_blocks_and_two_steps_of_addition(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(0, 1, 6).tolist() for i in range(200)}
    for name, value in {"BLOCK_ROWS": 3, "FAN": 2, "ROWS_AT_ONCE": 4}.items():
        monkeypatch.setattr(whitening, name, value)
    spread = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(6)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", 2**27)  # a task for each file
    try:
        check(whiten(spread, 4).collect(), vectors, 4)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


@pytest.mark.parametrize("shape", ["flat", "ties", "steep", "few directions", "one gap"])
def test_spectra(shape):
    rng = np.random.default_rng(3)
    values = {
        "flat": 1 + rng.uniform(0, 1e-3, 90),
        "ties": np.repeat([3.0, 2.0, 1.0], 30),
        "steep": 10.0 ** -np.arange(90.0),
        "few directions": np.r_[[5.0, 4.0, 3.0], np.zeros(87)],
        "one gap": np.r_[np.full(32, 2.0), np.full(58, 1.99)],
    }[shape]
    axes = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    v = axes * values @ axes.T
    found = leading(lambda block: v @ block, 90, 32)
    want = np.sort(values)[::-1][:32]
    np.testing.assert_allclose(found.values, want, atol=1e-10 * want[0])
    assert np.abs(found.vectors.T @ found.vectors - np.eye(32)).max() < 1e-12
    assert np.linalg.norm(v @ found.vectors - found.vectors * found.values, axis=0).max() < 1e-10 * want[0]
