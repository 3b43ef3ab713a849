"""Whitening against the dense covariance and its eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyframe.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(seed=1, size=400, dims=12):
    rng = np.random.default_rng(seed)
    made = (rng.normal(size=(size, dims)) * 0.9 ** np.arange(dims) + 0.3).astype(np.float32)
    return [(i * 2, x.tolist(), 1) for i, x in enumerate(made)]


ODD = [(1, None, 1), (3, [float("nan")] * 12, 1), (5, [1.0, None], 1), (7, [float("-inf")], 2)]


def whole(rows, dims):
    """Exact integers by plain Python; short vectors filled up."""
    return [
        (i, [math.floor(1024 * c) + 100_000 for c in v] + [100_000] * (dims - len(v)))
        for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]


def dense(numbers, components=8):
    x = np.array([v for _, v in numbers], dtype=float)
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    order = np.argsort(values)[::-1][:components]
    return values[order], centred @ vectors[:, order] / np.sqrt(values[order]), (centred**2).sum() / len(x)


def check(got, numbers, components=8):
    values, want, trace = dense(numbers, components)
    n, sums = len(numbers), [sum(c) for c in zip(*(v for _, v in numbers), strict=True)]
    table = np.array([r["whitened"] for r in got])
    assert [r["vec_id"] for r in got] == [i for i, _ in numbers]
    for r, (_, v) in zip(got, numbers, strict=True):
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
    for k in range(want.shape[1]):
        sign = np.sign(table[:, k] @ want[:, k])
        assert np.abs(table[:, k] * sign - want[:, k]).max() < 1e-8
    return values, trace


def by_id(frame):
    return sorted(frame.collect(), key=lambda r: (r["vec_id"] is not None, r["vec_id"]))


def test_whitened_rows_equal_the_dense_way(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows + ODD, SCHEMA).withColumn("whitened", F.lit("clash")).repartition(7)
    made, model, error = whitening.whiten(df)
    numbers = whole(rows, 12)
    values, trace = check(by_id(made), numbers)
    assert made.columns == ["vec_id", "whitened", "deviation"]
    assert np.allclose(model.values, values, rtol=1e-12) and model.trace == pytest.approx(trace, rel=1e-12)
    assert model.residuals.max() <= 32 * np.finfo(float).eps * values[0] and error < 1e-10


def test_repeated_rows_null_ids_and_short_vectors(spark):
    rows = rows_of(2, 60, 6)
    rows += [rows[0], rows[0], (None, rows[3][1], 1), (1001, [0.5, 0.25], 1), (1003, [], 1)]
    made, _, _ = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    numbers = sorted(whole(rows, 6), key=lambda r: (r[0] is not None, r[0] or 0))
    check(by_id(made), numbers)


def test_tables_without_variance_or_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(5)], SCHEMA)
    made, model, error = whitening.whiten(same)
    assert [r["whitened"] for r in made.collect()] == [[]] * 5 and len(model.values) == 0 and error == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 1) for i in range(9)], SCHEMA)
    made, model, error = whitening.whiten(line)
    assert len(model.values) == 1 and all(len(r["whitened"]) == 1 for r in made.collect())
    for empty in (same.where("vec_id < 0"), spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame([(1, [], 1)], SCHEMA)):
        assert whitening.whiten(empty)[0].schema["whitened"].dataType.simpleString() == "array<double>"
    assert whitening.whiten(same.where("vec_id < 0"))[0].count() == 0


def test_large_numbers(spark):
    """A deviation beyond doubles is exact, beyond a long an error; the mean too is exact."""
    rows = [(i, [float(i * 9_000), 1.0], 1) for i in range(20)]
    made, model, _ = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    numbers = whole(rows, 2)
    n, sums = 20, [sum(c) for c in zip(*(v for _, v in numbers), strict=True)]
    assert {r["vec_id"]: r["deviation"] for r in made.collect()} == {
        i: sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in numbers
    }
    assert list(model.mean.sums) == sums
    with pytest.raises(Exception, match="exceeds a long"):
        whitening.whiten(spark.createDataFrame([(0, [0.0], 1), (1, [1e10], 1)], SCHEMA))[0].collect()


def test_sums_of_many_tasks(spark, monkeypatch):
    rows = rows_of(3, 200, 9)
    monkeypatch.setattr(whitening, "_FEW", 2)
    made, _, _ = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(8))
    check(by_id(made), whole(rows, 9))


def test_eigenpairs_of_hard_operators():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(90, 90)))[0]
    for spectrum in (
        np.linspace(1, 1.05, 90), np.ones(90), 0.5 ** np.arange(90), np.r_[np.ones(3), np.full(87, 1e-9)],
        np.r_[5, 5, 5, 4, 4, np.linspace(3.9, 4, 85)], np.zeros(90),
    ):
        matrix = turn * spectrum @ turn.T
        values, vectors, norms = whitening.jacobi_davidson(lambda v, m=matrix: m @ v, 90, 8)
        top = np.sort(spectrum)[::-1][:8]
        assert np.abs(values - top).max() <= 1e-12 * max(top[0], 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
        assert norms.max() <= 90 * np.finfo(float).eps * top[0] + 1e-300


def test_minres_solves():
    rng = np.random.default_rng(4)
    matrices = [(m + m.T) / 2 for m in rng.normal(size=(3, 10, 10))]
    apply = lambda t: np.stack([m @ t[:, k] for k, m in enumerate(matrices)], axis=1)
    right = rng.normal(size=(10, 3))
    assert np.abs(apply(whitening.minres(apply, right, 30, 1e-13)) - right).max() < 1e-8


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = contract.queries()["op13_whitening"](spark, folder).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    numbers = whole(rows, 64)
    values, want, trace = dense(numbers)
    assert len(got) == 8 * len(numbers) and {r["n"] for r in got} == {len(numbers)}
    place = {i: k for k, (i, _) in enumerate(numbers)}
    table = np.zeros_like(want)
    for r in got:
        table[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-10
    signs = np.sign((table * want).sum(axis=0))
    assert np.abs(table * signs - want).max() < 1e-8
