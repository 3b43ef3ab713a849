"""Near copies among vectors against all pairs."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyframe.llm import crosspolytope

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=2, dims=20):
    """Groups of near copies, of equal and of scaled vectors, and single vectors."""
    rng = np.random.default_rng(seed)
    made = list(rng.normal(size=(150, dims)))
    for size, noise in ((120, 0.05), (30, 0.15), (2, 0.08), (3, 0.0)):
        center = rng.normal(size=dims)
        made += [center + noise * rng.normal(size=dims) for _ in range(size)]
    made += [made[0]] * 40 + [made[1] * 4.0] + [np.concatenate([made[2][:5], np.zeros(dims - 5)]), made[2][:5]]
    made = [np.asarray(x, np.float32) for x in made]
    ids = rng.permutation(len(made)) * 3
    return [(int(i), x.tolist(), 1) for i, x in zip(ids, made, strict=True)]


ODD = [(None, None, 1), (2, None, 1), (4, [], 1), (5, [0.0] * 20, 1), (7, [float("nan")] * 20, 2), (8, [1.0, None], 2),
       (10, [float("inf"), 1.0], 2), (11, [-0.0], None)]


def plain(rows, cosine=0.9):
    """Links counted and least ids reached, of rows by their place."""
    width = max((len(r[1]) for r in rows if r[1]), default=0)
    unit = np.zeros((len(rows), width))
    for out, row in zip(unit, rows, strict=True):
        x = np.array([np.nan if c is None else c for c in row[1] or []], dtype=float)
        if len(x) and np.isfinite(x).all() and x.any():
            out[: len(x)] = x / np.linalg.norm(x)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    group = np.arange(len(rows))
    while True:
        least = np.where(near, group, len(rows)).min(axis=1, initial=len(rows))
        if (least >= group).all():
            break
        group = np.minimum(group, least)
    ids = {}
    for place, g in enumerate(group.tolist()):
        ids.setdefault(g, []).append(rows[place][0])
    first = {g: min((i for i in own if i is not None), default=None) for g, own in ids.items()}
    return Counter(
        (r[0], int(n), first[g], r[0] == first[g]) for r, n, g in zip(rows, near.sum(axis=1), group.tolist(), strict=True)
    )


def result(frame):
    return Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in frame.collect())


def test_links_and_groups_equal_all_pairs(spark):
    rows = vectors() + ODD
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("clash")).repartition(5)
    made = crosspolytope.near_vectors(df)
    assert made.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert result(made) == plain(rows)
    # Buckets dealt as pairs of tiles give the same.
    assert result(crosspolytope.near_vectors(df, tile=9)) == plain(rows)


def test_repeated_rows_null_ids_and_doubles(spark):
    rows = vectors(5)
    rows += [(None, rows[160][1], 1), (None, rows[3][1], 1), (None, [9.0], 1), (rows[8][0], rows[160][1], 1), rows[9], rows[9]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(crosspolytope.near_vectors(df)) == plain(rows)
    large = [(i, [c * 1e200 for c in x], n) for i, x, n in rows]
    wide = spark.createDataFrame(large, SCHEMA.replace("float", "double"))
    assert result(crosspolytope.near_vectors(wide)) == plain(rows)


def test_text_ids_and_empty_tables(spark):
    rows = [(f"v{i}", x, n) for i, x, n in vectors()]
    df = spark.createDataFrame(rows, SCHEMA.replace("vec_id long", "vec_id string"))
    assert result(crosspolytope.near_vectors(df)) == plain(rows)
    assert crosspolytope.near_vectors(df.where("vec_id = ''")).count() == 0
    assert result(crosspolytope.near_vectors(spark.createDataFrame(ODD, SCHEMA))) == plain(ODD)


def test_recall_at_the_threshold():
    """Of pairs at a cosine of just 0.9, with the layouts of tables of many sizes."""
    rng = np.random.default_rng(0)
    for classes, dims in ((1_000, 64), (100_000, 64), (10**7, 64), (10**9, 64), (100_000, 300), (100_000, 8)):
        hashes, tables, probes = crosspolytope.layout(classes, dims)
        a, b = rng.normal(size=(2, 1_000, dims))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b -= (a * b).sum(axis=1)[:, None] * a
        b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1)[:, None]
        one, two = (crosspolytope.codes(x, hashes, tables, probes) for x in (a, b))
        met = (one[:, :, None] == two[:, None, :]).any(axis=(1, 2))
        assert met.mean() > 0.95, (classes, dims, met.mean())


def test_hadamard_keeps_products():
    rows = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(crosspolytope.hadamard(rows) @ crosspolytope.hadamard(rows).T, 32 * rows @ rows.T)


def test_query_has_a_row_for_every_vector(spark):
    folder = "/root/testdata/sf0.001"
    made = contract.queries()["op11_cross_polytope"](spark, folder)
    given = [(r["vec_id"], r["embedding"], 0) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert result(made) == plain(given)
