"""Ids that are not whole numbers: texts and decimals, in the order of their own type."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import bpe, line_dedup, lm, mixing, quality, sharding, simhash, suffix_dedup, topk, winnowing

# Each keeps the order of the whole numbers; the decimals share whole parts.
KINDS = {
    "text": lambda id_: F.format_string("doc-%06d", id_),
    "decimal": lambda id_: (id_.cast("decimal(18,2)") / 4).cast("decimal(18,2)"),
    "double": lambda id_: id_.cast("double") / 8 - 3,
}


def renamed(df, kind):
    return df.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), KINDS[kind](F.col("doc_id"))))


def rows_by(df, kind):
    """The rows of a result, with ids of whole numbers turned into those of a kind."""
    df = df if kind is None else renamed(df, kind)
    return sorted((tuple(map(repr, r)) for r in df.collect()))


@pytest.mark.parametrize("kind", KINDS)
def test_results_follow_the_order_of_ids(documents, kind):
    other = renamed(documents, kind)
    for made in (
        lambda df: suffix_dedup.remove_repeats(df).drop("begins", "ends"),
        lambda df: winnowing.against_next(df),
    ):
        assert rows_by(made(other), None) == rows_by(made(documents), kind)


@pytest.mark.parametrize("kind", KINDS)
def test_language_model_takes_any_ids(documents, kind):
    by_id = F.crc32(F.col("text").cast("binary")) % 7 == 2
    one = lm.score(renamed(documents, kind), by_id).drop("score")
    assert rows_by(one, None) == rows_by(lm.score(documents, by_id).drop("score"), kind)


def test_top_k_of_any_ids(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=6).round(1).tolist() for _ in range(90)]
    vectors[50:60] = vectors[:10]  # ties
    ids = [str(i) for i in range(0, 70)] + [f"{i}.5" for i in range(5)] + ["x" * 3000, "", "7e1", *(f"v{i}" for i in range(12))]
    vectors[3] = None
    frame = spark.createDataFrame(list(zip(ids, vectors, strict=True)) + [(None, vectors[4])], "vec_id string, embedding array<double>")
    held = {i: [math.floor(64 * x) for x in v] for i, v in zip(ids, vectors, strict=True) if v}
    want = []
    for q in ["0", "20", "40", "60"]:
        scored = sorted((-sum(a * b for a, b in zip(held[q], y, strict=True)), i) for i, y in held.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:20])]
    assert sorted(tuple(r) for r in topk.top_k(frame, whole=True).collect()) == sorted(want)
    scaled = spark.createDataFrame([(i / 2, v) for i, v in enumerate(vectors[10:50])], "vec_id double, embedding array<double>")
    assert {r["query_id"] for r in topk.top_k(scaled, k=3).collect()} == {0.0}
    assert topk.top_k(frame.where("vec_id = 'none'")).count() == 0


@pytest.mark.parametrize("kind", ["text", "decimal"])
def test_other_operators_take_any_ids(documents, kind):
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    other = renamed(documents, kind)
    labels = other.where("doc_id is not null").select("doc_id").distinct().withColumn("quality", F.col("doc_id").cast("string").endswith("5").cast("int"))
    count = documents.count()
    for made in (
        line_dedup.drop_shared_lines(other), quality.score(other, quality.fit_on(other, labels)),
        bpe.encode(other, ranks, public_tokenizers.PATTERN), sharding.shard(other), simhash.near_copies(other),
    ):
        assert made.count() == count
    assert mixing.mix(other, {"origin": F.col("source")}, [F.lit(1)], F.length("text")).count() > 0
