"""The registered queries: against SQL where there is some, and the pipeline's stages."""

import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import __spark_entry__ as contract
import corpus_pipeline
from tallyframe.llm import bpe
from tallyframe.llm.queries import llm_oracles, llm_queries
from tools.check_oracles import open_engine, rows_of

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_all_are_registered():
    assert llm_queries().keys() <= contract.queries().keys()
    assert [n for n in range(1, 14) if any(q.startswith(f"op{n}_") for q in contract.queries())] == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(spark, name):
    frame = contract.queries()[name](spark, FOLDER)
    answer = open_engine(FOLDER).execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, answer.fetchall())


def representatives(texts):
    """The smallest id of each group that fingerprints within two bits of each other make."""
    prints = {}
    for id_, text in texts.items():
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxh64_intdigest(g, seed=42) for g in grams]
        prints[id_] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {id_: id_ for id_ in prints}
    for i in prints:
        for j in prints:
            if i < j and root[i] != root[j] and (prints[i] ^ prints[j]).bit_count() <= 2:
                least, other = sorted((root[i], root[j]))
                root = {k: least if r == other else r for k, r in root.items()}
    return set(root.values())


def test_pipeline_stages(spark, tmp_path):
    import public_tokenizers
    import tiktoken

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, path = docs, str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1")
    first = spark.read.parquet(str(tmp_path / "quality"))
    assert labels.join(first, "doc_id", "left_anti").count() == 0
    second = spark.read.parquet(str(tmp_path / "line_dedup"))
    assert second.count() == first.count() and second.where("n_chars <> length(text)").count() == 0
    third = spark.read.parquet(str(tmp_path / "near_copies"))
    assert third.count() < second.count()
    fourth = spark.read.parquet(str(tmp_path / "mixing"))
    assert fourth.join(third, "doc_id", "left_anti").count() == 0
    assert docs.count() == fourth.count()
    assert docs.groupBy("text").count().exceptAll(fourth.groupBy("text").count()).count() == 0
    # Each stage against a plain version on its own input.
    def from_sql(name, stage):
        engine = open_engine(FOLDER)
        engine.execute(f"create or replace view documents as select * from '{tmp_path / stage}/*.parquet'")
        return engine.execute(llm_oracles()[name]).df()

    field = contract.queries()["op3_quality"](spark, FOLDER)
    assert {r["doc_id"] for r in field.where("predicted = 1").collect()} == {r["doc_id"] for r in first.collect()}
    digests = from_sql("op2_line_dedup", "quality")
    texts = {r["doc_id"]: r["text"] for r in second.collect()}
    assert {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items()} == dict(
        zip(digests["doc_id"], digests["kept_sha256"], strict=True)
    )
    assert {r["doc_id"] for r in third.collect()} == representatives(texts)
    taken = Counter(from_sql("op5_mixing", "near_copies")["doc_id"].tolist())
    assert Counter(r["doc_id"] for r in fourth.collect()) == taken
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(ranks)}, special_tokens={}
    )
    for row in docs.withColumn("list", bpe.as_array(F.col("ids"))).collect():
        assert row["list"] == known.encode_ordinary(row["text"])
    whole = contract.queries()["pipeline"](spark, FOLDER)
    assert whole.exceptAll(docs).count() == 0 and whole.count() == docs.count()
