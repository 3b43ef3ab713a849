"""Periodic runs against a plain scan of every lag."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyframe.llm import periodic


def plain_runs(words, least=12):
    found = {}
    for lag in range(1, len(words) // 2 + 1):
        at = 0
        while at + lag < len(words):
            start = at
            while at + lag < len(words) and words[at] == words[at + lag]:
                at += 1
            length = at - start + lag
            if at > start and length >= max(least, 2 * lag):
                found.setdefault((start, length), lag)
            at = max(at, start + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_rest(words, runs):
    gone = {i for start, length, lag in runs for i in range(start + lag, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng):
    size = int(rng.integers(0, 160))
    words = [b"w%d" % x if x else "é".encode() for x in rng.integers(0, rng.integers(2, 9), size)]
    for _ in range(int(rng.integers(0, 4)) if size > 20 else 0):
        first, lag = int(rng.integers(0, size - 10)), int(rng.integers(1, 40))
        for i in range(first + lag, int(rng.integers(first, size))):
            words[i] = words[i - lag]
    return words


def test_runs_of_random_words(spark):
    rng = np.random.default_rng(8)
    texts = [periodic_words(rng) for _ in range(300)]
    rows = [(i, b"\n ".join(words).decode()) for i, words in enumerate(texts)]
    found = 0
    for row in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words = texts[row["doc_id"]]
        runs = plain_runs(words)
        found += len(runs)
        assert [tuple(r) for r in row["runs"]] == runs
        assert row["n_words"] == len(words) and row["collapsed"].encode() == plain_rest(words, runs)
    assert found > 100


def test_hard_texts(documents):
    """Nulls, empty and long texts, repeated rows, and columns named as results."""
    given = documents.withColumn("runs", F.lit("clash")).withColumn("COLLAPSED", F.lit(1))
    made = periodic.periodic_runs(given)
    assert made.columns == [*documents.columns, "n_words", "runs", "collapsed"]
    want = Counter()
    for id_, text in documents.select("doc_id", "text").collect():
        words = (text or "").encode().split()
        runs = [(0, 40_000, 1)] if id_ == 63 else plain_runs(words)
        want[id_, len(words), tuple(runs), plain_rest(words, runs).decode()] += 1
    got = Counter(
        (r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in made.collect()
    )
    assert got == want


def test_empty_table(nothing):
    assert periodic.periodic_runs(nothing).count() == 0


def test_texts_without_a_blank_between_do_not_meet():
    array = pa.array([b"a b", b"b a", b"", b"c"] + [b"x"] * 20, pa.binary())
    data = np.frombuffer(b"".join(array.to_pylist()), np.uint8)
    places = np.concatenate([[0], np.cumsum([len(x) for x in array.to_pylist()])])
    starts, ends, counts = periodic.words_of(data, places)
    assert counts.tolist() == [2, 2, 0, 1] + [1] * 20 and len(starts) == len(ends) == 25


def test_long_periodic_texts_take_little_time():
    """Every word equal, a Fibonacci word, and a text that single words part from its end on."""
    import time

    a, b = b"a", b"ab"
    while len(b) < 100_000:
        a, b = b, b + a
    chain = b" ".join(b"w%d" % k for i in range(100_000) for k in (i + 1, i))
    began = time.perf_counter()
    sizes = []
    for text in (b"x " * 300_000, b" ".join(bytes([c]) for c in b), chain):
        _, runs, _ = periodic._of_texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 12)
        sizes.append(len(runs[0]))
    assert sizes[0] == 1 and sizes[1] > 10_000 and sizes[2] == 0
    assert time.perf_counter() - began < 30


def test_query_against_a_plain_version(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"v{x}" for x in rng.integers(0, 50, rng.integers(0, 90)))) for i in range(150)]
    rows += [(None, "x " * 30), (150, None), (151, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r.asDict() for r in contract.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    planted = 0
    for id_, text in rows:
        words = (text or "").split()
        n = len(words)
        h = zlib.crc32(str(id_).encode()) if id_ is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            first = g % n
            lag = 1 + (n - first) // (3 + g % 8)
            words = [w if i < first else words[first + (i - first) % lag] for i, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert got[id_] == {
            "doc_id": id_, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(plain_rest([w.encode() for w in words], runs)).hexdigest(),
        }
    assert planted > 5
