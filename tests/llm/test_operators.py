"""The operators against brute force in plain Python, on cases that are hard to get right."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallyframe.llm import bpe, components, line_dedup, lm, mixing, quality, sharding, simhash, suffix_dedup, topk, winnowing

BLANKS = " \t\n\x0b\x0c\r"


def pairs(df):
    return [(row["doc_id"], row["text"]) for row in df.select("doc_id", "text").collect()]


def lower(text):
    return (text or "").encode().lower()


def test_empty_tables_give_no_rows(nothing):
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    labels = nothing.select("doc_id", F.lit(1).alias("quality"))
    vectors = nothing.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"))
    mixed = mixing.mix(nothing, {"origin": F.col("source")}, [F.lit(1)], F.length("text"))
    for frame in (
        lm.score(nothing), line_dedup.drop_shared_lines(nothing), quality.score(nothing, quality.fit_on(nothing, labels)),
        bpe.decode(bpe.encode(nothing, ranks, public_tokenizers.PATTERN), ranks), mixed, sharding.shard(nothing),
        topk.top_k(vectors), suffix_dedup.remove_repeats(nothing), winnowing.against_next(nothing),
        winnowing.fingerprints(nothing), simhash.near_copies(nothing), simhash.one_of_each(nothing),
    ):
        assert frame.count() == 0


def test_line_dedup(documents):
    rows = pairs(documents)
    holders = defaultdict(list)
    for id_, text in rows:
        for key in {line.strip(BLANKS.encode()) for line in lower(text).split(b"\n")}:
            if len(key.decode()) >= 20:
                holders[key].append(id_)
    order = lambda i: -1 if i is None else i
    last = {key: max(ids, key=order) for key, ids in holders.items() if len(ids) >= 3}
    want = Counter()
    for id_, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(lower(x).strip(BLANKS.encode()), id_) == id_]
        want[id_, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    made = line_dedup.drop_shared_lines(documents.withColumn("n_lines", F.lit("clash")))
    assert made.columns == [*documents.columns, "n_lines", "n_dropped"]
    got = Counter(tuple(r) for r in made.select("doc_id", "text", "n_lines", "n_dropped").collect())
    assert got == want and len(last) > 0


def test_lines_of_repeated_ids(spark, tmp_path):
    """Rows of one id are one document for the registered query, as for its SQL."""
    import corpus_pipeline
    from tallyframe.llm.queries import llm_oracles, llm_queries
    from tools.check_oracles import open_engine

    two, three = "A line that only two documents hold.", "A line that three documents hold."
    held = [(5, two), (5, two), (7, two), (1, three), (1, three), (2, three), (4, three), (None, two)]
    rows = [(i, f"{t}\nown {n}", "en", "src0", len(t)) for n, (i, t) in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    engine = open_engine(str(tmp_path))
    want = {r[0]: r[2] for r in engine.execute(f"with o as ({llm_oracles()['op2_line_dedup']}) select doc_id, n_lines, n_dropped from o").fetchall()}
    made = llm_queries()["op2_line_dedup"](spark, str(tmp_path))
    got = Counter()
    for r in made.collect():
        got[r["doc_id"]] += r["n_dropped"]
    assert got == Counter(want) and want == {5: 0, 7: 0, 1: 2, 2: 1, 4: 0, None: 0}
    stage = corpus_pipeline.line_stage(spark, docs, str(tmp_path)).where("doc_id = 5 or doc_id = 7")
    assert all(two in r["text"] for r in stage.collect())


def test_bloom_filters_never_miss():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    parts = []
    for low in range(0, 4000, 1000):
        once, twice = np.zeros(1 << 14, np.uint8), np.zeros(1 << 14, np.uint8)
        line_dedup.add(once, twice, hashes[low : low + 1500])
        parts.append((once, twice))
    _, twice = line_dedup.merged(parts)
    counts = Counter(h for low in range(0, 4000, 1000) for h in hashes[low : low + 1500].tolist())
    assert line_dedup.is_in(twice, np.array([h for h, n in counts.items() if n > 1], np.uint64)).all()
    single = np.array([h for h, n in counts.items() if n == 1], np.uint64)
    assert line_dedup.is_in(twice, single).mean() < 0.05


def test_simhash(documents):
    rows = pairs(documents)

    def fingerprint(text):
        words = lower(text).split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxh64_intdigest(g, seed=42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = defaultdict(lambda: None)
    for (id_, _), r in zip(rows, root, strict=True):
        if id_ is not None:
            least[r] = id_ if least[r] is None else min(least[r], id_)
    want = Counter((id_, f"{p:016x}", least[r]) for (id_, _), p, r in zip(rows, prints, root, strict=True))
    assert Counter(tuple(r) for r in simhash.near_copies(documents).collect()) == want
    kept = simhash.one_of_each(documents)
    gone = {id_ for (id_, _, c) in want if id_ is not None and id_ != c}
    assert kept.columns == documents.columns
    assert {r["doc_id"] for r in kept.collect()} == {id_ for id_, _ in rows} - gone


def test_one_row_of_each_component(spark):
    a, b, c, d = (f"{x} some words of a text that is {x} and no other one" for x in ("red", "green", "blue", "brown"))
    rows = [(None, a, 1), (None, a, 2), (None, a.upper(), 3)]  # without ids
    rows += [(7, b, 4), (3, b, 5), (7, c, 6), (None, c, 7), (8, c, 8)]  # 7 is a copy of 3, and stands for c
    rows += [(9, d, 9), (9, d, 9), (9, d.upper(), 10)]  # one id, repeated as it is and in other letters
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == ["doc_id", "text", "n"] and len(got) == 4
    assert Counter((i, t.lower()) for i, t, _ in got) == Counter([(None, a), (3, b), (7, c), (9, d)])
    assert set(got) <= set(rows)


@pytest.mark.parametrize("tile", [1 << 14, 8])
def test_links_of_a_large_bucket(spark, tile):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(40, 64, (300, 4)).astype(np.uint64)
    values = np.unique(np.bitwise_xor.reduce(flips, axis=1) ^ base)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    got = {r["node"]: r["root"] for r in components.components(simhash.fingerprint_links(frame, 2, tile)).collect()}
    root = {int(v): int(v) for v in values.view(np.int64)}
    for a in values:
        for b in values[np.bitwise_count(values ^ a) <= 2]:
            x, y = root[int(a.view(np.int64))], root[int(b.view(np.int64))]
            if x != y:
                root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    assert {k: got.get(k, k) for k in root} == root


def test_bpe_equals_the_rank_library(spark, documents):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(ranks)}, special_tokens={}
    )
    odd = "<|endoftext|> don't   \x1c 12³ \U0001f600 ́ \r\n\n  tail  "
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(99, odd)], "doc_id long, text string"))
    made = bpe.decode(bpe.encode(frame, ranks, public_tokenizers.PATTERN), ranks).withColumn("list", bpe.as_array(F.col("ids")))
    for row in made.where("length(text) < 90000 or text is null").collect():
        assert row["list"] == known.encode_ordinary(row["text"] or "")
        assert row["n_tokens"] == len(row["list"])
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in made.select("decoded", "text").collect())


def test_ids_of_long_texts_equal_the_rank_library(documents, monkeypatch):
    """Long pre-tokens, and texts that are taken a part at a time."""
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(ranks)}, special_tokens={}
    )
    encoder = lambda: bpe.PieceEncoder(bpe.piece_model(ranks), ranks, public_tokenizers.PATTERN)
    texts = [t or "" for _, t in pairs(documents)]
    letters = np.random.default_rng(11).choice(list("etaoinshrdlu"), 30_000)
    texts += ["".join(letters), "\u00e9" * 20_000, "a b" + " " * 5000 + "c"]
    want = [known.encode_ordinary(t) for t in texts]
    ids = lambda packed: [np.frombuffer(x, "<u4").tolist() for x in packed]
    assert max(map(len, texts)) >= 100_000 and ids(encoder().encode(texts)) == want
    monkeypatch.setattr(bpe, "_TOGETHER", 50)
    monkeypatch.setattr(bpe, "_AT_ONCE", 7)
    taken = []
    long = bpe.PieceEncoder._long
    monkeypatch.setattr(bpe.PieceEncoder, "_long", lambda self, text: taken.append(text) or long(self, text))
    assert ids(encoder().encode(texts)) == want and len(taken) == sum(len(t) > 50 for t in texts)


def test_quality_separates_lines(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("aeinrst"), rng.integers(2, 8)))
    good = lambda: " ".join(word() for _ in range(rng.integers(8, 30))).capitalize() + "."
    bad = lambda: " ".join(word() + "$$$" for _ in range(rng.integers(8, 30)))
    rows = []
    for i in range(400):
        lines = [good() for _ in range(rng.integers(1, 8))]
        if i % 4 == 0:
            lines += [bad() for _ in range(3)]
        rows.append((i, "\n".join(lines), int(i % 4 != 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    field = quality.fit_on(docs, docs.where(~quality.in_fold(F.col("doc_id"))).select("doc_id", "quality"))
    scored = quality.score(docs.withColumn("score", F.lit("clash")), field)
    out = scored.where(quality.in_fold(F.col("doc_id"))).select("quality", "score").collect()
    assert len(out) > 40 and all((r["score"] >= 0.3) == (r["quality"] == 1) for r in out)
    lines = quality.line_chances(docs, field).select("quality", "text", "bad_chances").collect()
    for row in lines:
        marked = [c > 0.5 for c in row["bad_chances"]]
        assert len(marked) == row["text"].count("\n") + 1
        assert all(m for m, x in zip(marked, row["text"].split("\n"), strict=True) if "$" in x)
        assert row["quality"] == 0 or not any(marked)


def test_quality_of_hard_rows(documents):
    labels = documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("quality"))
    scores = quality.score(documents, quality.fit_on(documents, labels)).select("text", "score").collect()
    assert len(scores) == documents.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert len({r["score"] for r in scores if not r["text"]}) == 1


def test_chances_of_a_chain_add_up():
    rng = np.random.default_rng(5)
    scores, steps = rng.normal(size=7), rng.normal(size=(2, 2))
    lines = np.array([4, 3])
    chance, total, _ = quality.bad_chances(scores, lines, steps)
    for begin, size, place in ((0, 4, 0), (4, 3, 1)):
        weights = {}
        for code in range(1 << size):
            labels = [code >> i & 1 for i in range(size)]
            weight = sum(scores[begin + i] for i in range(size) if labels[i])
            weights[tuple(labels)] = math.exp(weight + sum(steps[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        assert math.isclose(total[place], math.log(sum(weights.values())))
        for i in range(size):
            assert math.isclose(chance[begin + i], sum(w for l, w in weights.items() if l[i]) / sum(weights.values()))


def test_language_model_counts(documents):
    rows = pairs(documents)
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [[*lower(text).split(), None] for _, text in rows]
    counts = Counter(t for (id_, _), words in zip(rows, tokens, strict=True) if not out(id_) for t in words)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter(
        (id_, out(id_), len(words), sum(counts[t] > 0 for t in words), total,
         round(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in words), 5))
        for (id_, _), words in zip(rows, tokens, strict=True)
    )
    got = lm.score(documents).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 5)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    usual = [r for r in got if r["n_tokens"] < 1000]
    assert sum(r["score"] for r in usual) > sum(r["base_score"] for r in usual)


def test_language_model_chances_add_up():
    rng = np.random.default_rng(3)
    words = np.sort(rng.choice(1 << 40, lm.CLASSES * lm.WORDS, replace=False).astype(np.uint64))
    outer = rng.normal(size=(lm._KINDS + 1, lm._ROWS, lm._ALL)).astype(np.float32)
    inner = rng.normal(size=(lm._INNER + lm.CLASSES, lm.WORDS)).astype(np.float32)
    slots = rng.permutation(len(words))
    model = lm.Model(words, slots, np.zeros(lm.OPEN), outer, inner, np.zeros((lm.CLASSES, lm.WORDS), np.float32))
    every = np.concatenate([words, np.arange(lm.OPEN, dtype=np.uint64)])  # and each open class as a whole
    hashes = np.repeat(lm.features(np.array([5, 6, 7], np.uint64), np.array([0, 1, 2]))[:, 2:], len(every), axis=1)
    assert math.isclose(np.exp(lm.log_chances(model, hashes, *model.place(every))).sum(), 1, rel_tol=1e-4)


def test_words_over_the_end_of_a_piece_are_whole():
    """Ids by the definition: a polynomial sum, the length, and the last two bytes."""
    def plain(word):
        total = sum(int(lm._NUMBER[b]) * pow(lm._BASE, i, 1 << 64) for i, b in enumerate(word)) + len(word) - 1
        ends = word[-1] * 256 + (word[-2] if len(word) > 1 else 0)
        whole, suffix = (int(lm._mixed(np.array([x % (1 << 64)], np.uint64))[0]) for x in (total, ends))
        return whole // lm.OPEN * lm.OPEN + suffix % lm.OPEN

    piece, power = lm._PIECE, [1]
    letters = np.random.default_rng(7).integers(97, 123, 1 << 22, dtype=np.uint8).tobytes()
    large = letters[: 2 * piece + 12345]
    for _ in range(len(large)):
        power.append(power[-1] * lm._BASE % (1 << 64))
    sums = lambda word: sum(int(lm._NUMBER[b]) * p for b, p in zip(word, power, strict=False))
    first = [b"Ab"] * ((piece - 50_000) // 3)
    words = [*first, letters[:100_000], b"c", large, b"d"]
    texts = [b" ".join(words), b"x" * 7, b"", b"e" * (piece - 3), b"fg"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids, counts = lm.tokens(data, offsets)
    assert counts.tolist() == [len(words) + 1, 2, 1, 2, 2]
    total = sums(large) + len(large) - 1
    whole = int(lm._mixed(np.array([total % (1 << 64)], np.uint64))[0]) // lm.OPEN
    assert [int(x) // lm.OPEN for x in ids[len(first) + 2 : len(first) + 3]] == [whole]
    end = int(lm.END)
    assert ids[len(first)] == plain(letters[:100_000]) and ids[0] == plain(b"ab")
    assert ids[len(first) + 3 : len(first) + 8].tolist() == [plain(b"d"), end, plain(b"x" * 7), end, end]
    # Wherever a piece ends, at the edges of words and texts too.
    for cut in range(2, 9):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lm, "_PIECE", cut)
            small = [b"ab cde  f", b"ghijklmnopqrst", b"", b"uv", b" w"]
            flat = np.frombuffer(b"".join(small), np.uint8)
            ids, counts = lm.tokens(flat, np.concatenate([[0], np.cumsum([len(t) for t in small])]))
        want = [x for t in small for x in [*map(plain, t.split()), end]]
        assert ids.tolist() == want and counts.tolist() == [len(t.split()) + 1 for t in small]


def test_every_word_seen_often_has_weights(spark):
    """Words beyond the most frequent 1,024 get the chance that the word before them gives."""
    rng = np.random.default_rng(9)
    pairs_ = [(f"first{i}", f"second{i}") for i in range(1500)]
    order = rng.permutation(np.repeat(np.arange(1500), 24))
    texts = [" ".join(f"{pairs_[j][0]} {pairs_[j][1]}" for j in order[i : i + 40].tolist()) for i in range(0, len(order), 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = lm.block_words(docs.select(F.lit(0).cast("long").alias("block"), F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text")))
    model = lm.start_model(counts.select("id", "n").cache())
    assert len(model.words) + len(model.tree.words) == 3001 and model.tree.sizes.sum() == len(model.tree.words)
    trainer = lm.Trainer(model)
    ids, sizes = lm.tokens(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)]))
    for _ in range(4):
        trainer.learn(ids, lm._before(sizes))
    learnt = trainer.model
    hashes, (kind, place), (leaf, own) = lm.features(ids, lm._before(sizes)), learnt.place(ids), learnt.tree.leaf(ids)
    rare = np.flatnonzero(own & (place < 0) & (lm._before(sizes) % 2 == 1))  # second words
    chance = lambda tree: tree.log_chances(hashes[:, rare], kind[rare] - lm.CLASSES, leaf[rare]).mean()
    assert len(rare) > 10_000 and chance(learnt.tree) > chance(model.tree) + 1
    # After any words, a class's leaves add up to one.
    for open_ in range(lm.OPEN):
        every = np.arange(learnt.tree.sizes[open_] + 1)
        same = np.repeat(hashes[:, 7:8], len(every), axis=1)
        assert math.isclose(np.exp(learnt.tree.log_chances(same, np.full(len(every), open_), every)).sum(), 1, rel_tol=1e-5)
    assert lm._size(lm._ROWS, lm._ROWS_PER_WORD * 1_000_000) > lm._ROWS


def test_sharding(documents):
    rows = pairs(documents)
    got = sharding.shard(documents, shards=5).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (id_, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for id_, t in rows
    )
    for number in range(5):
        slots = sorted(r["slot"] for r in got if r["shard"] == number)
        assert slots == list(range(len(slots)))
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


@pytest.mark.parametrize("seed", range(4))
def test_smallest_capacity(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "_FIRST_BITS", 2)
    rng = np.random.default_rng(seed)
    groups = np.sort(rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64))
    sizes = rng.integers(1, 100, 40)
    sizes[seed] = 900 if seed % 2 else sizes[seed]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    best = upto[1:].astype(float)
    for _ in range(5):
        best = np.array([min([best[j], *(max(best[i], upto[j + 1] - upto[i + 1]) for i in range(j))]) for j in range(40)])
    frame = spark.createDataFrame([(int(g), int(z)) for g, z in zip(groups, sizes, strict=True)], "group long, size long")
    capacity, cuts = sharding.capacity_and_cuts(frame, 6)
    loads = np.bincount(np.searchsorted(np.array(cuts), groups, side="right"), sizes, minlength=6)
    assert capacity == best[-1] and loads.max() <= capacity


def test_top_k(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(40)]  # ties
    rows += [(300, None), (320, [1.0, float("nan")] * 4), (340, [None] * 8), (360, [float("inf")] * 8), (None, rows[0][1])]
    rows += [(380, [0.5, -1e30]), (400, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    whole = {
        i: [max(-(1 << 24), min(1 << 24, math.floor(64 * x) if abs(x) < 1e20 else int(math.copysign(1 << 30, x)))) for x in v]
        for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    want = []
    for q, x in whole.items():
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in whole.items() if i != q)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:20])]
    assert sorted(tuple(r) for r in topk.top_k(frame).collect()) == sorted(want)
    index = topk.build_index(frame, block_rows=16).cache()
    queries = topk.quantised(frame, 64, "embedding", "vec_id").where("vec_id % 20 = 0")
    assert sorted(tuple(r) for r in topk.search(index, queries, group_queries=4).collect()) == sorted(want)


def test_top_k_of_large_components(spark):
    """Scores by the contract: no component is held to a bound, empty vectors take part."""
    rng = np.random.default_rng(16)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.integers(0, 7)).tolist()) for i in range(120)]
    # Differences within a dimension that pass a long, under queries that are zero there.
    rows += [(200, [0.0] * 6), (221, [1.4e17, 0.0]), (222, [-1.4e17, 0.0]), (240, []), (301, [])]
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    small = {i: x for i, x in whole.items() if i not in (221, 222)}

    def best(held, asked):
        want = []
        for q in asked:
            scored = sorted((-sum(a * b for a, b in zip(held[q], y, strict=False)), i) for i, y in held.items() if i != q)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:20])]
        return sorted(want)

    made = topk.top_k(frame.where("vec_id not in (221, 222)"), whole=True)
    assert sorted(map(tuple, made.collect())) == best(small, [q for q in small if q % 20 == 0])
    index = topk.build_index(frame, whole=True)
    zero = topk.quantised(frame, 64, "embedding", "vec_id", whole=True).where("vec_id in (200, 240)")
    assert sorted(map(tuple, topk.search(index, zero).collect())) == best(whole, [200, 240])
    x = np.array([[v[0]] for v in ([9 << 58], [-(9 << 58)], [5])], np.int64)
    least, widths, planes = topk.slices(x)
    block = topk.Block(3, 1, planes.tobytes(), widths.tobytes(), least.tobytes(), np.arange(3, dtype="<i8").tobytes())
    assert block.best(9, np.array([-(1 << 62)]), 3) == [(9 << 120, 1), (-(5 << 62), 2), (-(9 << 120), 0)]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup(documents, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    rows = [(i, (t or "").encode()) for i, t in pairs(documents)]
    order = lambda i: -1 if i is None else i
    first = {}
    for id_, text in rows:
        for at in range(len(text) - 49):
            key = text[at : at + 50]
            first[key] = min(first.get(key, 1 << 60), order(id_))
    want = Counter()
    for id_, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - 49):
            if first[text[at : at + 50]] < order(id_):
                gone[at : at + 50] = True
        kept = bytes(b for b, g in zip(text, gone, strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        want[id_, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    made = suffix_dedup.remove_repeats(documents)
    got = made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(tuple(r) for r in got) == want
    assert made.select(F.sum(F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, x: a + x))
                       ).first()[0] == sum(k[2] * n for k, n in want.items())


def test_winnowing(documents):
    rows = sorted(((-1 if i is None else i, t or "") for i, t in pairs(documents)))
    got = winnowing.against_next(documents).collect()
    want = Counter()
    for (id_, text), (_, following) in zip(rows, [*rows[1:], rows[0]], strict=True):
        part = len(text) // 4
        other = text[: len(text) - part] + following[:part]
        want[None if id_ < 0 else id_, len(text), hashlib.sha256(other.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in got)
    assert all((r["fingerprint"] == r["edited_fingerprint"]) <= (r["near_edited"] == 1) for r in got)


def test_winnowing_keeps_rightmost_least():
    rng = np.random.default_rng(8)
    for letters in ("a", "ab", "abcé"):
        for size in (0, 1, 3, 4, 9, 60):
            text = "".join(rng.choice(list(letters), size))
            hashes, positions = winnowing.winnow(text, 4, 5)
            grams = [text[i : i + 4] for i in range(max(1, size - 3))] if text else []
            own = [int(winnowing.winnow(g, 4, 1)[0][0]) for g in grams]
            window = min(5, len(own)) or 1
            want = {max(range(j, j + window), key=lambda i: (-own[i], i)) for j in range(len(own) - window + 1)}
            assert positions.tolist() == sorted(want) and hashes.tolist() == [own[i] for i in sorted(want)]


def test_mixing(documents):
    """Budgets by handing shortages to siblings again and again."""
    size = {"src0": 3, "src1": 1, "src2": 1}
    levels = {"half": F.when(F.col("source") == "src0", "first").otherwise("second"), "origin": F.col("source")}
    weights = [F.expr("case half when 'first' then 4 else 1 end"), F.expr("case origin when 'src1' then 2 else 1 end")]
    tokens = F.length("text")
    made = mixing.mix(documents.where("length(text) < 5000"), levels, weights, tokens, epochs=2, seed=1, named=True)
    given = [(r["source"], r["n"]) for r in documents.where("length(text) < 5000").groupBy("source").agg(
        F.sum(F.greatest(tokens, F.lit(1))).alias("n")).collect()]
    room = {("first" if s == "src0" else "second", s): 2 * n for s, n in given}
    budget = sum(room.values()) // 2

    def fill(nodes, amount):
        taken, open_ = dict.fromkeys(nodes, 0.0), set(nodes)
        while open_ and amount > 1e-9:
            share = amount / sum(nodes[n][1] for n in open_)
            for n in list(open_):
                more = min(share * nodes[n][1], nodes[n][0] - taken[n])
                taken[n] += more
                amount -= more
                if nodes[n][0] - taken[n] < 1e-9:
                    open_.discard(n)
        return taken

    halves = {h: (sum(r for (x, _), r in room.items() if x == h), 4 if h == "first" else 1) for h in ("first", "second")}
    want = {}
    for half, amount in fill(halves, budget).items():
        leaves = {s: (r, 2 if s == "src1" else 1) for (x, s), r in room.items() if x == half}
        want |= fill(leaves, amount)
    got = {r["source"]: r["leaf_budget"] for r in made.select("source", "leaf_budget").distinct().collect()}
    assert size and got.keys() <= want.keys()
    assert all(abs(got[s] - want[s]) <= 2 for s in got) and all(want[s] < 1 for s in want.keys() - got.keys())
    rows = made.select("doc_id", "text", "source", "epoch").collect()
    for source, amount in got.items():
        lengths = [max(1, len(r["text"] or " ")) for r in rows if r["source"] == source]
        assert amount <= sum(lengths) <= amount + max(lengths) * 2
        latest = max(r["epoch"] for r in rows if r["source"] == source)
        assert latest in (0, 1)
