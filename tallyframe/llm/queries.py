"""The registered queries of the operators, over whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, crosspolytope, line_dedup, lm, mixing, periodic, quality, sharding, simhash, suffix_dedup, topk, whitening, winnowing
from tallyframe.llm.rows import small_batches

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def registered(function):
    _QUERIES[function.__name__] = function
    return function


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def llm_oracles() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary() -> tuple[list[bytes], str]:
    """The ranks and the pattern that the public tokenizer files name."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


@registered
def op1_max_entropy(spark, folder):
    """Log probabilities of documents, learnt from six folds of seven."""
    return lm.score(table(spark, folder, "documents"))


@registered
def op2_line_dedup(spark, folder):
    """Documents without lines that three or more share, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_shared_lines(docs, documents=3, shortest=20, by_id=True).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


_SQL["op2_line_dedup"] = """
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), lines as (
  select doc_id, unnest(parts) as line, unnest(range(len(parts))) as number from split
), keyed as (
  select *, translate(
    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), shared as (
  select key, max(doc_id) as last from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
), marked as (
  select k.doc_id, k.line, k.number, s.key is not null and k.doc_id <> s.last as gone
  from keyed k left join shared s on k.key = s.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by number) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


@registered
def op3_quality(spark, folder):
    """Quality of each document by a field over its lines, fitted on four folds of five."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~quality.in_fold(F.col("doc_id")))
    return quality.score(docs, quality.fit_on(docs, labels)).select(
        "doc_id", quality.in_fold(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@registered
def op4_byte_bpe(spark, folder):
    """Ids of each document and the text they decode to, as digests."""
    ranks, pattern = vocabulary()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, pattern).select("doc_id", "n_tokens", "ids")
    return bpe.decode(coded, ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


#: The tree of sources, and the weight of each node among its siblings, as SQL that
#: both engines read. The first level is a rule on the source's name.
LEVELS = {
    "domain": "case when source = 'src0' then 'web' when length(source) = 4 then 'books' else 'code' end",
    "language": "lang",
    "origin": "source",
}
WEIGHTS = (
    "case domain when 'web' then 4 else 3 end",
    "case language when 'en' then 6 when 'de' then 3 else 2 end",
    "case when length(origin) = 4 then 2 else 1 end",
)


def mixture(docs: DataFrame, named: bool = False) -> DataFrame:
    """The mixture of the documents' sources in as many words as there are, at most twice."""
    return mixing.mix(
        docs, {name: F.expr(rule) for name, rule in LEVELS.items()}, [F.expr(w) for w in WEIGHTS],
        mixing.word_tokens(F.col("text")), epochs=2, seed=17, named=named,
    )


@registered
def op5_mixing(spark, folder):
    """Which documents each epoch of the mixture takes, and their source's budget."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return mixture(docs, named=True).select("doc_id", "lang", "source", "epoch", "leaf_budget")


def _mixing_sql() -> str:
    levels = ", ".join(f"{rule} as {name}" for name, rule in LEVELS.items())
    names = list(LEVELS)
    steps = [
        f"""docs as (
  select doc_id, {levels},
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) as size
  from documents
), level0 as (
  select {", ".join(names)}, sum(size) * 2 as room,
    {", ".join(f"{w} as w{i + 1}" for i, w in enumerate(WEIGHTS))},
    cast((select sum(size) from docs) as double) as budget
  from docs group by {", ".join(names)}
)"""
    ]
    for i in range(1, len(names) + 1):
        path, above = ", ".join(names[:i]), ", ".join(names[: i - 1])
        within = f"partition by {above}" if above else ""
        same = " and ".join(f"g.{n} is not distinct from s.{n}" for n in names[:i])
        steps.append(f"""nodes{i} as (
  select {path}, cast(sum(room) as double) as room, cast(max(w{i}) as double) as weight, max(budget) as parent
  from level{i - 1} group by {path}
), filled{i} as (
  select *, greatest(parent - coalesce(sum(room) over (f rows between unbounded preceding and 1 preceding), 0), 0) as lft,
    sum(weight) over (f rows between current row and unbounded following) as rest
  from nodes{i} window f as ({within} order by room / weight, {path})
), shares{i} as (
  select {path}, room, weight, min(case when lft * weight < room * rest then lft / rest end) over ({within}) as shortage,
    max(case when lft * weight < room * rest then rest end) over ({within}) as open_rest,
    max(case when lft * weight < room * rest then lft end) over ({within}) as open_left,
    lft * weight >= room * rest as fills
  from filled{i}
), level{i} as (
  select g.* replace (case when s.fills then s.room else floor(s.open_left * s.weight / s.open_rest) end as budget)
  from level{i - 1} g join shares{i} s on {same}
)""")
    return "with " + ", ".join(steps) + f""", placed as (
  select docs.*, epoch, sum(size) over (
      partition by {", ".join(names)} order by epoch, md5('17:' || epoch || ':' || doc_id)) - size as before
  from docs, range(2) as r(epoch)
)
select doc_id, p.language as lang, p.origin as source, cast(epoch as int) as epoch, cast(budget as bigint) as leaf_budget
from placed p join level{len(names)} l
  on {" and ".join(f"p.{n} is not distinct from l.{n}" for n in names)}
where before < budget
"""


_SQL["op5_mixing"] = _mixing_sql()


@registered
def op6_sharding(spark, folder):
    """24 shards of near equal bytes that keep equal texts together."""
    return sharding.shard(table(spark, folder, "documents"), shards=24)


@registered
def op7_top_k(spark, folder):
    """The 20 best inner products of every twentieth vector with all others."""
    return topk.top_k(table(spark, folder, "embeddings"), k=20, scale=64, every=20, whole=True)


_SQL["op7_top_k"] = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as x
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@registered
def op8_suffix_dedup(spark, folder):
    """Documents without bytes that 50-byte strings of earlier ones cover, as digests."""
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@registered
def op9_winnowing(spark, folder):
    """Fingerprints of documents, of their edited texts, and how like they are."""
    return winnowing.against_next(table(spark, folder, "documents"))


@registered
def op10_simhash(spark, folder):
    """SimHash fingerprints of 3-word shingles, linked at two bits."""
    return simhash.near_copies(table(spark, folder, "documents"), shingle=3, radius=2)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents, of every tenth hash of ids the words from some place on repeating those there."""
    id_hash = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size("_words"), F.floor(F.col("_hash") / 10)
    first = (g % n).cast("int")
    period = (F.floor((n - F.col("_first")) / (g % 8 + 3)) + 1).cast("int")
    place = lambda i: F.when(i < F.col("_first"), i).otherwise(F.col("_first") + (i - F.col("_first")) % F.col("_period"))
    planted = F.concat_ws(" ", F.transform("_words", lambda w, i: F.get("_words", place(i))))
    held = docs.withColumn("_hash", id_hash).withColumn("_words", F.when(F.col("_hash") % 10 == 0, words))
    held = held.withColumn("_first", F.when(n > 0, first)).withColumn("_period", F.when(n > 0, period))
    return held.withColumn("text", F.when(F.col("_period").isNotNull(), planted).otherwise(F.col("text"))).select(*docs.columns)


@registered
def op12_periodic_runs(spark, folder):
    """Periodic runs of words in documents, some of them planted, and what is left without them."""
    docs = with_planted_runs(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs, least=12).withColumn("best", periodic.greatest_run("runs"))
    line = lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@registered
def op11_cross_polytope(spark, folder):
    """Groups of vectors that links at a cosine of 0.9 join."""
    return crosspolytope.near_vectors(table(spark, folder, "embeddings"), cosine=0.9)


_SQL["op11_cross_polytope"] = """
with recursive good as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.9
), reach as (
  select distinct a as node, a as other from links
  union
  select r.node, l.b as other from reach r join links l on r.other = l.a
), counted as (
  select a, count(*) as n from links group by a
), least as (
  select node, min(other) as least from reach group by node
)
select e.vec_id, coalesce(c.n, 0) as n_links, coalesce(l.least, e.vec_id) as component_id,
  e.vec_id = coalesce(l.least, e.vec_id) as kept
from embeddings e left join counted c on c.a = e.vec_id left join least l on l.node = e.vec_id
"""


@registered
def op13_whitening(spark, folder):
    """Vectors whitened by the eight leading eigenvectors of their covariance, a row each."""
    rows, model, error = whitening.whiten(table(spark, folder, "embeddings"), components=8, scale=1024, offset=100_000)
    shares = F.lit([v / model.trace for v in model.values.tolist()] if model else []).cast("array<double>")
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.mean.n if model else 0).cast("long").alias("n"),
        "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
