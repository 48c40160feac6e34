"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words [^\\x20\\x09-\\x0D]+. Sources, by code point with null last, weigh 3, 1, 2, repeating. They share
`budget` times all words; a target stops at `most` times its source's size and the excess is shared again by weight.

A source is read in passes. In each pass its documents fall into blocks of about block_words words by a seeded hash of
doc_id and text, and the blocks stand in a seeded permutation. All passes but the last draw every block; the last
draws blocks from the front until the target is met and, in the block that straddles it, documents in a seeded order,
the last of them in part. The draws of all sources are then dealt to the output shards by a splitting tree: each node
holds exact numbers of draws by source and sends a multivariate-hypergeometric sample of them, half in number, to its
left. So a shard's composition is that of a random sample while every source's total is exact. A shard takes disjoint
runs of each source's permuted blocks and is shuffled by a seeded hash.

The source list and its quotas live on the driver (a mix is set per source; more than MOST_SOURCES are refused). Block
sums are aggregated before any window, the running sums over a source's permuted blocks are made within CHUNKS ranges
of the permutation and then over the ranges' totals, and only the straddling block of a source is ordered document by
document, so a hot source is never gathered. There is a shard for each SHARD_WORDS words of the mix.

Cases: a null or empty text has size 0 and nothing taken; a source of size 0 has target 0; null sources form one
source; rows that share doc_id, text and source are drawn alike, so where k of them straddle, up to k - 1 words of the
target are left; empty input gives an empty result; columns other than those named are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelight.llm.common import narrow, stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2.0
SHARD_WORDS = 1 << 24
LEAST_SHARDS = 16
MOST_SOURCES = 1_000_000
CHUNKS = 1024
BLOCK_WORDS = 1 << 16
SEED = 20260909


WORD = r"[^\x20\x09-\x0D]+"


def seeded(doc_id, text, seed: int):
    return F.xxhash64(F.lit(seed), doc_id, F.coalesce(text, F.lit("")))


def targets(sizes: list[int], weights: list[float], budget: float, most: float) -> list[float]:
    """Weighted shares of budget * sum(sizes), none above most * its size; the excess goes to the others by weight."""
    total, out, open_ = budget * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if total * weights[i] / weight > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = total * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
        total -= sum(out[i] for i in full)
        open_ -= full
    return out


def splitting_tree(draws: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """draws: by source. Returns (shards, sources): exact quotas that add up to draws."""
    if shards == 1:
        return draws[None, :]
    left = shards // 2
    n = int(draws.sum()) * left // shards
    part = rng.multivariate_hypergeometric(draws, n, method="marginals") if draws.sum() else draws
    return np.vstack([splitting_tree(part, left, rng), splitting_tree(draws - part, shards - left, rng)])


def _upto(number, borders):
    """How many of an ascending array's values are at most the number, by bisection."""
    step = lambda s, _: F.when(s["lo"] < s["hi"], F.when(F.get(borders, F.floor((s["lo"] + s["hi"]) / 2).cast("int")) <= number, F.struct((F.floor((s["lo"] + s["hi"]) / 2) + 1).cast("int").alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi")))).otherwise(s)
    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(F.lit(0).alias("lo"), F.size(borders).alias("hi")), step)["lo"]


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, shards: int | None = None, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, h (its seeded hash), source, size, source_size, target, taken, and draws: an
    array of (pass, shard, position, words) for its output records, position being its place in the shard's shuffle.
    taken is the sum of the records' words."""
    spark = docs.sparkSession
    docs = narrow(docs, "doc_id", "text", "source").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), seeded(F.col("doc_id"), F.col("text"), seed).alias("h")
    )
    docs = stored(docs, "mix-sizes")  # the texts are read once
    # one row for each source: the mix is configured by source, on the driver
    found = docs.groupBy("source").agg(F.sum("size").alias("source_size")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: set the mix by coarser ones")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r.source_size) for r in found]
    goal = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(sizes))], budget, most)
    whole = [int(t // n) if n else 0 for t, n in zip(goal, sizes, strict=True)]
    rest = [round(t - k * n) for t, k, n in zip(goal, whole, sizes, strict=True)]
    blocks = [max(1, -(-n // block_words)) for n in sizes]
    plan = spark.createDataFrame(
        [(r.source, n, t, k, w, b) for r, n, t, k, w, b in zip(found, sizes, goal, whole, rest, blocks, strict=True)],
        "p_source string, source_size long, target double, whole int, rest long, blocks int",
    )
    docs = docs.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source").withColumn("block", F.pmod("h", F.col("blocks").cast("long")).cast("int"))

    # the last pass: whole blocks in permuted order up to the rest, then part of the straddling one
    name = F.coalesce(F.col("source"), F.lit("\0"))
    sums = docs.groupBy("source", "block", "whole", "rest", "blocks").agg(F.sum("size").alias("words")).where("words > 0")
    sums = sums.withColumn("place", F.xxhash64(F.lit(seed), name, "block")).withColumn("chunk", F.pmod(F.shiftrightunsigned("place", 32), F.lit(CHUNKS)).cast("int"))
    chunks = sums.groupBy(F.col("source").alias("c_source"), F.col("chunk").alias("c_chunk")).agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    earlier = Window.partitionBy("c_source").orderBy("c_chunk").rowsBetween(Window.unboundedPreceding, -1)  # CHUNKS rows a source
    chunks = chunks.select("c_source", "c_chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("w_before"))
    within = Window.partitionBy("source", "chunk").orderBy("place", "block")
    sums = sums.withColumn("rank", F.row_number().over(within)).withColumn("upto", F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    sums = sums.join(chunks, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("chunk") == F.col("c_chunk"))).withColumn("rank", F.col("rank") + F.col("n_before")).withColumn("upto", F.col("upto") + F.col("w_before"))
    sums = sums.withColumn("quota", F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("upto") + F.col("words"))))
    sums = stored(sums.select("source", "block", "rank", "quota", "words"), "mix-blocks")  # blocks with words

    # quotas of draws (a block in a pass) by source and shard; a tree on the driver over one number for each source
    drawn = {r.source: (int(r.b), int(r.n)) for r in sums.groupBy("source").agg(F.count("*").alias("b"), F.count(F.when(F.col("quota") > 0, 1)).alias("n")).collect()}
    draws = np.array([k * drawn.get(r.source, (0, 0))[0] + drawn.get(r.source, (0, 0))[1] for r, k in zip(found, whole, strict=True)], dtype=np.int64)
    shards = shards or max(LEAST_SHARDS, -(-int(sum(goal)) // SHARD_WORDS))
    upto_shard = np.cumsum(splitting_tree(draws, shards, np.random.default_rng(seed)), axis=0) if len(draws) else np.zeros((shards, 0), np.int64)
    borders = spark.createDataFrame([(r.source, drawn.get(r.source, (0, 0))[0], upto_shard[:, i].tolist()) for i, r in enumerate(found)], "b_source string, in_pass long, borders array<long>")

    # a draw's number among its source's draws: passes before it * blocks in a pass + the block's rank; so its shard
    rows = sums.join(F.broadcast(plan.select("p_source", "whole")), F.col("source").eqNullSafe(F.col("p_source"))).join(F.broadcast(borders), F.col("source").eqNullSafe(F.col("b_source")))
    number = lambda k: k * F.col("in_pass") + F.col("rank") - 1
    shard_of = F.transform(F.sequence(F.lit(0), F.col("whole")), lambda k: _upto(number(k), F.col("borders")))
    by_block = rows.select(F.col("source").alias("s_source"), F.col("block").alias("s_block"), "quota", "words", shard_of.alias("shard_of"))
    docs = docs.join(by_block, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("block") == F.col("s_block")), "left").drop("s_source", "s_block").withColumn("quota", F.coalesce("quota", F.lit(0)))
    partial = (F.col("quota") > 0) & (F.col("quota") < F.coalesce("words", F.lit(0)))
    inner = Window.partitionBy("source", "block").orderBy("h", "doc_id")  # by range: rows alike get one sum
    alike = Window.partitionBy("source", "block", "h", "doc_id")
    straddling = docs.where(partial).withColumn("copies", F.count("*").over(alike)).withColumn("before", F.sum("size").over(inner) - F.col("size") * F.col("copies"))
    straddling = straddling.withColumn("extra", F.greatest(F.lit(0), F.least("size", F.floor((F.col("quota") - F.col("before")) / F.col("copies"))))).drop("before", "copies")
    others = docs.where(~partial).withColumn("extra", F.when(F.col("quota") > 0, F.col("size")).otherwise(F.lit(0)).cast("long"))
    docs = others.unionByName(straddling)

    record = lambda k, words: F.struct(k.alias("pass"), F.get("shard_of", k).alias("shard"), F.xxhash64(F.lit(seed + 1), k, "h").alias("position"), words.alias("words"))
    passes = F.when(F.col("whole") > 0, F.transform(F.sequence(F.lit(0), F.col("whole") - 1), lambda k: record(k, F.col("size"))))
    last = F.when(F.col("extra") > 0, F.array(record(F.col("whole"), F.col("extra"))))
    none = F.array().cast("array<struct<pass:int,shard:int,position:bigint,words:bigint>>")
    all_draws = F.when(F.col("size") > 0, F.concat(F.coalesce(passes, none), F.coalesce(last, none))).otherwise(none)
    out = docs.select("doc_id", "h", "source", "size", "source_size", "target", all_draws.alias("draws"))
    return out.withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))


def mixed_records(mixed: DataFrame) -> DataFrame:
    """The output records: shard, position, doc_id, source, h, size, pass, words. By shard and, in it, by position they
    are the mix: the first `words` words of a document are taken."""
    one = mixed.select("doc_id", "source", "h", "size", F.explode("draws").alias("d"))
    return one.select("d.shard", "d.position", "doc_id", "source", "h", "size", "d.pass", "d.words")


def drawn(docs: DataFrame) -> DataFrame:
    """docs (all columns, among them doc_id, text, source and n_chars) as the mix has them: a row for each record, dealt
    by shard and in the shards' shuffled order within each partition. A document drawn in part keeps its first words,
    single-spaced."""
    once = mixed_records(mix(docs)).select("doc_id", "source", "h", "shard", "position", "words", "size").distinct()  # rows that are alike have the same records
    once = once.select(*[F.col(c).alias(f"ql__m_{c}") for c in once.columns])
    rows = docs.withColumn("ql__h", seeded(docs["doc_id"], docs["text"], SEED))
    rows = rows.join(once, F.col("doc_id").eqNullSafe(F.col("ql__m_doc_id")) & (F.col("ql__h") == F.col("ql__m_h")) & F.col("source").eqNullSafe(F.col("ql__m_source")))
    text = F.when(F.col("ql__m_words") < F.col("ql__m_size"), F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("ql__m_words").cast("int")), " ")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.repartition("ql__m_shard").sortWithinPartitions("ql__m_shard", "ql__m_position", "doc_id").select(*docs.columns)


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken; and of the records that make up what was taken: how many, and the least
    shard with the place in its shuffle."""
    first = F.array_min(F.transform("draws", lambda d: F.struct(d["shard"].alias("shard"), d["position"].alias("position"))))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", F.size("draws").alias("n_draws"), first["shard"].alias("shard"), first["position"].alias("position"))
