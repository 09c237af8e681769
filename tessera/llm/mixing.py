"""Mixing sources to target weights by Sainte-Lague apportionment (operator 10, DataFrame only).

Each source is cut into shards and each shard, a stream of words in document order, into blocks
of equal tokens.  The targets give each source votes; highest quotients allot it a whole number
of blocks, and again each of its shards an integer quota.  A quota of q out of n blocks takes all
blocks q // n times and, once more, the q % n blocks whose seeded hashes are least.

No step collects a source: a hot one spreads over its shards, sizes are summed before shuffles,
and only sources (a row each) and the shards of one source meet in one window.

Defined results: a null text counts no words and takes none; a null source is a source of its own
and comes last; rows are told apart by their place, so a repeated row is another document; a null
``doc_id`` sorts first in its shard; other columns ride along; an empty table gives no rows; with
no words at all every target and every taken count is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

#: Words of a block, documents of a shard and the most shards of one source.
BLOCK_WORDS = 64
SHARD_DOCS = 64
MOST_SHARDS = 1 << 16
#: No source gets more than this many times its words.
MOST_EPOCHS = 3
SEED = 20240607


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size): weights by order, share of all words, capped.

    A capped source's excess is reshared by weight until none is above its cap: that is the level
    at which the capped and the open shares add up to the whole, found from running sums in the
    order in which sources reach their caps.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * float(most)).withColumn("full", F.col("cap") / F.col("w"))
    capped = Window.orderBy("full", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = (
        s.withColumn("cap_before", F.coalesce(F.sum("cap").over(capped.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("w_from", F.sum("w").over(capped.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("whole", F.sum("source_size").over(every).cast("double"))
        .withColumn("level", (F.col("whole") - F.col("cap_before")) / F.col("w_from"))
    )
    # the first source, in order of caps, that its level doesn't fill sets the level for the rest
    level = F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "level"))).over(every)["level"]
    return s.withColumn("share", level).select("source", "source_size", F.coalesce(F.least("cap", F.col("share") * F.col("w")), F.lit(0.0)).alias("target"))


def sainte_lague(votes: DataFrame, group: list[str], item: list[str], vote: Column, seats: Column, most: Column) -> DataFrame:
    """Add ``quota`` to the items of each group: seats by the highest quotients vote / (2 s + 1).

    All but a few seats of an item are certain: the divisor lies so near to votes per seat that
    only seats within an item's share of half the item count, and one, are contested.  Those
    alone are written out and ranked.
    """
    w = Window.partitionBy(*group)
    v = votes.withColumn("_v", vote.cast("double")).withColumn("_n", seats.cast("long")).withColumn("_most", most.cast("long"))
    v = v.withColumn("_all", F.sum("_v").over(w)).withColumn("_m", F.count("*").over(w))
    share = F.coalesce(F.try_divide("_v", F.col("_all")), F.lit(0.0))
    v = v.withColumn("_lo", F.greatest(F.lit(0), F.floor(share * (F.col("_n") - F.col("_m") / 2) - 1.5)).cast("long"))
    v = v.withColumn("_hi", F.greatest(F.col("_lo"), F.ceil(share * (F.col("_n") + F.col("_m") / 2) + 1.5).cast("long")))
    v = v.withColumn("_left", F.col("_n") - F.sum("_lo").over(w))
    key = [*group, *item]
    seat = v.select(*[c for c in v.columns], F.explode(F.sequence("_lo", "_hi")).alias("_s"))
    best = w.orderBy((F.col("_v") / (2 * F.col("_s") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in item], "_s")
    won = seat.withColumn("_r", F.row_number().over(best)).groupBy(*key, *[c for c in votes.columns if c not in key], "_lo", "_most", "_all").agg(F.sum((F.col("_r") <= F.col("_left")).cast("long")).alias("_won"))
    quota = F.when(F.col("_all") > 0, F.least(F.col("_lo") + F.col("_won"), "_most")).otherwise(F.lit(0)).cast("long")
    return won.withColumn("quota", quota).select(*votes.columns, "quota")


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = SEED, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, ranges) by document.

    ``copies`` whole repeats are taken, and once more the words in ``ranges``, each the first
    word (from 0) and the number of words.
    """
    d = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("h"))
    d = common.stored(d, "mix-sizes")  # the texts are read once; what follows needs their sizes
    per = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    goal = targets(per.select("source", "source_size"), weights)
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    goal = goal.join(per.select(F.col("source").alias("s2"), "n_docs"), same("source", "s2")).drop("s2")
    blocks = F.greatest(F.lit(1), F.round(F.col("source_size") / block_words)).cast("long")
    goal = goal.withColumn("n_shards", F.greatest(F.lit(1), F.least(F.lit(MOST_SHARDS), F.ceil(F.col("n_docs") / shard_docs))).cast("long"))
    every = Window.partitionBy()
    goal = goal.withColumn("one", F.lit(1)).withColumn("seats", F.round(F.sum("source_size").over(every) / block_words).cast("long"))
    goal = sainte_lague(goal, ["one"], ["source"], F.col("target"), F.col("seats"), 3 * blocks + 1).withColumnRenamed("quota", "source_quota")
    goal = common.stored(goal.select("source", "source_size", "target", "n_shards", "source_quota"), "mix-goals")  # a row per source
    g = goal.withColumnRenamed("source", "s2")
    d = d.join(g, same("source", "s2")).drop("s2")
    d = d.withColumn("shard", F.pmod(F.xxhash64("doc_id", "h", F.lit(seed)), F.col("n_shards")))
    stream = Window.partitionBy("source", "shard").orderBy(F.col("doc_id").asc_nulls_first(), "h", "size")
    d = d.withColumn("place", F.row_number().over(stream)).withColumn("end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    d = common.stored(d, "mix-streams")
    shards = d.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    n_blocks = F.greatest(F.lit(1), F.round(F.col("shard_size") / block_words)).cast("long")
    shards = sainte_lague(shards.withColumn("n_blocks", n_blocks), ["source"], ["shard"], F.col("shard_size"), F.col("source_quota"), MOST_EPOCHS * F.col("n_blocks"))
    shards = shards.select(F.col("source").alias("s2"), F.col("shard").alias("h2"), "shard_size", "n_blocks", "quota")
    d = d.join(shards, same("source", "s2") & (F.col("shard") == F.col("h2"))).drop("s2", "h2")
    d = d.withColumn("copies", F.floor(F.col("quota") / F.col("n_blocks")).cast("long")).withColumn("more", F.pmod(F.col("quota"), F.col("n_blocks")))
    # block k of a shard has the words from floor(k size / n) to floor((k + 1) size / n)
    start = F.col("end") - F.col("size")
    first = F.floor(start * F.col("n_blocks") / F.greatest(F.lit(1), "shard_size"))
    last = F.floor((F.col("end") - 1) * F.col("n_blocks") / F.greatest(F.lit(1), "shard_size"))
    d = d.withColumn("first", F.greatest(F.lit(0), first - 1).cast("long")).withColumn("last", F.least(F.col("n_blocks") - 1, last + 1).cast("long"))
    cut = d.where((F.col("size") > 0) & (F.col("more") > 0)).select("source", "shard", "place", "size", "shard_size", "n_blocks", "more", start.alias("start"), "end", F.explode(F.sequence("first", "last")).alias("block"))
    edge = lambda k: F.floor(k * F.col("shard_size") / F.col("n_blocks"))
    cut = cut.withColumn("a", F.greatest("start", edge(F.col("block")))).withColumn("b", F.least("end", edge(F.col("block") + 1)))
    lot = Window.partitionBy("source", "shard").orderBy(F.xxhash64("source", "shard", "block", F.lit(seed)), "block")
    cut = cut.withColumn("lot", F.dense_rank().over(lot)).where((F.col("lot") <= F.col("more")) & (F.col("a") < F.col("b")))
    took = cut.groupBy("source", "shard", "place").agg(F.sort_array(F.collect_list(F.struct((F.col("a") - F.col("start")).alias("at"), (F.col("b") - F.col("a")).alias("n")))).alias("ranges"))
    took = took.select(F.col("source").alias("s2"), F.col("shard").alias("h2"), F.col("place").alias("p2"), "ranges")
    d = d.join(took, same("source", "s2") & (F.col("shard") == F.col("h2")) & (F.col("place") == F.col("p2")), "left")
    none = F.expr("cast(array() as array<struct<at: bigint, n: bigint>>)")
    return d.select("doc_id", "source", "h", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("copies")).otherwise(F.lit(0).cast("long")).alias("copies"), F.coalesce("ranges", none).alias("ranges"))


def taken() -> Column:
    return F.col("copies") * F.col("size") + F.aggregate("ranges", F.lit(0).cast("long"), lambda s, r: s + r["n"])


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each repeat is a row, and the words taken once more are a row.

    A repeat keeps its text as it was; a part keeps its words, joined by one space.
    """
    key = [F.xxhash64("doc_id", "source", "h").alias("_ts_k1"), F.xxhash64("h", "source", "doc_id", F.lit(1)).alias("_ts_k2")]
    p = plan(docs, **options).where((F.col("copies") > 0) | (F.size("ranges") > 0)).select(*key, F.struct("copies", "ranges").alias("_ts_t"))
    names = docs.columns
    text_hash = F.xxhash64("text")
    own = docs.select("*", F.xxhash64("doc_id", "source", text_hash).alias("_ts_k1"), F.xxhash64(text_hash, "source", "doc_id", F.lit(1)).alias("_ts_k2"))
    # rows that repeat a document are one text with the takes of all of them
    got = own.dropDuplicates(["_ts_k1", "_ts_k2"]).join(p, ["_ts_k1", "_ts_k2"])
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({common.WORD})"))
    part = F.array_join(F.flatten(F.transform(F.col("_ts_t")["ranges"], lambda r: F.slice(words, (r["at"] + 1).cast("int"), r["n"].cast("int")))), " ")
    texts = F.concat(F.array_repeat(F.col("text"), F.col("_ts_t")["copies"].cast("int")), F.when(F.size(F.col("_ts_t")["ranges"]) > 0, F.array(part)).otherwise(F.expr("cast(array() as array<string>)")))
    return got.withColumn("_ts_text", F.explode(texts)).select(*[F.col("_ts_text").alias("text") if c == "text" else F.char_length("_ts_text").cast("long").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in names])


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken().alias("taken"))
