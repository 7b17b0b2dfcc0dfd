"""Mixing sources to target weights by Sainte-Laguë apportionment.

All words are dealt in equal blocks.  The blocks of the whole mix are
apportioned to the sources by highest quotients ``target / (2 * seats + 1)``,
those of a source to its shards in the same way by shard size, so every shard
has an integer quota.  A shard is a hash class of about ``shard_rows``
documents of one source; its documents are put in a seeded order on one line
of words, which is cut into blocks.  A quota of ``m`` whole turns and ``r``
more takes every block ``m`` times and the ``r`` blocks from a seeded start on
once more.  As the chosen blocks follow each other, all but two documents of a
shard are taken whole times, and what a document gives is the overlap of its
interval with the chosen stretch: no row is made for a block.

Highest quotients without a row for each seat: starting from the rounded
quotas, which miss the sum by at most half the number of parties, only the
quotients next to them can decide, and a party of share ``p`` of ``n`` parties
needs at most ``1.5 p n + 2`` of them.

Everything is DataFrame functions.  A source that holds a third of all rows is
split over many shards.  Sums are of integers, so reruns agree exactly.

Defined results: a null text has size 0; sources go by code point, null last,
as a source of its own; targets and takes are 0 when nothing has a word; an
empty table gives an empty table; repeated rows and equal or null ids are rows
of their own; other columns are ignored by ``shares`` and kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canopy.llm.common import WORD_PATTERN, stored

#: A table of at most so many rows of shards may be broadcast; a row is under 200 bytes beside its source's name.
BROADCAST_ROWS = 5_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def seeded(seed: int, *parts: Column) -> Column:
    """A reproducible number under 2^60 (the first 15 hex digits of an md5)."""
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Never null, and in the order of the sources with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def apportion(df: DataFrame, by: list[str], party: str, votes: str, seats: str, total: str, out: str) -> DataFrame:
    """``df`` with the seats of each party in column ``out``.

    ``by``: columns of a group (one election); ``votes`` of at least 0 that sum
    up to ``total``; ``seats``: how many the group has.  Equal quotients go to
    the party first in order.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    share = F.coalesce(F.try_divide(F.col(votes).cast("double"), F.col(total).cast("double")), F.lit(0.0))
    start = df.withColumn("_share", share).withColumn("_base", F.floor(F.col("_share") * F.col(seats) + 0.5))
    start = start.withColumn("_n", F.count(F.lit(1)).over(group))
    start = start.withColumn("_missing", F.col(seats) - F.sum("_base").over(group))
    steps = F.sequence(F.lit(0), (F.floor(F.col("_share") * F.col("_n") * 1.5) + 1).cast("int"))
    near = start.where((F.col("_missing") != 0) & (F.col("_share") > 0)).select(
        *by, party, votes, "_base", "_missing", F.explode(steps).alias("_k")
    )
    more = F.col("_missing") > 0
    divisor = F.when(more, 2 * (F.col("_base") + F.col("_k")) + 1).otherwise(2 * (F.col("_base") - F.col("_k")) - 1)
    quotient = F.col(votes).cast("double") / divisor
    near = near.where(more | (F.col("_k") < F.col("_base"))).withColumn("_order", F.when(more, -quotient).otherwise(quotient))
    # of equal quotients the first party's comes first, so the last party's seat goes first
    ties = F.when(F.col("_missing") > 0, F.col(party)).asc(), F.when(F.col("_missing") < 0, F.col(party)).desc()
    rank = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_order", *ties)
    chosen = near.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= F.abs("_missing"))
    moved = chosen.groupBy(*by, party).agg(F.sum(F.signum("_missing")).cast("long").alias("_moved"))
    joined = start.join(moved, [*by, party], "left")
    return joined.withColumn(out, (F.col("_base") + F.coalesce("_moved", F.lit(0))).cast("long")).select(*df.columns, out)


def source_targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """``key, n_docs, source_size, all_size, target`` of each source.

    Targets share the sum of all sizes by weight; those above ``cap`` times
    their source's size stop there and the rest is shared again.  Going
    through the sources by ``cap * size / weight``, a source stops if its
    share of what is left over would be above its cap.
    """
    by_source = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(every.orderBy("key")) - 1) % len(weights) + 1)
    t = by_source.withColumn("weight", weight.cast("long")).withColumn("cap", cap * F.col("source_size"))
    t = t.withColumn("all_size", F.sum("source_size").over(every)).withColumn("all_weight", F.sum("weight").over(every))
    before = every.orderBy(F.col("cap").cast("double") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    size_left = F.col("all_size") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    share = F.col("weight") * size_left.cast("double") / weight_left
    t = t.withColumn("stops", F.col("cap").cast("double") <= share)
    stopped_size = F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(every), F.lit(0))
    stopped_weight = F.coalesce(F.sum(F.when(F.col("stops"), F.col("weight"))).over(every), F.lit(0))
    rest = F.col("weight") * (F.col("all_size") - stopped_size).cast("double") / (F.col("all_weight") - stopped_weight)
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(rest)
    return t.withColumn("target", target).select("key", "n_docs", "source_size", "all_size", "target")


def joined_small(df: DataFrame, small: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    return df.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def shard_plan(sizes: DataFrame, weights: Sequence[int], cap: int, block_words: int, shard_rows: int, seed: int):
    """The sources' table, and of each shard its quota, number of blocks and first extra block."""
    targets = source_targets(sizes, weights, cap)
    blocks = F.round(F.col("all_size") / block_words).cast("long")
    sources = apportion(targets.withColumn("all_blocks", blocks), [], "key", "target", "all_blocks", "all_size", "seats")
    sources = sources.withColumn("n_shards", F.ceil(F.col("n_docs") / shard_rows).cast("long"))
    sources = stored(sources.select("key", "n_shards", "source_size", "target", "seats"), "mix-sources")
    n = sources.count()
    dealt = joined_small(sizes, sources, ["key"], n).withColumn("shard", F.expr("pmod(draw, n_shards)"))
    shards = dealt.groupBy("key", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("seats").alias("seats"),
        F.first("target").alias("target"),
    )
    shards = apportion(shards, ["key"], "shard", "shard_size", "seats", "source_size", "quota")
    shards = shards.withColumn("n_blocks", F.ceil(F.col("shard_size") / block_words).cast("long"))
    shards = shards.withColumn("quota", F.least("quota", cap * F.col("n_blocks")))
    first = F.expr("pmod(draw, greatest(n_blocks, 1))")
    shards = shards.withColumn("draw", seeded(seed + 1, F.col("key"), F.col("shard").cast("string")))
    shards = shards.withColumn("first_block", first).select(
        "key", "shard", "source_size", "target", "shard_size", "quota", "n_blocks", "first_block"
    )
    return sources, n, stored(shards, "mix-shards")


def taken_words(block_words: int) -> Column:
    """Of a document at ``[start, start + size)`` of its shard's line."""
    size, start = F.col("size"), F.col("start")
    turns = F.expr("quota div greatest(n_blocks, 1)")
    extra = F.col("quota") - turns * F.col("n_blocks")

    def overlap(begin: Column, end: Column) -> Column:
        end = F.least(end * block_words, F.col("shard_size"))
        return F.greatest(F.least(start + size, end) - F.greatest(start, begin * block_words), F.lit(0))

    last = F.col("first_block") + extra
    wrapped = F.greatest(last - F.col("n_blocks"), F.lit(0))  # beyond the end the stretch goes on from the start
    return (turns * size + overlap(F.col("first_block"), last) + overlap(F.lit(0), wrapped)).cast("long")


def placed_rows(named: DataFrame, weights, cap, block_words, shard_rows, seed) -> DataFrame:
    """``named`` (``key, size, id`` and more) with ``source_size, target, taken``; one shuffle of its rows, by shard."""
    text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    named = named.withColumn("draw", seeded(seed, text))
    narrow = named.select("key", "draw", "size")
    sources, n, shards = shard_plan(narrow, weights, cap, block_words, shard_rows, seed)
    dealt = joined_small(named, sources.select("key", "n_shards"), ["key"], n)
    dealt = dealt.withColumn("shard", F.expr("pmod(draw, n_shards)")).join(shards, ["key", "shard"])
    line = Window.partitionBy("key", "shard").orderBy(seeded(seed + 2, text), "id", "size")
    upto = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return dealt.withColumn("start", upto - F.col("size")).withColumn("taken", taken_words(block_words))


def shares(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    cap: int = 3,
    block_words: int = 4,
    shard_rows: int = 2_000,
    seed: int = 11,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; texts are read once and never shuffled."""
    named = df.select(
        F.col(id_col).alias("id"), source_key(F.col(source_col)).alias("key"), word_count(F.col(text_col)).alias("size")
    )
    placed = placed_rows(stored(named, "mix-sizes"), weights, cap, block_words, shard_rows, seed)
    return placed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def mixed(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    cap: int = 3,
    block_words: int = 4,
    shard_rows: int = 2_000,
    seed: int = 11,
) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them: whole times of the
    text, a part of at least a half counting as one.  A source of which only
    smaller parts are taken keeps the document with the largest taken part, so no
    source that has a share is lost; its words are then over its target."""
    named = df.select(
        F.col(id_col).alias("id"),
        source_key(F.col(source_col)).alias("key"),
        word_count(F.col(text_col)).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
    )
    placed = placed_rows(named, weights, cap, block_words, shard_rows, seed)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    placed = placed.withColumn("times", times)
    kept = placed.groupBy("key").agg(
        F.sum(F.col("times") * F.col("size")).alias("kept"), F.max(F.struct("taken", "shard", "start")).alias("most")
    )
    lost = stored(kept.where("kept = 0 and most.taken > 0").select("key", "most"), "mix-lost")
    n_lost = lost.count()
    if n_lost:  # rarely any
        told = joined_small(placed, lost, ["key"], n_lost, "left")
        largest = (F.col("size") > 0) & (F.struct("taken", "shard", "start") == F.col("most"))
        placed = told.withColumn("times", F.when(F.coalesce(largest, F.lit(False)), 1).otherwise(F.col("times")))
    copies = placed.where("times > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
