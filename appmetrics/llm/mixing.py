"""Mixing sources to target weights, in DataFrame and SQL functions only.

The words of a source, its documents laid end to end in a seeded order, are cut into blocks of equal length.
Sainte-Lague apportionment gives the blocks of the mix to the sources by the highest quotients
``target / (2 * blocks so far + 1)``, for each output shard in turn: the method is monotone in the number of
blocks, so what a source has after shard k less what it had after shard k - 1 is its whole-number quota in
shard k. A source's blocks stand in a ring. Each shard takes as many as its quota: the first shard from a seeded place
on, the next from where it ended, round again if need be. Since the order of the documents is random, a shard's
run of the ring is a random sample, and no block comes a second time before all have come once.

Nothing here has a row per block. Documents are ordered by a hash, within buckets of hash prefixes: a source
that holds a third of all rows is spread over all buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from appmetrics.functions.scratch import stage

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 16
SHARDS = 8
SEED = "mix"
WORDS = r"'[^\\x20\\x09-\\x0D]+'"


def named(column: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + column.replace("`", "``") + "`")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds ``rank``, ``weight``, ``total`` and ``target`` to one row (key, source, source_size) per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the total of all sizes. A
    target stops at ``cap`` times its source's size and the excess is shared by weight among the others, until
    none is above: with sources in the order of capacity by weight, the ones before the first whose capacity
    suffices for its share are full. One row per source passes through the windows.
    """
    listed = ", ".join(map(str, weights))
    ranked = sizes.selectExpr(
        "*",
        "row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank",
        "sum(source_size) OVER () AS total",
        f"{cap} * source_size AS capacity",
    ).selectExpr("*", f"element_at(array({listed}), cast((rank - 1) % {len(weights)} + 1 AS int)) AS weight")
    ordered = ranked.selectExpr("*", "capacity / cast(weight AS double) AS fills_at").selectExpr(
        "*",
        "sum(capacity) OVER (ORDER BY fills_at, rank ROWS UNBOUNDED PRECEDING) - capacity AS full_before",
        "sum(weight) OVER (ORDER BY fills_at DESC, rank DESC ROWS UNBOUNDED PRECEDING) AS weight_left",
    )
    shared = ordered.selectExpr("*", "(total - full_before) / cast(weight_left AS double) AS share").selectExpr(
        "*", "max(CASE WHEN share <= fills_at THEN share END) OVER () AS level"
    )
    return shared.selectExpr(
        "key", "source", "source_size", "rank", "total", "least(weight * level, cast(capacity AS double)) AS target"
    )


def shard_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """(key, shard, quota): whole blocks of each source in each shard, from Sainte-Lague apportionment.

    With a divisor d a source has round(target / d) blocks. A divisor for h blocks lies between
    total / (h + n / 2 + 1) and total / (h - n / 2 - 1), with n sources; what all divisors in between agree on is
    given at once, and only the last few blocks, about three a source, are ranked by their quotients.
    """
    houses = targets.selectExpr("*", "count(*) OVER () AS n", f"explode(sequence(1, {shards})) AS shard").selectExpr(
        "*", f"(total DIV {block_words}) * shard DIV {shards} AS house"
    )
    bounded = houses.selectExpr(
        "*",
        "CASE WHEN house > n / 2D + 1 THEN cast(floor(target * (house - n / 2D - 1) / total + 0.5D) AS bigint) ELSE 0L END AS sure",
        "cast(floor(target * (house + n / 2D + 1) / nullif(total, 0) + 0.5D) AS bigint) AS possible",
    ).selectExpr("*", "house - sum(sure) OVER (PARTITION BY shard) AS left")
    contested = bounded.filter("possible > sure").selectExpr("key", "rank", "target", "shard", "left", "explode(sequence(sure, possible - 1)) AS q")
    won = (
        contested.selectExpr("*", "row_number() OVER (PARTITION BY shard ORDER BY target / (2 * q + 1) DESC, rank, q) AS place")
        .filter("place <= left")
        .groupBy("key", "shard")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    upto = bounded.join(won, ["key", "shard"], "left").selectExpr("key", "shard", "sure + coalesce(won, 0L) AS upto")
    return upto.selectExpr("key", "shard", "upto - coalesce(lag(upto) OVER (PARTITION BY key ORDER BY shard), 0L) AS quota")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] | None = None,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: str = SEED,
    weights=WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """A row ``row`` (the columns ``keep``, all by default) with what the mix takes of it, for every row of ``docs``.

    ``size``: words of the text; ``source_size``, ``target``: of its source; ``parts``: array of structs
    (pass, shard, from, to), the word ranges that each shard takes, in order; ``taken``: words in all.

    Null and empty texts have size 0 and give nothing; a null source is a source of its own; rows with equal
    ids are separate documents, laid one after the other; an empty table gives no rows. The same rows give the
    same result in any order and partitioning: they stand by a hash of id and text, null ids too.
    """
    kept = F.struct(*[named(c).alias(c) for c in (keep if keep is not None else docs.columns)]).alias("row")
    text, source = named(text_col), named(source_col)
    told = F.concat_ws("|", F.lit(seed), F.coalesce(named(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    row = docs.select(
        kept,
        source.alias("source"),
        F.coalesce(F.regexp_count(text, F.expr(WORDS)).cast("bigint"), F.lit(0).cast("bigint")).alias("size"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
        F.md5(told.cast("binary")).alias("draw"),
    )
    buckets = stage(
        row.groupBy("key", "source", F.left("draw", F.lit(3)).alias("bucket")).agg(F.sum("size").alias("words")), "buckets"
    )
    sizes = stage(buckets.groupBy("key", "source").agg(F.sum("words").alias("source_size")), "sizes")
    targets = stage(source_targets(sizes, weights, cap), "targets")
    upto = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = stage(shard_quotas(targets, block_words, shards), "quotas").withColumn("upto", F.sum("quota").over(upto))
    # Places where shards end, counted in blocks from the ring's start on, then in words; one for each shard.
    rings = (
        targets.join(ends.groupBy("key").agg(F.sort_array(F.collect_list("upto")).alias("ends")), "key")
        .selectExpr("key", "source_size", "target", "ends", f"greatest(ceil(source_size / {block_words}D), 1L) AS blocks")
        .selectExpr("*", f"cast(conv(left(md5(cast(concat('{seed}|', key) AS binary)), 8), 16, 10) AS bigint) % blocks AS first")
        .selectExpr("key", "source_size", "target", "blocks", f"transform(concat(array(0L), ends), e -> first + least(e, {cap} * blocks)) AS ends")
        .selectExpr(
            "key", "source_size", "target",
            f"transform(ends, e -> e DIV blocks * source_size + least(e % blocks * {block_words}, source_size)) AS cuts",
        )
    )
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    starts = buckets.withColumn("start", F.sum("words").over(before) - F.col("words")).select("key", "bucket", "start")
    placed = stage(starts.join(rings, "key"), "placed")
    within = Window.partitionBy("key", "bucket").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, 0)
    spread = row.drop("source").withColumn("bucket", F.left("draw", F.lit(3)))
    laid = spread.withColumn("upto", F.sum("size").over(within) - F.col("size")).join(placed, ["key", "bucket"])
    # Round the ring for the p-th time, the document begins at start + upto + p * source_size.
    begin = "(start + upto + p * source_size)"
    ranges = (
        f"filter(flatten(transform(sequence(0, {cap}), p -> transform(sequence(1, {shards}), s -> struct("
        f"p AS pass, s AS shard, least(greatest(element_at(cuts, s) - {begin}, 0L), size) AS from, "
        f"least(greatest(element_at(cuts, s + 1) - {begin}, 0L), size) AS to)))), r -> r.to > r.from)"
    )
    return laid.selectExpr("row", "size", "source_size", "target", f"{ranges} AS parts").selectExpr(
        "*", "aggregate(parts, 0L, (n, r) -> n + r.to - r.from) AS taken"
    )


def mixed_documents(
    docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", shard_col: str | None = None, **how
) -> DataFrame:
    """The mix itself, with the columns of ``docs``, and the shard (from 1) as ``shard_col`` if that is given.

    A row for each range of words that a shard takes: a whole document keeps its text; a part of one is its words
    joined by one space, with ``chars_col`` counted anew.
    """
    placed = mix(docs, text_col=text_col, **how)
    parts = placed.selectExpr("row", "size", "explode(parts) AS part").selectExpr("row", "part", "part.to - part.from = size AS whole")
    # A text that begins with white space has an empty first part.
    text = F.col("row").getField(text_col)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.concat_ws(" ", F.slice(words, F.expr("cast(part.from + 1 AS int)"), F.expr("cast(part.to - part.from AS int)")))
    made = parts.select("row", "part", "whole", F.when(F.col("whole"), text).otherwise(cut).alias("made"))
    new = {text_col: F.col("made")}
    if chars_col and chars_col in docs.columns:
        counted = F.length("made").cast(docs.schema[chars_col].dataType)
        new[chars_col] = F.when(F.col("whole"), F.col("row").getField(chars_col)).otherwise(counted)
    shown = [new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return made.select(*shown, *([F.col("part.shard").alias(shard_col)] if shard_col else []))
