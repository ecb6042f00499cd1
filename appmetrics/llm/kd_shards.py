"""Sharding by a k-d tree over document metadata.

The rows are split again and again at a weighted median along the dimension that is widest among them, until
leaves reach the target size. A leaf is a shard: shards are near equal in bytes, and hold documents alike in
length, language or whatever the dimensions say. A node that is to give an odd number of shards is split in
proportion.

Medians are found by counting: bytes per bin of the node's range, summed in every task before they are sent,
then per bin of the bin that holds the median, and so on. The driver gets a fixed number of bins per node,
whatever the rows. Rows with equal values are told apart by the checksum of the text, and those with equal texts
by a hash of the id, but only if together they weigh more than the slack: so copies of a text share a shard
unless the group is too large for that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.functions.scratch import stage

BINS = 1024
#: A cut may miss the weighted median by half this share of a shard's bytes.
SLACK = 0.01
SLOT_ROWS = 5000
#: What orders rows of equal value: checksum and two parts of the id's hash, each with its largest value.
TIES = (("crc", 2.0**32), ("hash1", 2.0**31), ("hash2", 2.0**33))


def code_order(text: Column) -> Column:
    """A string's place in code point order, by its first six bytes in UTF-8; null comes first."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.left(text, F.lit(6)).cast("binary")), 12, "0").substr(1, 12), 16, 10).cast("double"), F.lit(-1.0))


@dataclass
class Node:
    """A part of the rows that becomes ``shards`` shards, numbered from ``first``; cut once it has two sides."""

    first: int
    shards: int
    cut: list[tuple[str, float]] | None = None
    sides: tuple["Node", "Node"] | None = None

    def sql(self, leaf) -> str:
        """What ``leaf`` gives for the leaf a row is in."""
        if self.sides is None:
            return leaf(self)
        names, values = zip(*self.cut)
        below = f"struct({', '.join(names)}) < struct({', '.join(f'{v!r}D' for v in values)})"
        return f"CASE WHEN {below} THEN {self.sides[0].sql(leaf)} ELSE {self.sides[1].sql(leaf)} END"

    def leaves(self) -> list["Node"]:
        return [self] if self.sides is None else self.sides[0].leaves() + self.sides[1].leaves()


@dataclass
class _Search:
    """Where a node's weighted median is: rows equal to ``fixed``, the next column between ``low`` and ``high``."""

    columns: list[str]
    target: float
    slack: float
    low: float
    high: float
    fixed: list[tuple[str, float]]
    below: float = 0.0
    cut: list[tuple[str, float]] | None = None

    @property
    def column(self) -> str:
        return self.columns[len(self.fixed)]

    def bin_sql(self) -> str:
        equal = "".join(f" AND {c} = {v!r}D" for c, v in self.fixed)
        scale = BINS / (self.high - self.low) if self.high > self.low else 0.0
        place = f"cast(least(floor(({self.column} - {self.low!r}D) * {scale!r}D), {BINS - 1}) AS int)"
        return f"CASE WHEN {self.column} BETWEEN {self.low!r}D AND {self.high!r}D{equal} THEN {place} END"

    def narrow(self, bins: list[tuple[float, float, float]]) -> None:
        """``bins``: (least value, largest value, bytes) in order."""
        for at, (low, high, weight) in enumerate(bins):
            if self.below + weight < self.target and at < len(bins) - 1:
                self.below += weight
                continue
            last = len(self.fixed) == len(self.columns) - 1
            if weight <= self.slack or (low == high and last):
                # Before or after this bin, whichever is nearer.
                after = self.below + weight - self.target < self.target - self.below
                following = bins[at + 1][0] if at + 1 < len(bins) else None
                if after and following is not None:
                    self.cut = [*self.fixed, (self.column, following)]
                elif after:
                    # Nothing follows in this range: cut just above it.
                    self.cut = [*self.fixed, (self.column, high), *[(c, 2.0**40) for c in self.columns[len(self.fixed) + 1 :]]]
                    if last:
                        self.cut[-1] = (self.column, high + 1)
                else:
                    self.cut = [*self.fixed, (self.column, low)]
            elif low == high:
                self.fixed.append((self.column, low))
                self.low, self.high = 0.0, dict(TIES)[self.column]
            else:
                self.low, self.high = low, high
            return


def kd_tree(points: DataFrame, dimensions: list[str], shards: int, slack: float = SLACK) -> Node:
    """The tree of ``points``: columns ``size`` (weight), crc, hash1, hash2 and the dimensions, doubles all."""
    root = Node(0, shards)
    whole = None
    while open_nodes := [n for n in root.leaves() if n.shards > 1]:
        numbered = {id(n): i for i, n in enumerate(open_nodes)}
        within = points.selectExpr("*", root.sql(lambda n: str(numbered.get(id(n), -1))) + " AS node").filter("node >= 0")
        measured = within.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[F.min(d).alias(f"low_{d}") for d in dimensions], *[F.max(d).alias(f"high_{d}") for d in dimensions]
        )
        found = {r["node"]: r for r in measured.collect()}
        if whole is None and found:
            whole = {d: (found[0][f"high_{d}"] - found[0][f"low_{d}"]) or 1.0 for d in dimensions}
        searches = {}
        for i, node in enumerate(open_nodes):
            row, left = found.get(i), node.shards // 2
            if row is None:  # no rows here
                node.cut, searches[i] = [(dimensions[0], 0.0)], None
                continue
            widest = max(dimensions, key=lambda d: (row[f"high_{d}"] - row[f"low_{d}"]) / whole[d])
            searches[i] = _Search(
                [widest, *[c for c, _ in TIES]], row["bytes"] * left / node.shards, slack * row["bytes"] / node.shards,
                row[f"low_{widest}"], row[f"high_{widest}"], [],
            )
        while pending := {i: s for i, s in searches.items() if s is not None and s.cut is None}:
            place = "CASE node " + " ".join(f"WHEN {i} THEN {s.bin_sql()}" for i, s in pending.items()) + " END"
            value = "CASE node " + " ".join(f"WHEN {i} THEN {s.column}" for i, s in pending.items()) + " END"
            counted = (
                within.selectExpr("node", "size", f"{place} AS bin", f"{value} AS value")
                .filter("bin IS NOT NULL")
                .groupBy("node", "bin")
                .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("size").alias("bytes"))
            )
            bins: dict[int, list] = {}
            for r in sorted(counted.collect(), key=lambda r: (r["node"], r["bin"])):
                bins.setdefault(r["node"], []).append((r["low"], r["high"], float(r["bytes"])))
            for i, s in pending.items():
                s.narrow(bins[i])
        for i, node in enumerate(open_nodes):
            if searches[i] is not None:
                node.cut = searches[i].cut
            left = node.shards // 2
            node.sides = Node(node.first, left), Node(node.first + left, node.shards - left)
    return root


def kd_shards(
    docs: DataFrame,
    dimensions: dict[str, Column],
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    slack: float = SLACK,
) -> DataFrame:
    """(id, size, crc, shard, slot) for every row of ``docs``: shards 0 to n - 1, slots from 0 without gaps in each.

    ``dimensions``: names and numeric expressions over ``docs``; null counts as -1. ``size``: bytes of the text
    in UTF-8 plus 8. Give the number of shards, or a target size from which it follows.

    A null text has size 8 and checksum 0; repeated rows weigh and count each; a text larger than a shard's
    share fills one alone; with fewer rows than shards some shards stay empty; an empty table gives no rows.
    """
    names = [f"at_{d}" for d in dimensions]
    points = stage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("bigint").alias("size"),
            F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("double").alias("crc"),
            F.shiftrightunsigned(F.xxhash64(id_col), 33).cast("double").alias("hash1"),
            F.xxhash64(id_col).bitwiseAND(F.lit((1 << 33) - 1)).cast("double").alias("hash2"),
            *[F.nanvl(F.coalesce(e.cast("double"), F.lit(-1.0)), F.lit(-1.0)).alias(n) for n, e in zip(names, dimensions.values())],
        ),
        "points",
    )
    held = points.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).first()
    if shards is None:
        shards = max(1, -(-(held["bytes"] or 0) // target_bytes))
    tree = kd_tree(points, names, shards, slack)
    # Slots: numbered within chunks of a shard, each chunk after the chunks before it.
    chunks = max(1, -(-held["rows"] // (shards * SLOT_ROWS)))
    dealt = points.selectExpr(
        "id", "size", "cast(crc AS bigint) AS crc", f"{tree.sql(lambda n: str(n.first))} AS shard", f"cast(hash2 % {chunks} AS int) AS chunk", "hash1", "hash2"
    )
    counts = dealt.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    starts = stage(
        counts.selectExpr("shard", "chunk", "sum(n) OVER (PARTITION BY shard ORDER BY chunk ROWS UNBOUNDED PRECEDING) - n AS start"), "starts"
    )
    placed = dealt.selectExpr("*", "row_number() OVER (PARTITION BY shard, chunk ORDER BY hash1, hash2, id) - 1 AS place")
    return placed.join(starts, ["shard", "chunk"]).selectExpr("id", "size", "crc", "shard", "start + place AS slot")
