"""A Merkle manifest of a table: one digest for all rows, and a proof for each.

Rows are leaves of one tree per group, in order of their id; ``ARITY`` nodes in a row become the digest of their
joined digests, and the roots of the groups are the leaves of a last tree. Only every ``EVERY``-th level is written
(checkpoint). Between two written levels lie aligned subtrees of ``ARITY ** EVERY`` nodes at most: a proof makes the
missing nodes of its subtree anew from the written ones below (recompute), emits the siblings and drops the nodes.

A subtree is the largest group that any task holds, whatever the sizes of the groups. Places in the trees come from
range partitions and their offsets, and proofs are handed down from subtree to subtree, so no join has a hot key.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions.parsing import quoted
from appmetrics.functions.scratch import stage

ARITY = 8
EVERY = 3


class Manifest(NamedTuple):
    """The written levels: of the groups' trees, leaves first, and of the tree over the groups' roots."""

    levels: list[DataFrame]
    top: list[DataFrame]
    arity: int
    every: int

    def root(self) -> str | None:
        """The digest of all rows; none for an empty table."""
        row = self.top[-1].selectExpr("lower(hex(digest)) AS digest").first()
        return row["digest"] if row else None

    def proofs(self) -> DataFrame:
        """(id, leaf, claimed, subroot, root, proof) for every row.

        ``proof`` has a struct (left, right) for each level from the leaf to the root: the joined digests of the
        node's neighbours in its run, both empty where it has none.
        """
        at_root = self.top[-1].selectExpr("key", "place", "lower(hex(digest)) AS root", "cast(array() AS array<struct<left:string,right:string>>) AS proof")
        of_groups = self._down(self.top, at_root, ("root",)).selectExpr("label AS key", "0L AS place", "digest AS subroot", "root", "proof")
        return self._down(self.levels, of_groups, ("subroot", "root")).selectExpr("id", "digest AS leaf", "claimed", "subroot", "root", "proof")

    def _down(self, levels: list[DataFrame], above: DataFrame, carried) -> DataFrame:
        """The lowest level's nodes with their proofs; ``above`` has those of the highest."""
        if len(levels) == 1:  # each tree is a lone leaf
            rest = [c for c in levels[0].columns if c not in ("key", "place", "nodes", "digest")]
            hexed = F.expr("lower(hex(digest))").alias("digest")
            return levels[0].join(above, ["key", "place"]).select("key", "place", hexed, *rest, *carried, "proof")
        for level in reversed(levels[:-1]):
            rest = [c for c in level.columns if c not in ("key", "place", "nodes", "digest")]
            made = _interior(_subtrees(level, self.arity, self.every), self.arity, self.every)
            made = made.join(above.withColumnRenamed("place", "block"), ["key", "block"])
            kept = "".join(f", m.{c} AS {c}" for c in rest)
            siblings = ", ".join(_siblings(j, self.arity) for j in range(self.every))
            proof = f"concat(array_compact(array({siblings})), proof)"
            proved = f"transform(members, (m, o) -> struct(m.place AS place, level0[o] AS digest{kept}, {proof} AS proof))"
            above = made.selectExpr("key", *carried, f"{proved} AS made").selectExpr("key", *carried, "inline(made)")
        return above


def _siblings(j: int, arity: int) -> str:
    """Neighbours in its run of the node above member number ``o``, ``j`` levels up; null where the tree has ended."""
    at = f"cast(o div {arity**j} AS int)"
    first = f"({at} - {at} % {arity})"
    left = f"array_join(slice(level{j}, {first} + 1, {at} - {first}), '')"
    right = f"array_join(slice(level{j}, {at} + 2, {first} + {arity} - 1 - {at}), '')"
    return f"CASE WHEN NOT (whole AND size(level{j}) = 1) THEN struct({left} AS left, {right} AS right) END"


def _subtrees(nodes: DataFrame, arity: int, every: int) -> DataFrame:
    """(key, nodes, block, members): the nodes below each node ``every`` levels up, in order."""
    block = F.expr(f"place div {arity**every}").alias("block")
    return nodes.groupBy("key", "nodes", block).agg(
        F.array_sort(F.collect_list(F.struct("place", *[c for c in nodes.columns if c not in ("key", "nodes", "place")]))).alias("members")
    )


def _interior(subtrees: DataFrame, arity: int, every: int) -> DataFrame:
    """Adds level0 .. level<every>: the digests of the subtree's levels. A tree that is down to one node goes no higher."""
    made = subtrees.selectExpr("*", f"nodes <= {arity**every} AS whole", "transform(members, m -> lower(hex(m.digest))) AS level0")
    for j in range(every):
        below = f"level{j}"
        parents = f"""transform(sequence(0, cast((size({below}) - 1) div {arity} AS int)),
          r -> sha2(array_join(slice({below}, {arity} * r + 1, {arity}), ''), 256))"""
        made = made.selectExpr("*", f"CASE WHEN whole AND size({below}) = 1 THEN {below} ELSE {parents} END AS level{j + 1}")
    return made


def _climb(leaves: DataFrame, arity: int, every: int) -> list[DataFrame]:
    """The written levels above ``leaves`` (key, nodes, place, digest, ...), up to one node for each key."""
    levels, width = [leaves], arity**every
    most = leaves.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        made = _interior(_subtrees(levels[-1].select("key", "nodes", "place", "digest"), arity, every), arity, every)
        levels.append(
            stage(made.selectExpr("key", f"(nodes + {width - 1}) div {width} AS nodes", "block AS place", f"unhex(level{every}[0]) AS digest"), "level")
        )
        most = -(-most // width)
    return levels


def _placed(rows: DataFrame, order) -> DataFrame:
    """Adds ``nodes``, the rows of each key, and ``place``, the row's number within its key, from 0.

    Rows that are alike in key and ``order`` are alike in all; a number spreads them over ranges.
    """
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = stage(numbered.repartitionByRange("key", *order, "_tie").withColumn("_range", F.spark_partition_id()), "ranges")
    # One row for each key and range it reaches into.
    totals = ranged.groupBy("key", "_range").agg(F.count(F.lit(1)).alias("_n"))
    ranges = Window.partitionBy("key")
    offsets = totals.select(
        "key", "_range", (F.sum("_n").over(ranges.orderBy("_range")) - F.col("_n")).alias("_offset"), F.sum("_n").over(ranges).alias("nodes")
    )
    number = F.row_number().over(Window.partitionBy("key", "_range").orderBy(*order, "_tie"))
    return (
        ranged.withColumn("_number", number)
        .join(offsets, ["key", "_range"])
        .withColumn("place", F.col("_number") + F.col("_offset") - 1)
        .drop("_number", "_offset", "_range", "_tie")
    )


def leaf_sql(values) -> str:
    """SHA-256 of SQL values: each ``-`` if null, else the bytes of its text, a colon and the text."""
    fields = ", ".join(f"coalesce(concat(octet_length(cast({v} AS string)), ':', cast({v} AS string)), '-')" for v in values)
    return f"unhex(sha2(concat({fields}), 256))"


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns=("doc_id", "source", "lang", "n_chars", "text"),
    claims: dict[str, str] | None = None,
    claimed_where: str = "true",
    arity: int = ARITY,
    every: int = EVERY,
) -> Manifest:
    """The manifest of ``docs``: leaves by id within a group, groups in bytewise order, null first.

    ``claims`` gives columns another SQL expression; a row for which ``claimed_where`` holds then also has the leaf
    of what is claimed, to be folded with the proof of what is stored. Nulls have a digest of their own in any
    column. Null ids come first; rows that share an id stand in the order of their leaves; repeated rows are
    separate, equal leaves. Texts are hashed whole. Other columns take no part. An empty table has no root.
    """
    claim = f"CASE WHEN {claimed_where} THEN {leaf_sql([claims.get(c, quoted(c)) for c in columns])} END" if claims else "cast(NULL AS binary)"
    rows = docs.selectExpr(
        f"{quoted(id_col)} AS id",
        f"coalesce(concat('s', cast({quoted(group_col)} AS string)), 'n') AS key",  # 'n' sorts before all 's'
        f"{leaf_sql(map(quoted, columns))} AS digest",
        f"{claim} AS claimed",
    )
    leaves = stage(_placed(stage(rows, "leaves"), ("id", "digest")), "placed")
    levels = _climb(leaves.select("key", "nodes", "place", "digest", "id", "claimed"), arity, every)
    groups = levels[-1].select(F.lit("all").alias("key"), F.col("key").alias("label"), "digest")
    top = _climb(stage(_placed(stage(groups, "groups"), ("label",)), "placed").select("key", "nodes", "place", "digest", "label"), arity, every)
    return Manifest(levels, top, arity, every)


# Of a row of ``Manifest.proofs``: all siblings as one text, and the root that a leaf folds to.
SIBLINGS = "array_join(transform(proof, s -> concat(s.left, s.right)), '')"
FOLDED = "aggregate(proof, coalesce(lower(hex(claimed)), leaf), (d, s) -> sha2(concat(s.left, d, s.right), 256))"
