"""Trees whose splits are found by counting: prefix sums over the sorted distinct values of each feature.

Regression has one target (the label), classification one per class (1 for rows of that class, else 0). In both, rows
of weight n whose targets add up to t score sum(t * t) / n, and the best split is the one whose two parts score most
together: it lowers the variance, or the Gini impurity, most. Unlike trees on binned features, every distinct value
is tried, so SQL can say which split must be found.

All nodes of a level, of all trees, are split in one pass: rows are counted per (tree, node, feature, value), combined
before the shuffle, and the sums up to each value are made in range partitions, so a feature may have as
many values as the table has rows. What reaches the driver is one split per tree, node and feature.

Missing feature values (null, NaN) count as minus infinity, left of all others; rows without a label take no part.
Gains that agree as 32-bit floats are ties, which go to the first feature, then to the least value.
"""

from __future__ import annotations

import hashlib
from math import inf, isfinite
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.hashing import uniform_md5
from appmetrics.functions.parsing import quoted
from appmetrics.functions.scratch import stage
from appmetrics.operators.ranking import running_sums

# The cumulative Poisson distribution with mean 1, from 0 to 7 times.
POISSON = (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406, 0.999917, 0.999990)


class Split(NamedTuple):
    """Rows whose feature (by number) is at most ``threshold`` go left."""

    feature: int
    threshold: float
    gain: float
    left_rows: float
    left_sums: tuple[float, ...]


class Node(NamedTuple):
    """Weight and target sums of the rows of a node; no split: a leaf."""

    rows: float
    sums: tuple[float, ...]
    split: Split | None = None


class Forest(NamedTuple):
    """Trees as nodes by number: the children of node i are 2 i (left) and 2 i + 1."""

    features: list[str]
    classes: list[float] | None
    trees: list[dict[int, Node]]
    rate: float | None = None  # boosted: what each tree adds is scaled by it

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Adds the mean of the trees (boosted: their sum), or the class of the highest mean share, the lower on a tie."""
        cells = [_cell(c) for c in self.features]
        if self.classes is None:
            parts = [_leaf_sql(t, cells, lambda n: _number(n.sums[0] / n.rows)) for t in self.trees]
            if self.rate is None:
                return df.withColumn(out, F.expr(f"({' + '.join(parts)}) / {len(parts)}D"))
            later = "".join(f" + {self.rate!r}D * {p}" for p in parts[1:])
            return df.withColumn(out, F.expr(parts[0] + later))
        shares = []
        for j, value in enumerate(self.classes):
            mean = " + ".join(_leaf_sql(t, cells, lambda n: _number(n.sums[j] / n.rows)) for t in self.trees)
            shares.append(f"struct(round(({mean}) / {len(self.trees)}D, 12) AS share, {-value!r}D AS minus_class)")
        return df.withColumn(out, F.expr(f"-array_max(array({', '.join(shares)})).minus_class"))

    def nodes(self, df: DataFrame) -> DataFrame:
        """(tree, node, feature, threshold, gain, rows, sums): feature, threshold and gain are null for a leaf."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, n in sorted(tree.items()):
                s = n.split
                cut = (self.features[s.feature], s.threshold, s.gain) if s else (None, None, None)
                rows.append((t, i, *cut, n.rows, list(n.sums)))
        schema = "tree int, node int, feature string, threshold double, gain double, rows double, sums array<double>"
        return df.sparkSession.createDataFrame(rows, schema)


def _cell(column: str) -> str:
    """A feature as a double in which a missing value is minus infinity."""
    return f"coalesce(nanvl(cast({quoted(column)} AS double), double('-Infinity')), double('-Infinity'))"


def _number(v: float) -> str:
    return f"{v!r}D" if isfinite(v) else f"double('{'-' if v < 0 else ''}Infinity')"


def _leaf_sql(tree: dict[int, Node], cells: list[str], leaf, node: int = 1) -> str:
    """Value of ``leaf`` for the leaf that a row falls into."""
    split = tree[node].split
    if split is None:
        return leaf(tree[node])
    left, right = (_leaf_sql(tree, cells, leaf, 2 * node + side) for side in (0, 1))
    return f"CASE WHEN {cells[split.feature]} <= {_number(split.threshold)} THEN {left} ELSE {right} END"


def _place_sql(tree: dict[int, Node], node: int = 1) -> str:
    """Number of the node that a row of ``_points`` has come to."""
    split = tree[node].split
    if split is None:
        return str(node)
    left, right = (_place_sql(tree, 2 * node + side) for side in (0, 1))
    return f"CASE WHEN x{split.feature} <= {_number(split.threshold)} THEN {left} ELSE {right} END"


def _points(df: DataFrame, label: str, features: list[str], classes, key, trees: int, seed: int) -> DataFrame:
    """Features x0.., targets t0.. and a weight per tree w0.., as a narrow table that each level reads once."""
    y = f"cast({quoted(label)} AS double)"
    targets = [f"{y} AS t0"] if classes is None else [f"CASE WHEN {y} = {c!r}D THEN 1D ELSE 0D END AS t{j}" for j, c in enumerate(classes)]
    known = df.filter(F.expr(f"{y} IS NOT NULL AND NOT isnan({y})"))
    weights = [F.lit(1.0).alias("w0")]
    if key:
        drawn = [uniform_md5(key, f"{seed}-{t}") for t in range(trees)]
        weights = [
            sum((F.when(u >= p, 1.0).otherwise(0.0) for p in POISSON), F.lit(0.0)).alias(f"w{t}") for t, u in enumerate(drawn)
        ]
    cells = [F.expr(f"{_cell(c)} AS x{i}") for i, c in enumerate(features)]
    return stage(known.select(*cells, *[F.expr(t) for t in targets], *weights), "points")


def _chosen(features: int, tried: int | None, seed: int, tree: int, node: int) -> list[int]:
    """The features that a node tries: those whose MD5 of seed, tree, node and number is least."""
    if tried is None or tried >= features:
        return list(range(features))
    order = sorted(range(features), key=lambda i: hashlib.md5(f"{seed}|{tree}|{node}|{i}".encode()).hexdigest())
    return sorted(order[:tried])


def _split_table(points: DataFrame, targets: int, where: list[dict[int, list[int]]], places: list[str]) -> DataFrame:
    """(tree, node, feature, gain, value, n, all, t, ...): the best split of each open node by each feature it tries.

    ``where``: for each tree, the features that each open node tries; ``places``: for each tree, a row's node.
    """
    sums = [f"t{j}" for j in range(targets)]
    inside = ", ".join(f"struct({t} AS tree, {p} AS node, w{t} AS weight)" for t, p in enumerate(places) if where[t])
    cells = ", ".join(c for c in points.columns if c.startswith("x"))
    placed = points.selectExpr(*sums, f"array({cells}) AS xs", f"inline(array({inside}))").filter("weight > 0")
    # The features that a node tries are constant lists, so the code of a pass stays small, however many nodes are open.
    tries = [
        f"WHEN {t} THEN CASE node {' '.join(f'WHEN {node} THEN array({str(list(numbers))[1:-1]})' for node, numbers in nodes.items())} END"
        for t, nodes in enumerate(where)
        if nodes
    ]
    listed = placed.selectExpr("tree", "node", "weight", *sums, "xs", f"explode(CASE tree {' '.join(tries)} END) AS feature")
    counted = listed.groupBy("tree", "node", "feature", F.expr("xs[feature] AS value")).agg(
        F.sum("weight").alias("n"), *[F.sum(F.expr(f"weight * {t}")).alias(t) for t in sums]
    )
    upto = running_sums(counted, ["tree", "node", "feature"], "value", ["n", *sums])
    score = " + ".join(
        f"{t}_upto * {t}_upto / n_upto + ({t}_all - {t}_upto) * ({t}_all - {t}_upto) / (n_all - n_upto) - {t}_all * {t}_all / n_all" for t in sums
    )
    parts = upto.filter("n_upto < n_all").selectExpr(
        "tree", "node", "feature", f"({score}) / n_all AS gain", "value", "n_upto AS rows", f"array({', '.join(f'{t}_upto' for t in sums)}) AS sums"
    )
    best = F.expr("max_by(struct(value, gain, rows, sums), struct(cast(gain AS float), -value))").alias("best")
    return parts.groupBy("tree", "node", "feature").agg(best).select("tree", "node", "feature", "best.*")


def best_splits(df: DataFrame, label: str, features, classes=None) -> DataFrame:
    """(feature, threshold, gain, rows_left): each feature's best split of all rows.

    ``gain`` is the fall of variance (with ``classes``: of Gini impurity) per row. A feature of one value has no row.
    """
    features = list(features)
    points = _points(df, label, features, classes, None, 1, 0)
    found = _split_table(points, len(classes or [0]), [{1: list(range(len(features)))}], ["1"])
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    return found.select(names.alias("feature"), F.col("value").alias("threshold"), "gain", F.col("rows").alias("rows_left"))


def _grown(points: DataFrame, features: int, targets: int, depth: int, trees: int, tried: int | None, seed: int, min_rows: float) -> list[dict[int, Node]]:
    total = points.agg(
        *[F.expr(f"coalesce(sum(w{t}), 0D)") for t in range(trees)],
        *[F.expr(f"coalesce(sum(w{t} * t{j}), 0D)") for t in range(trees) for j in range(targets)],
    ).first()
    grown = [{1: Node(total[t], tuple(total[trees + t * targets : trees + (t + 1) * targets]))} for t in range(trees)]
    if any(not tree[1].rows for tree in grown):
        raise ValueError("a tree has no rows with a label")
    for level in range(depth):
        where = [
            {i: _chosen(features, tried, seed, t, i) for i, n in tree.items() if i >= 2**level and n.rows >= 2 * min_rows}
            for t, tree in enumerate(grown)
        ]
        if not any(where):
            break
        best: dict[tuple[int, int], tuple] = {}
        for r in _split_table(points, targets, where, [_place_sql(t) for t in grown]).collect():
            rank = (float(np.float32(r["gain"])), -r["feature"])
            if rank > best.get((r["tree"], r["node"]), ((-inf, 0),))[0]:
                best[r["tree"], r["node"]] = (rank, Split(r["feature"], r["value"], r["gain"], r["rows"], tuple(r["sums"])))
        for (t, i), (_, split) in best.items():
            node = grown[t][i]
            level_of_noise = 1e-12 * sum(s * s for s in node.sums) / node.rows**2
            right = node.rows - split.left_rows
            if split.gain <= level_of_noise or min(split.left_rows, right) < min_rows:
                continue
            grown[t][i] = node._replace(split=split)
            grown[t][2 * i] = Node(split.left_rows, split.left_sums)
            grown[t][2 * i + 1] = Node(right, tuple(a - b for a, b in zip(node.sums, split.left_sums)))
    return grown


def tree(df: DataFrame, label: str, features, depth: int = 5, classes=None, min_rows: float = 1) -> Forest:
    """One tree of ``depth`` levels of splits. ``classes`` (the label's values) make it a classification."""
    return forest(df, label, features, depth, classes, trees=1, min_rows=min_rows)


def forest(
    df: DataFrame, label: str, features, depth: int = 5, classes=None, trees: int = 20, key=None, tried: int | None = None, seed: int = 0, min_rows: float = 1
) -> Forest:
    """``trees`` trees grown together, level by level.

    With ``key`` (columns that identify a row) each tree takes each row a Poisson(1) number of times, drawn by a hash, so
    a task that runs again draws the same; without, there is one tree of all rows. Each node tries ``tried``
    features (all by default). A split leaves ``min_rows`` on both sides, or the node stays a leaf.
    """
    features, classes = list(features), None if classes is None else sorted(float(c) for c in classes)
    trees = trees if key else 1
    points = _points(df, label, features, classes, key, trees, seed)
    targets = 1 if classes is None else len(classes)
    return Forest(features, classes, _grown(points, len(features), targets, depth, trees, tried, seed, min_rows))


def boosted(df: DataFrame, label: str, features, rounds: int = 10, depth: int = 1, rate: float = 0.1) -> Forest:
    """Trees that each fit what the ones before have left: the first as it is, the later ones times ``rate``."""
    features = list(features)
    points = _points(df, label, features, None, None, 1, 0)
    cells, trees = [f"x{i}" for i in range(len(features))], []
    for t in range(rounds):
        if t:
            scale = 1.0 if t == 1 else rate
            step = _leaf_sql(trees[-1], cells, lambda n: _number(n.sums[0] / n.rows))
            points = stage(points.withColumn("t0", F.expr(f"t0 - {scale!r}D * {step}")), "residuals")
        trees += _grown(points, len(features), 1, depth, 1, None, 0, 1)
    return Forest(features, None, trees, rate)
