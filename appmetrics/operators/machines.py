"""Support-vector machines with an approximated RBF kernel, any number of them at once.

A machine for several classes is one linear machine for each pair of classes, on random cosine features; the pairs vote.
The machines of all costs, folds and pairs are fitted together: their weights are the columns of one matrix, a pass
over the rows gives the losses and gradients of all, and the driver takes one step of each (limited-memory
quasi-Newton, backtracking). So a search over 30 costs and 5 folds reads the rows as often as a single fit.

Rows that are equal in label and features have equal cosines, margins and losses, so each is kept once, with how many
rows of each fold it stands for: a pass computes it once and weighs it. Where no two rows are equal, that changes nothing.
Rows stay as narrow as they come: scaling and cosines are made anew in each pass, because 128 doubles a row would be
read from disk slower than they are computed. What tasks return is summed in Spark, in pieces of the matrix, so the
driver gets one matrix a pass, whose size depends on the numbers of machines and cosine features alone.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.functions.parsing import field, quoted
from appmetrics.functions.scratch import stage

GAMMA = 0.3
COST = 100.0
SIZE = 128
MAX_ITER = 50
#: A task's rows: enough work for the matrix it returns.
TASK_ROWS = 8192
SLICE = 2048
#: The corner of the hinge is rounded, less and less, so that steps go down: (width, share of the iterations).
ROUNDING = ((0.3, 0.5), (0.05, 0.5))
#: Numbers of the matrix in one row of what tasks return.
PIECE = 4096


class Cosines(NamedTuple):
    """Random cosine features whose inner products approximate exp(-gamma * |x - y|^2)."""

    weights: np.ndarray
    offsets: np.ndarray

    @classmethod
    def draw(cls, width: int, size: int, gamma: float, seed: int) -> Cosines:
        random = np.random.default_rng(seed)
        return cls(random.normal(0.0, math.sqrt(2.0 * gamma), (size, width)), random.uniform(0.0, 2.0 * math.pi, size))

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Mapped rows, and a column of ones for the intercept."""
        mapped = math.sqrt(2.0 / len(self.offsets)) * np.cos(x @ self.weights.T + self.offsets)
        return np.concatenate((mapped, np.ones((len(x), 1))), axis=1)


def class_pairs(classes: int) -> np.ndarray:
    """(lower, upper) index of each pair of classes."""
    return np.array([(a, b) for b in range(classes) for a in range(b)], np.int64).reshape(-1, 2)


def vote(margins: str, classes) -> Column:
    """The class that most pairs choose, the lower one on a tie.

    The column ``margins`` holds a number for each pair in the order of ``class_pairs``: above 0 for the upper class.
    """
    if len(classes) < 2:
        return F.lit(float(classes[0]))
    pairs = ", ".join(f"struct({a} AS lower, {b} AS upper)" for a, b in class_pairs(len(classes)))
    chosen = f"zip_with({quoted(margins)}, array({pairs}), (m, p) -> CASE WHEN m > 0 THEN p.upper ELSE p.lower END)"
    votes = ", ".join(f"struct(size(filter(_c, c -> c = {i})) AS votes, {-float(v)!r}D AS minus)" for i, v in enumerate(classes))
    return F.expr(f"0.0D - array_max(transform(array({chosen}), _c -> array_max(array({votes}))))['minus']")


class Machines(NamedTuple):
    """Fitted machines: ``weights`` (group, cost, pair, feature) with the intercept last."""

    classes: list[float]
    costs: list[float]
    scaling: list[tuple[np.ndarray, np.ndarray]]
    cosines: Cosines
    weights: np.ndarray
    objectives: np.ndarray
    passes: int

    def mapped(self, x: np.ndarray, group: int) -> np.ndarray:
        mean, factor = self.scaling[group]
        return self.cosines.apply((x - mean) * factor)


class PairwiseModel(NamedTuple):
    """One machine for all pairs of classes; ``transform`` adds ``margins`` and ``prediction``."""

    machines: Machines
    features: str
    group: int = 0
    cost: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        machines, group, weights = self.machines, self.group, self.machines.weights[self.group, self.cost]

        @F.pandas_udf("array<double>")
        def margins(x):
            import pandas as pd

            made = machines.mapped(np.stack(x.to_numpy()), group) @ weights.T if len(x) else np.zeros((0, len(weights)))
            return pd.Series(list(made))

        scored = df.withColumn("margins", margins(vector_to_array(field(self.features))))
        return scored.withColumn("prediction", vote("margins", machines.classes))


def narrow_rows(train: DataFrame, label: str, features: str, fold: Column | None = None, folds: int = 1) -> DataFrame:
    """(label, x, rows) of rows with a label, equal ones once; ``rows`` counts them in each fold. ``TASK_ROWS`` a task."""
    rows = train.select(
        (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
        field(label).cast("double").alias("label"),
        vector_to_array(field(features)).alias("x"),
    ).filter("label IS NOT NULL AND NOT isnan(label)")
    counted = rows.groupBy("label", "x").agg(F.array(*[F.count_if(F.col("fold") == k) for k in range(folds)]).alias("rows"))
    written = stage(counted, "machine-rows")
    return stage(written.repartition(max(1, -(-written.count() // TASK_ROWS))), "machine-rows")


def _facts(rows: DataFrame, held_out) -> tuple[list[float], np.ndarray, list]:
    """Classes, training rows (group, class), and the scaling (mean, 1 / deviation) of each group."""
    width = rows.select(F.max(F.size("x"))).first()[0] or 0
    parts = rows.selectExpr("label", "x", "posexplode(rows) AS (fold, n)").filter("n > 0")
    # Squares are summed about the middle of all rows, so that large means take no digits from small spreads.
    middle = parts.select(*[F.sum(F.get("x", F.lit(i)) * F.col("n")) / F.sum("n") for i in range(width)]).first() if width else ()
    moments = []
    for i, m in enumerate(middle):
        off = F.get("x", F.lit(i)) - F.lit(m)
        moments += [F.sum(off * F.col("n")) / F.sum("n"), F.sum(off * off * F.col("n")) / F.sum("n")]
    found = parts.groupBy("fold", "label").agg(F.sum("n"), *moments).collect()
    classes = sorted({r[1] for r in found})
    counts, scaling = np.zeros((len(held_out), len(classes))), []
    for g, held in enumerate(held_out):
        chosen = [r for r in found if r[0] != held]
        n = np.array([r[2] for r in chosen], float)
        means = np.array([r[3::2] for r in chosen], float).reshape(len(chosen), width)
        spread = np.array([r[4::2] for r in chosen], float).reshape(len(chosen), width) - means**2
        mean = (n @ means) / max(n.sum(), 1)
        squares = n @ (np.maximum(spread, 0.0) + (means - mean) ** 2)
        deviation = np.sqrt(squares / max(n.sum() - 1, 1))
        middles = np.array(middle, float) if len(chosen) else np.zeros(width)
        scaling.append((middles + mean, np.divide(1.0, deviation, out=np.zeros(width), where=deviation > 0)))
        for r in chosen:
            counts[g, classes.index(r[1])] += r[2]
    return classes, counts, scaling


def _batch(batch: pa.RecordBatch, classes: np.ndarray):
    """Rows of each fold (row, fold), class indexes and features of a batch."""
    x = np.asarray(batch.column("x").flatten(), np.float64).reshape(batch.num_rows, -1)
    n = np.asarray(batch.column("rows").flatten(), np.int64).reshape(batch.num_rows, -1)
    return n, np.searchsorted(classes, np.asarray(batch.column("label"))), x


def hinge(short: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Loss and slope where a margin is ``short`` of 1: the hinge, its corner rounded over ``width`` on both sides."""
    if not width:
        return np.maximum(short, 0.0), (short > 0).astype(np.float64)
    pull = np.clip((short + width) / (2.0 * width), 0.0, 1.0)
    return width * pull * pull + np.maximum(short - width, 0.0), pull


def _losses(rows: DataFrame, machines: Machines, held_out, columns: list[tuple[np.ndarray, np.ndarray]], width: float) -> list[np.ndarray]:
    """For each group (feature + 1, machine): the gradients of the sums of hinge losses, then the sums.

    ``columns`` has for each group the weights (feature, machine) and the machines' pairs.
    """
    classes = np.array(machines.classes)

    def run(batches):
        sums = [np.zeros((w.shape[0] + 1, w.shape[1])) for w, _ in columns]
        for batch in batches:
            folds, labels, x = _batch(batch, classes)
            for at in range(0, len(x), SLICE):
                part = slice(at, at + SLICE)
                for g, (w, pairs) in enumerate(columns):
                    if not w.shape[1]:
                        continue
                    trained = folds[part][:, [k != held_out[g] for k in range(folds.shape[1])]].sum(axis=1).astype(np.float64)
                    z, own = machines.mapped(x[part], g), labels[part]
                    for c in range(len(classes)):
                        chosen, of_class = (trained > 0) & (own == c), np.flatnonzero((pairs == c).any(axis=1))
                        mine, n = z[chosen], trained[chosen]
                        if not len(mine) or not len(of_class):
                            continue
                        sign = np.where(pairs[of_class, 1] == c, 1.0, -1.0)
                        short = 1.0 - (mine @ w[:, of_class]) * sign
                        loss, pull = hinge(short, width)
                        sums[g][-1, of_class] += n @ loss
                        sums[g][:-1, of_class] -= sign * ((mine * n[:, None]).T @ pull)
        flat = np.concatenate([s.ravel() for s in sums])
        for piece, at in enumerate(range(0, len(flat), PIECE)):
            values = flat[at : at + PIECE]
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))], ["piece", "values"]
            )

    made = rows.mapInArrow(run, "piece int, values array<double>").select("piece", array_to_vector("values").alias("v"))
    found = sorted(made.groupBy("piece").agg(Summarizer.sum(F.col("v")).alias("v")).collect(), key=lambda r: r["piece"])
    flat, out, at = np.concatenate([r["v"].toArray() for r in found]), [], 0
    for w, _ in columns:
        size = (w.shape[0] + 1) * w.shape[1]
        out.append(flat[at : at + size].reshape(w.shape[0] + 1, w.shape[1]))
        at += size
    return out


def minimise(evaluate, start: np.ndarray, max_iter: int, tolerance: float = 1e-6, memory: int = 10) -> tuple[np.ndarray, np.ndarray, int]:
    """(points, values, passes) of many minimisations side by side; ``start`` has one row for each.

    ``evaluate(points, which)`` gives values and gradients of the problems ``which`` at ``points``: one call for
    each step that all take, or try. A problem ends after ``max_iter`` steps, or when a step changes its value by
    less than ``tolerance`` of it, or when no step down is found.
    """
    x = start.copy()
    live = np.arange(len(x))
    f, g = evaluate(x, live)
    passes = 1
    s, y, rho = np.zeros((memory, *x.shape)), np.zeros((memory, *x.shape)), np.zeros((memory, len(x)))
    scale = 1.0 / np.maximum(np.linalg.norm(g, axis=1), 1.0)
    steps, tries, t = np.zeros(len(x), int), np.zeros(len(x), int), np.ones(len(x))
    d = -g * scale[:, None]

    def direction(w):
        q, alpha = g[w].copy(), np.zeros((memory, len(w)))
        for i in range(memory - 1, -1, -1):
            alpha[i] = rho[i, w] * np.einsum("mn,mn->m", s[i, w], q)
            q -= alpha[i][:, None] * y[i, w]
        q *= scale[w][:, None]
        for i in range(memory):
            beta = rho[i, w] * np.einsum("mn,mn->m", y[i, w], q)
            q += (alpha[i] - beta)[:, None] * s[i, w]
        return -q

    while len(live):
        slope = np.einsum("mn,mn->m", g[live], d[live])
        point = x[live] + t[live][:, None] * d[live]
        value, gradient = evaluate(point, live)
        passes += 1
        took = value <= f[live] + 1e-4 * t[live] * slope
        a = live[took]
        if len(a):
            moved, turned = point[took] - x[a], gradient[took] - g[a]
            change = np.abs(f[a] - value[took]) <= tolerance * np.maximum(np.abs(value[took]), 1e-12)
            curve, bend = np.einsum("mn,mn->m", moved, turned), np.einsum("mn,mn->m", turned, turned)
            good = curve > 1e-10 * np.sqrt(bend) * np.linalg.norm(moved, axis=1)
            k = a[good]
            s[:-1, k], y[:-1, k], rho[:-1, k] = s[1:, k], y[1:, k], rho[1:, k]
            s[-1, k], y[-1, k], rho[-1, k] = moved[good], turned[good], 1.0 / curve[good]
            scale[k] = curve[good] / bend[good]
            x[a], f[a], g[a] = point[took], value[took], gradient[took]
            steps[a] += 1
            tries[a], t[a] = 0, 1.0
            a = a[~change & (steps[a] < max_iter)]
            d[a] = direction(a)
        b = live[~took]
        if len(b):
            tries[b] += 1
            # The least of the parabola through the value, the slope and the value tried, within bounds.
            rise = value[~took] - f[b] - t[b] * slope[~took]
            t[b] *= np.clip(-t[b] * slope[~took] / (2.0 * np.maximum(rise, 1e-300)), 0.1, 0.5)
            again = b[tries[b] == 8]  # forget the past, go straight down
            rho[:, again] = 0.0
            scale[again] = 1.0 / np.maximum(np.linalg.norm(g[again], axis=1), 1.0)
            d[again], t[again] = -g[again] * scale[again][:, None], 1.0
            b = b[tries[b] < 16]
        live = np.sort(np.concatenate((a, b)))
    return x, f, passes


def fit_machines(
    rows: DataFrame, costs, held_out=(-1,), gamma: float = GAMMA, size: int = SIZE, seed: int = 0, max_iter: int = MAX_ITER, scale: bool = True
) -> Machines:
    """All machines of ``costs`` by groups by pairs of classes, on ``narrow_rows``.

    A group learns from the rows whose fold is not the one of ``held_out``; its scaling too. A pair's objective is
    the mean hinge loss of the rows of its two classes and |w|^2 / (2 C n). Rows with null features must be gone.
    A table of one class needs no machine; an empty one raises an error.
    """
    classes, counts, scaling = _facts(rows, held_out)
    if not classes:
        raise ValueError("no rows with a label")
    if not scale:
        scaling = [(np.zeros_like(m), np.ones_like(f)) for m, f in scaling]
    costs, pairs = [float(c) for c in costs], class_pairs(len(classes))
    cosines = Cosines.draw(len(scaling[0][0]), size, gamma, seed)
    shape = (len(held_out), len(costs), len(pairs))
    group, cost, pair = (i.ravel() for i in np.indices(shape))
    n = counts[group, pairs[pair, 0]] + counts[group, pairs[pair, 1]] if len(pair) else np.zeros(0)
    penalty = 1.0 / (np.array(costs)[cost] * np.maximum(n, 1))
    machines = Machines(classes, costs, scaling, cosines, np.zeros((*shape, size + 1)), np.zeros(shape), 0)
    if not len(pair):
        return machines

    def evaluate(points, which, width):
        chosen = [np.flatnonzero(group[which] == g) for g in range(len(held_out))]
        sums = _losses(rows, machines, held_out, [(points[c].T.copy(), pairs[pair[which[c]]]) for c in chosen], width)
        values, gradients = np.zeros(len(which)), np.zeros_like(points)
        for c, found in zip(chosen, sums):
            values[c], gradients[c] = found[-1], found[:-1].T
        rows_of = np.maximum(n[which], 1)
        weights = points.copy()
        weights[:, -1] = 0.0  # the intercept is free
        values = values / rows_of + penalty[which] / 2 * (weights**2).sum(axis=1)
        return values, gradients / rows_of[:, None] + penalty[which][:, None] * weights

    points, passes = np.zeros((len(pair), size + 1)), 1
    for width, share in ROUNDING:
        points, _, read = minimise(lambda p, w, width=width: evaluate(p, w, width), points, max(1, round(share * max_iter)))
        passes += read
    values, _ = evaluate(points, np.arange(len(pair)), 0.0)
    return machines._replace(weights=points.reshape(*shape, -1), objectives=values.reshape(shape), passes=passes)


def rbf_machine(
    train: DataFrame, label: str, features: str = "features", gamma: float = GAMMA, cost: float = COST, size: int = SIZE, seed: int = 0,
    max_iter: int = MAX_ITER, scale: bool = True,
) -> PairwiseModel:
    """Support-vector classification with an approximated RBF kernel, one machine for each pair of classes.

    A kernel machine needs all pairs of rows; linear machines on ``size`` random cosine features need none. More
    features approximate the kernel better. Rows without a label take no part.
    """
    return PairwiseModel(fit_machines(narrow_rows(train, label, features), [cost], (-1,), gamma, size, seed, max_iter, scale), features)


def held_out_accuracy(rows: DataFrame, machines: Machines, held_out) -> np.ndarray:
    """(group, cost): the share of a group's held-out rows that its machines predict, in one pass."""
    classes, pairs = np.array(machines.classes), class_pairs(len(machines.classes))

    def run(batches):
        n, right = np.zeros(len(held_out), np.int64), np.zeros((len(held_out), len(machines.costs)), np.int64)
        for batch in batches:
            folds, labels, x = _batch(batch, classes)
            for g, held in enumerate(held_out):
                for at in range(0, len(x), SLICE):
                    mine = folds[at : at + SLICE, held] > 0
                    z, own = machines.mapped(x[at : at + SLICE][mine], g), labels[at : at + SLICE][mine]
                    rows_of = folds[at : at + SLICE, held][mine]
                    n[g] += rows_of.sum()
                    for c in range(len(machines.costs)):
                        chosen = np.where(z @ machines.weights[g, c].T > 0, pairs[:, 1], pairs[:, 0])
                        votes = (chosen[:, :, None] == np.arange(len(classes))).sum(axis=1)
                        right[g, c] += int(rows_of[votes.argmax(axis=1) == own].sum())
        cells = [(g, c, int(n[g]), int(right[g, c])) for g, c in np.ndindex(right.shape)]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*cells)], ["g", "c", "n", "k"])

    made = rows.mapInArrow(run, "g bigint, c bigint, n bigint, k bigint").groupBy("g", "c").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    share = np.zeros((len(held_out), len(machines.costs)))
    for r in made.collect():
        share[r["g"], r["c"]] = r["k"] / max(r["n"], 1)
    return share
