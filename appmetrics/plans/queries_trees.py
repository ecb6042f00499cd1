"""Registered queries for trees whose splits are found by counting; SQL finds the same splits, level by level."""

from __future__ import annotations

from appmetrics.functions.scratch import stage
from appmetrics.operators import splits as S
from appmetrics.plans import preparation as P
from appmetrics.plans.catalog import CATALOG, rounded
from appmetrics.plans.queries_modelling import MODEL_COLUMNS, MODEL_SQL
from appmetrics.sources.listing_view import listings

STARS = [1.0, 2.0, 3.0, 4.0, 5.0]


def _rows(spark, sf_dir):
    """Model rows with the listing's id as ``Row``, written once."""
    df = listings(spark, sf_dir, "App Id", *MODEL_COLUMNS).withColumnRenamed("App Id", "Row")
    return stage(rounded(P.model_rows(df, "Price"), "Rating"), "model_rows")


def _points_sql(label: str, targets: list[str], trees: int = 0) -> str:
    """CTEs rows and p0 (tree, node, w, xs, t0..); with ``trees``, each row's weight is drawn for each tree."""
    cells = ", ".join(f'CAST("{c}" AS DOUBLE)' for c in P.model_columns(label))
    t = ", ".join(f"{expr} AS t{j}" for j, expr in enumerate(targets))
    model = MODEL_SQL.replace("sized AS (SELECT ", 'sized AS (SELECT "App Id" AS "Row", ')
    rows = f'listed AS MATERIALIZED (SELECT "Row", [{cells}] AS xs, {t} FROM ({model}))'
    if not trees:
        return f"{rows},\np0 AS (SELECT 0 AS tree, 1 AS node, 1.0::DOUBLE AS w, * FROM listed)"
    times = " + ".join(f"(u >= {p})::INTEGER" for p in S.POISSON)
    draw = """('0x' || left(md5(concat_ws('|', '0-' || tree, "Row")), 8))::BIGINT / 4294967296.0::DOUBLE"""
    return f"""{rows},
p0 AS MATERIALIZED (SELECT *, 1 AS node, ({times})::DOUBLE AS w FROM (SELECT *, {draw} AS u FROM (SELECT *, unnest(range({trees})) AS tree FROM listed)))"""


def _level_sql(level: int, features: int, targets: int, tried: int | None = None, round_: str = "") -> str:
    """CTEs: s (the best split of each node of a level) and, from it, the next p (rows with their next node)."""
    here, found, after = f"p{round_}{level}", f"s{round_}{level}", f"p{round_}{level + 1}"
    sums = [f"t{j}" for j in range(targets)]
    among = f"SELECT * FROM (SELECT DISTINCT tree, node FROM {here} WHERE node >= {2**level}), range({features}) AS f(feature)"
    if tried:
        among += f" QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5(concat_ws('|', '0', tree, node, feature))) <= {tried}"
    upto = ", ".join(f"sum({c}) OVER w AS {c}_upto, sum({c}) OVER (PARTITION BY tree, node, feature) AS {c}_all" for c in ["n", *sums])
    score = " + ".join(
        f"{t}_upto * {t}_upto / n_upto + ({t}_all - {t}_upto) * ({t}_all - {t}_upto) / (n_all - n_upto) - {t}_all * {t}_all / n_all" for t in sums
    )
    return f"""{found} AS MATERIALIZED (SELECT tree, node, feature, value, gain, n_all, n_upto, {", ".join(f"{t}_upto, {t}_all" for t in sums)} FROM (
  SELECT *, ({score}) / n_all AS gain FROM (SELECT *, {upto} FROM (
    SELECT tree, node, feature, xs[feature + 1] AS value, sum(w) AS n, {", ".join(f"sum(w * {t}) AS {t}" for t in sums)}
    FROM {here} JOIN ({among}) USING (tree, node) WHERE w > 0 GROUP BY 1, 2, 3, 4)
    WINDOW w AS (PARTITION BY tree, node, feature ORDER BY value ROWS UNBOUNDED PRECEDING)) WHERE n_upto < n_all)
  WHERE gain > 1e-12::DOUBLE * ({" + ".join(f"{t}_all * {t}_all" for t in sums)}) / (n_all * n_all)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain::FLOAT DESC, feature, value) = 1),
{after} AS MATERIALIZED (SELECT p.* REPLACE (CASE WHEN s.feature IS NULL THEN p.node WHEN xs[s.feature + 1] <= s.value THEN 2 * p.node ELSE 2 * p.node + 1 END AS node)
  FROM {here} AS p LEFT JOIN {found} AS s ON p.tree = s.tree AND p.node = s.node)"""


def _shown_sql(label: str, levels: int, digits: int) -> str:
    names = ", ".join(f"'{c}'" for c in P.model_columns(label))
    every = " UNION ALL ".join(f"SELECT tree, node, feature, value, gain, n_all FROM s{k}" for k in range(levels))
    return f"""SELECT tree::INTEGER AS tree, node::INTEGER AS node, ([{names}])[feature + 1] AS feature, round(value, 4) AS threshold,
      round(gain, {digits}) AS gain, n_all AS rows FROM ({every})"""


def _shown(model, df, digits):
    found = model.nodes(df).filter("feature IS NOT NULL").select("tree", "node", "feature", "threshold", "gain", "rows")
    return rounded(rounded(found, "threshold"), "gain", digits=digits)


def _tree_sql(label: str, targets: list[str], levels: int, digits: int, trees: int = 0, tried: int | None = None) -> str:
    features = len(P.model_columns(label))
    steps = [_level_sql(k, features, len(targets), tried) for k in range(levels)]
    return f"WITH {_points_sql(label, targets, trees)},\n" + ",\n".join(steps) + "\n" + _shown_sql(label, levels, digits)


_PRICE = ['"Price"']
_STARS_SQL = [f'(floor("Rating") = {c})::INTEGER::DOUBLE' for c in STARS]


@CATALOG.add("MOD-3", sql=_tree_sql("Price", _PRICE, 3, 2))
def price_tree_by_counting(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return _shown(S.tree(rows, "Price", P.model_columns("Price"), depth=3), rows, 2)


@CATALOG.add("MOD-4", sql=_tree_sql("Rating", ['"Rating"'], 2, 6, trees=10, tried=5))
def rating_forest_by_counting(spark, sf_dir):
    """Ten trees of drawn rows; each node tries five drawn features."""
    rows = _rows(spark, sf_dir)
    return _shown(S.forest(rows, "Rating", P.model_columns("Rating"), depth=2, trees=10, key=["Row"], tried=5), rows, 6)


_ROUNDS = 3


def _boosted_sql() -> str:
    """Each round's split, then the rows with what it has left; the first tree counts whole, later ones a tenth."""
    features, parts, shown = len(P.model_columns("Price")), [_points_sql("Price", _PRICE)], []
    for k in range(_ROUNDS):
        scale = "1.0" if k == 0 else "0.1"
        before = "p0" if k == 0 else f"r{k - 1}"
        parts.append(f"p{k}_0 AS (SELECT * FROM {before})")
        parts.append(_level_sql(0, features, 1, round_=f"{k}_"))
        step = "CASE WHEN p.node = 2 THEN t0_upto / n_upto ELSE (t0_all - t0_upto) / (n_all - n_upto) END"
        parts.append(f"r{k} AS MATERIALIZED (SELECT p.* REPLACE (1 AS node, p.t0 - {scale}::DOUBLE * ({step}) AS t0) FROM p{k}_1 AS p, s{k}_0)")
        shown.append(f"SELECT {k} AS tree, node, feature, value, gain, n_all FROM s{k}_0")
    names = ", ".join(f"'{c}'" for c in P.model_columns("Price"))
    return (
        "WITH " + ",\n".join(parts) + f"""\nSELECT tree::INTEGER AS tree, node::INTEGER AS node, ([{names}])[feature + 1] AS feature,
      round(value, 4) AS threshold, round(gain, 2) AS gain, n_all AS rows FROM ({" UNION ALL ".join(shown)})"""
    )


@CATALOG.add("MOD-5", sql=_boosted_sql())
def price_boosting_by_counting(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return _shown(S.boosted(rows, "Price", P.model_columns("Price"), rounds=_ROUNDS), rows, 2)


@CATALOG.add("MOD-6", sql=_tree_sql("Rating", _STARS_SQL, 2, 6, trees=10, tried=4))
def stars_forest_by_counting(spark, sf_dir):
    rows = P.K.floor_columns(_rows(spark, sf_dir), "Rating")
    return _shown(S.forest(rows, "Rating", P.model_columns("Rating"), 2, STARS, trees=10, key=["Row"], tried=4), rows, 6)


@CATALOG.add("MOD-7", sql=_tree_sql("Rating", _STARS_SQL, 4, 6))
def stars_tree_by_counting(spark, sf_dir):
    """Gini, four levels."""
    rows = P.K.floor_columns(_rows(spark, sf_dir), "Rating")
    return _shown(S.tree(rows, "Rating", P.model_columns("Rating"), 4, STARS), rows, 6)


@CATALOG.add(
    "MOD-3",
    sql=f"""WITH {_points_sql("Price", _PRICE)},
{_level_sql(0, len(P.model_columns("Price")), 1).split("QUALIFY")[0]} QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain::FLOAT DESC, value) = 1)
SELECT ([{", ".join(f"'{c}'" for c in P.model_columns("Price"))}])[feature + 1] AS feature, round(value, 4) AS threshold, round(gain, 2) AS gain, n_upto AS rows_left FROM s0""",
)
def price_split_of_each_feature(spark, sf_dir):
    found = S.best_splits(_rows(spark, sf_dir), "Price", P.model_columns("Price"))
    return rounded(rounded(found, "threshold"), "gain", digits=2)
