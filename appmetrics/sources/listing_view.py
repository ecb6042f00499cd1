"""A listing-shaped table derived from the driver's star-schema tables.

Only the tables that the asked-for columns need are joined: every line item has exactly one part and
one order, so leaving a dimension out never changes the rows. Catalyst prunes columns by itself but
cannot drop an inner join, so the column list is explicit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PART = {
    "App Name": "p_name",
    "Category": "p_brand",
    "Size": """CASE WHEN p_size % 10 = 0 THEN 'Varies with device' WHEN p_size % 10 = 1 THEN null
        WHEN p_size % 10 = 2 THEN concat(p_size, 'k') WHEN p_size % 10 = 3 THEN '1.2G'
        WHEN p_size % 10 = 4 THEN '1,018M' ELSE concat(p_size, '.5M') END""",
    "Minimum Android": """CASE WHEN p_size % 9 = 0 THEN 'Varies with device'
        ELSE concat(1 + p_size % 8, '.', p_size % 4, ' and up') END""",
    "Editors Choice": "p_size % 20 = 0",
}
_ORDERS = {
    "Installs": """CASE WHEN o_totalprice < 10000 THEN '1,000+' WHEN o_totalprice < 100000 THEN '10,000+'
        WHEN o_totalprice < 300000 THEN '1,000,000+' WHEN l_orderkey % 17 = 0 THEN null ELSE '5,000,000,000+' END""",
    "Minimum Installs": "cast(floor(o_totalprice) AS bigint)",
    "Maximum Installs": "CASE WHEN l_partkey % 19 != 0 THEN cast(floor(o_totalprice * 2) AS bigint) END",
    "Released": "CASE WHEN l_orderkey % 23 != 0 THEN date_format(o_orderdate, 'MMM d, yyyy') END",
    "Content Rating": "o_orderpriority",
}
_LINE = {
    "App Id": "concat_ws('-', 'app', l_orderkey, l_partkey, l_suppkey, l_linenumber)",
    "Rating": "CASE WHEN l_orderkey % 13 != 0 THEN cast(cast(round(l_tax * 100) AS int) AS double) * 5 / 8 END",
    "Rating Count": "cast(floor(l_quantity) AS bigint) * 20",
    "Free": "l_linestatus = 'O'",
    "Price": "CASE WHEN l_linestatus = 'O' THEN 0.0D ELSE l_extendedprice END",
    "Currency": "CASE WHEN l_orderkey % 50 = 0 THEN 'EUR' ELSE 'USD' END",
    "Developer Id": "concat('dev-', l_suppkey)",
    "Developer Website": "CASE WHEN l_suppkey % 2 != 0 THEN concat('http://d', l_suppkey) END",
    "Developer Email": "CASE WHEN l_suppkey % 11 != 0 THEN concat('d', l_suppkey, '@x') END",
    "Last Updated": "date_format(l_shipdate, 'MMM d, yyyy')",
    "Privacy Policy": "CASE WHEN l_suppkey % 3 != 0 THEN concat('http://p', l_suppkey) END",
    "Ad Supported": """CASE WHEN l_partkey % 29 = 0 THEN null WHEN l_returnflag = 'N' THEN 'True' ELSE 'False' END""",
    "In App Purchases": "CASE WHEN l_quantity > 25 THEN 'True' ELSE 'False' END",
    "Scraped Time": "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')",
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a plain file scan at least one partition per core.

    Only a scan with fewer partitions than cores is redistributed (one small file with one row group);
    large tables have many partitions already and pass through.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def listings(spark: SparkSession, sf_dir: str, *columns: str, busy: bool = False) -> DataFrame:
    """The listing view restricted to ``columns`` (all of them if none is named).

    ``busy`` announces much work per row, for which a scan with too few partitions is spread first.
    """
    known = {**_PART, **_ORDERS, **_LINE}
    wanted = list(columns) or list(known)
    df = driver_table(spark, sf_dir, "lineitem")
    if busy:
        df = spread(df)
    if any(c in _PART for c in wanted):
        part = driver_table(spark, sf_dir, "part")
        df = df.join(part, df["l_partkey"] == part["p_partkey"])
    if any(c in _ORDERS for c in wanted):
        orders = driver_table(spark, sf_dir, "orders")
        df = df.join(orders, df["l_orderkey"] == orders["o_orderkey"])
    return df.selectExpr(*[f"{known[c]} AS `{c}`" for c in wanted])


# The same view for an SQL engine that has the driver tables registered.
LISTINGS_SQL = """
SELECT
  p_name AS "App Name",
  concat('app-', l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber) AS "App Id",
  p_brand AS "Category",
  CASE WHEN l_orderkey % 13 = 0 THEN NULL
       ELSE CAST(CAST(round(l_tax * 100) AS INTEGER) AS DOUBLE) * 5 / 8 END AS "Rating",
  CAST(floor(l_quantity) AS BIGINT) * 20 AS "Rating Count",
  CASE WHEN o_totalprice < 10000 THEN '1,000+' WHEN o_totalprice < 100000 THEN '10,000+'
       WHEN o_totalprice < 300000 THEN '1,000,000+' WHEN l_orderkey % 17 = 0 THEN NULL
       ELSE '5,000,000,000+' END AS "Installs",
  CAST(floor(o_totalprice) AS BIGINT) AS "Minimum Installs",
  CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 2) AS BIGINT) END AS "Maximum Installs",
  l_linestatus = 'O' AS "Free",
  CASE WHEN l_linestatus = 'O' THEN 0.0::DOUBLE ELSE l_extendedprice END AS "Price",
  CASE WHEN l_orderkey % 50 = 0 THEN 'EUR' ELSE 'USD' END AS "Currency",
  CASE WHEN p_size % 10 = 0 THEN 'Varies with device' WHEN p_size % 10 = 1 THEN NULL
       WHEN p_size % 10 = 2 THEN concat(p_size, 'k') WHEN p_size % 10 = 3 THEN '1.2G'
       WHEN p_size % 10 = 4 THEN '1,018M' ELSE concat(p_size, '.5M') END AS "Size",
  CASE WHEN p_size % 9 = 0 THEN 'Varies with device'
       ELSE concat(1 + p_size % 8, '.', p_size % 4, ' and up') END AS "Minimum Android",
  concat('dev-', l_suppkey) AS "Developer Id",
  CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE concat('http://d', l_suppkey) END AS "Developer Website",
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE concat('d', l_suppkey, '@x') END AS "Developer Email",
  CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE strftime(o_orderdate, '%b %-d, %Y') END AS "Released",
  strftime(l_shipdate, '%b %-d, %Y') AS "Last Updated",
  o_orderpriority AS "Content Rating",
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE concat('http://p', l_suppkey) END AS "Privacy Policy",
  CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_returnflag = 'N' THEN 'True' ELSE 'False' END AS "Ad Supported",
  CASE WHEN l_quantity > 25 THEN 'True' ELSE 'False' END AS "In App Purchases",
  p_size % 20 = 0 AS "Editors Choice",
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "Scraped Time"
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey
"""
