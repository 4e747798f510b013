"""Boosted trees per category on the tables, one query each, and the same in SQL where a tree is one split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlab.operators import boost, regress
from statlab.plans.table_queries import table

FEATURES = ["quantity", "discount", "tax"]
STUMP = boost.Trees(rounds=1, depth=1, rate=0.5, least=5)
SMALL = boost.Trees(rounds=4, depth=2)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    discount = F.when(F.col("l_linenumber") != 3, F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("quantity"), discount.alias("discount"),
        F.col("l_tax").alias("tax"), F.col("l_extendedprice").alias("price"))


def boost_root_gains(spark: SparkSession, sf: str) -> DataFrame:
    """Gain of every first cut of the prices of each supplier's lines."""
    return boost.root_gains(_lines(spark, sf), "l_suppkey", FEATURES, "price", STUMP)


def boost_stumps(spark: SparkSession, sf: str) -> DataFrame:
    """Every line's price by its supplier's best single cut."""
    lines = _lines(spark, sf)
    model = boost.fit(lines, "l_suppkey", FEATURES, "price", STUMP)
    return boost.predict(lines, model, "l_suppkey", FEATURES, STUMP.depth).select("l_orderkey", "l_linenumber", "price", "predicted")


def value_trees(spark: SparkSession, sf: str) -> DataFrame:
    """The retail price of parts by trees of their type, fitted on the training share."""
    part = table(spark, sf, "part").select("p_partkey", "p_type", F.col("p_retailprice").alias("actual"), "p_size")
    return regress.estimate_by_category(part, "p_type", ["p_size", "p_partkey"], "actual", "p_partkey", regressor=SMALL)


QUERIES = {f.__name__: f for f in [boost_root_gains, boost_stumps, value_trees]}

_CUTS = f"""
    WITH items AS (
        SELECT l_orderkey, l_linenumber, l_suppkey AS c, CAST(l_quantity AS DOUBLE) AS x0,
               CASE WHEN l_linenumber <> 3 THEN CAST(l_discount AS DOUBLE) END AS x1, CAST(l_tax AS DOUBLE) AS x2,
               CAST(l_extendedprice AS DOUBLE) AS y
        FROM lineitem),
    ends AS (SELECT c, min(y) AS low, (max(y) - min(y)) / {boost.UNITS} AS unit FROM items GROUP BY c),
    counted AS (SELECT i.*, low, unit, CASE WHEN unit > 0 THEN CAST(floor((y - low) / unit) AS BIGINT) ELSE 0 END AS units FROM items i JOIN ends USING (c)),
    means AS (SELECT c, CAST(floor(CAST(sum(units) AS DOUBLE) / count(*)) AS BIGINT) AS base FROM counted GROUP BY c),
    cells_of AS (
        SELECT c, l_orderkey, l_linenumber, units - base AS r, unnest([0, 1, 2]) AS f, unnest([x0, x1, x2]) AS x FROM counted JOIN means USING (c)),
    ranges AS (SELECT c, f, min(x) AS lo, max(x) AS hi FROM cells_of GROUP BY c, f),
    cells AS (
        SELECT c, f, CASE WHEN hi > lo THEN floor(greatest(0, least({boost.CELLS - 1}, (x - lo) / (hi - lo) * {boost.CELLS}))) ELSE 0 END AS cell,
               count(*) AS n, max(x) AS top
        FROM cells_of JOIN ranges USING (c, f) WHERE x IS NOT NULL GROUP BY ALL),
    numbered AS (
        SELECT c, f, top, floor(CAST(coalesce(sum(n) OVER (PARTITION BY c, f ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                                     * {STUMP.bins} AS DOUBLE) / sum(n) OVER (PARTITION BY c, f)) AS bin
        FROM cells),
    tops AS (SELECT c, f, max(top) AS top FROM numbered GROUP BY c, f, bin),
    edges AS (
        SELECT c, f, top, row_number() OVER (PARTITION BY c, f ORDER BY top) AS b, coalesce(lag(top) OVER (PARTITION BY c, f ORDER BY top), -1e300) AS below
        FROM tops),
    placed AS (
        SELECT s.c, s.f, s.l_orderkey, s.l_linenumber, s.r, CASE WHEN x IS NULL THEN 0 ELSE b END AS b, CASE WHEN x IS NOT NULL THEN top END AS top
        FROM cells_of s LEFT JOIN edges e ON s.c = e.c AND s.f = e.f AND x <= top AND x > below),
    sums AS (SELECT c, f, b, max(top) AS top, sum(r) AS g, count(*) AS n FROM placed GROUP BY c, f, b),
    so_far AS (
        SELECT c, f, b, top, CAST(sum(g) OVER upto AS BIGINT) AS gl, CAST(sum(n) OVER upto AS BIGINT) AS nl,
               CAST(sum(g) OVER (PARTITION BY c, f) AS BIGINT) AS g, CAST(sum(n) OVER (PARTITION BY c, f) AS BIGINT) AS n
        FROM sums WINDOW upto AS (PARTITION BY c, f ORDER BY b ROWS UNBOUNDED PRECEDING)),
    cuts AS (
        SELECT *, CAST(gl AS DOUBLE) * gl / (nl + 1.0::DOUBLE) + CAST(g - gl AS DOUBLE) * (g - gl) / (n - nl + 1.0::DOUBLE)
                  - CAST(g AS DOUBLE) * g / (n + 1.0::DOUBLE) AS gain
        FROM so_far),
    allowed AS (SELECT * FROM cuts WHERE nl >= {STUMP.least} AND n - nl >= {STUMP.least} AND gain > 0)"""

SQL: dict[str, str] = {
    "boost_root_gains": f"{_CUTS} SELECT c, CAST(f AS INTEGER) AS f, top AS threshold, nl AS n_left, gain FROM allowed",
    "boost_stumps": f"""{_CUTS},
    best AS (SELECT * FROM allowed QUALIFY row_number() OVER (PARTITION BY c ORDER BY gain DESC, f, b) = 1),
    leaves AS (
        SELECT l_orderkey, l_linenumber, c, base, low, unit, y, CASE
                   WHEN s.f IS NULL THEN floor({STUMP.rate}::DOUBLE * all_g / (all_n + 1.0::DOUBLE))
                   WHEN coalesce([x0, x1, x2][s.f + 1] <= s.top, s.b >= 0 AND [x0, x1, x2][s.f + 1] IS NULL)
                   THEN floor({STUMP.rate}::DOUBLE * s.gl / (s.nl + 1.0::DOUBLE))
                   ELSE floor({STUMP.rate}::DOUBLE * (s.g - s.gl) / (s.n - s.nl + 1.0::DOUBLE)) END AS leaf
        FROM counted JOIN means USING (c)
        JOIN (SELECT c, CAST(sum(units - base) AS BIGINT) AS all_g, count(*) AS all_n FROM counted JOIN means USING (c) GROUP BY c) USING (c)
        LEFT JOIN best s USING (c))
    SELECT l_orderkey, l_linenumber, y AS price, low + unit * CAST(base + CAST(leaf AS BIGINT) AS DOUBLE) AS predicted FROM leaves""",
}
