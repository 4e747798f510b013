"""The queries on cubes, multisets and summaries in SQL."""

from __future__ import annotations


def _rows_of(status: str) -> str:
    return f"""SELECT CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 40 END AS BIGINT) AS bucket,
                      CASE WHEN o_custkey % 7 <> 0 THEN o_orderpriority END AS priority FROM orders WHERE o_orderstatus = '{status}'"""


def _keys_of(flag: str) -> str:
    return f"SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = '{flag}'"


SQL: dict[str, str] = {
    "cube_distinct_counts": """
        SELECT l_returnflag, l_linestatus, l_linenumber, CAST(GROUPING(l_returnflag, l_linestatus, l_linenumber) AS BIGINT) AS grouping_id,
               count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers, count(*) AS n, sum(l_quantity) AS quantity,
               max(l_extendedprice) AS dearest
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
    "rollup_distinct_counts": """
        SELECT kind, day, CAST(GROUPING(kind, day) AS BIGINT) AS grouping_id, count(DISTINCT user_id) AS n_users, count(*) AS n, min(event_id) AS first_event
        FROM (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, CAST(day(ts) AS INTEGER) AS day, user_id, event_id FROM events)
        GROUP BY ROLLUP (kind, day)""",
    "intersect_all": f"""
        SELECT bucket, priority, count(*) AS copies FROM ({_rows_of("O")} INTERSECT ALL {_rows_of("F")} INTERSECT ALL {_rows_of("P")}) GROUP BY ALL""",
    "except_all": f"""
        SELECT bucket, priority, count(*) AS copies FROM ({_rows_of("O")} EXCEPT ALL {_rows_of("F")} EXCEPT ALL {_rows_of("P")}) GROUP BY ALL""",
    "except_distinct": f"""{_keys_of("R")} EXCEPT {_keys_of("A")} EXCEPT {_keys_of("N")}""",
    "sketch_quality": """
        SELECT event_type, count(value) AS n, count(DISTINCT user_id) AS n_users, true AS users_near, true AS quantiles_near
        FROM events GROUP BY event_type""",
}
