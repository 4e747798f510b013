"""The queries along time in SQL."""

from __future__ import annotations

HOUR = 3_600_000_000
MONTH_START = 1_704_067_200_000_000

_EVENTS = "(SELECT event_id, user_id, event_type, value, epoch_us(ts) AS moment FROM events)"
_PLACED = f"""(SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey % 160 END AS BIGINT) AS buyer,
                      (o_orderkey * 7919) % 2592000 * 1000000 + {MONTH_START} AS placed FROM orders)"""
#: Of one user's events at one time the one with the greatest id.
_LAST_EVENTS = f"(SELECT user_id, moment, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM {_EVENTS} GROUP BY user_id, moment)"
#: A stream hands on what ended two hours before the greatest time, in milliseconds.
_CLOSED = f"((SELECT max(epoch_us(ts)) FROM events) // 1000 * 1000 - {2 * HOUR})"


def _windows(width: int, slide: int, by: str) -> str:
    """Windows of ``width`` hours every ``slide`` hours; a row is in ``width / slide`` of them."""
    key = f"{by}, " if by else ""
    return f"""
        SELECT {key} start, start + {width * HOUR} AS "end", count(*) AS n, round(sum(value), 4) AS total FROM (
            SELECT *, moment - moment % {slide * HOUR} - unnest(range(0, {width // slide})) * {slide * HOUR} AS start FROM {_EVENTS}
        ) WHERE start + {width * HOUR} <= {_CLOSED} GROUP BY {key} start"""


def _islands(hours: int, strict: bool) -> str:
    """Events numbered by visits: a new one begins where the pause is long enough."""
    pause = f"moment - lag(moment) OVER w {'>' if strict else '>='} {hours * HOUR}"
    return f"""(SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY moment, event_id) AS island FROM (
            SELECT *, coalesce({pause}, true) AS begins, lag(event_type) OVER w AS kind_before FROM {_EVENTS} WINDOW w AS (PARTITION BY user_id ORDER BY moment, event_id)))"""


SQL: dict[str, str] = {
    "asof_orders_events": f"""
        SELECT o_orderkey, buyer, placed, e.event_id AS e_event_id, e.user_id AS e_user_id, e.event_type AS e_event_type, e.value AS e_value, e.moment AS e_moment
        FROM {_PLACED} p ASOF LEFT JOIN {_LAST_EVENTS} e ON p.buyer = e.user_id AND p.placed >= e.moment""",
    "asof_next_error": f"""
        WITH failed AS (SELECT user_id, moment, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM {_EVENTS} WHERE event_type = 'error' GROUP BY user_id, moment)
        SELECT b.event_id, b.user_id, b.value, b.moment, f.event_id AS e_event_id, f.user_id AS e_user_id, f.value AS e_value, f.moment AS e_moment
        FROM (SELECT * FROM {_EVENTS} WHERE event_type = 'purchase') b ASOF JOIN failed f ON b.user_id = f.user_id AND b.moment < f.moment
        WHERE f.moment - b.moment <= {24 * HOUR}""",
    "asof_any_user": f"""
        SELECT o_orderkey, buyer, placed, e.event_id AS e_event_id, e.moment AS e_moment
        FROM {_PLACED} p ASOF LEFT JOIN (SELECT moment, max(event_id) AS event_id FROM {_EVENTS} GROUP BY moment) e ON p.placed > e.moment""",
    "overlapping_orders": """
        WITH s AS (
            SELECT o_orderkey, o_custkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS opened,
                   date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + CASE WHEN o_orderkey % 500 = 0 THEN 3650 ELSE o_orderkey % 30 END AS closed
            FROM orders
        )
        SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS other_o_orderkey FROM s a JOIN s b
        ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.opened <= b.closed AND b.opened <= a.closed""",
    "events_in_spans": f"""
        WITH s AS (
            SELECT *, since + hours * {HOUR} AS until FROM (
                SELECT p_partkey, CASE WHEN p_partkey % 100 = 0 THEN {MONTH_START} ELSE (p_partkey * 37) % 720 * {HOUR} + {MONTH_START} END AS since,
                       CASE WHEN p_partkey % 100 = 0 THEN 10000 ELSE p_size END AS hours FROM part)
        )
        SELECT p_partkey, count(*) AS n, round(sum(value), 4) AS total FROM s JOIN {_EVENTS} e ON e.moment BETWEEN since AND until GROUP BY p_partkey""",
    "cheaper_and_larger": """
        SELECT a.s_suppkey, a.s_acctbal, b.s_suppkey AS other_s_suppkey, b.s_acctbal AS other_s_acctbal
        FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey AND a.s_acctbal > b.s_acctbal""",
    "dominated_parts": """
        SELECT a.p_partkey, count(*) AS n, min(b.p_retailprice) AS cheapest
        FROM part a JOIN part b ON a.p_retailprice > b.p_retailprice AND a.p_size <= b.p_size WHERE a.p_size >= 48 GROUP BY a.p_partkey""",
    "running_totals": f"""
        SELECT event_id, round(sum(value) OVER w, 4) AS total, count(value) OVER w AS n, min(value) OVER w AS least, max(value) OVER w AS most
        FROM {_EVENTS} WINDOW w AS (ORDER BY moment, event_id ROWS UNBOUNDED PRECEDING)""",
    "moving_windows": f"""
        SELECT event_id, lag(event_type) OVER w AS before, lag(event_id, 1500) OVER w AS far_before, lead(moment) OVER w AS next_at,
               round(avg(value) OVER (ORDER BY moment, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS mean7,
               max(value) OVER (ORDER BY moment, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS most7
        FROM {_EVENTS} WINDOW w AS (ORDER BY moment, event_id)""",
    "global_ranks": """
        SELECT quantity, rank, dense_rank, round(percent_rank, 9) AS percent_rank, round(cume_dist, 9) AS cume_dist, count(*) AS n,
               min(row_number) AS from_row, max(row_number) AS to_row, min(ntile) AS from_tile, max(ntile) AS to_tile
        FROM (
            SELECT quantity, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, percent_rank() OVER w AS percent_rank, cume_dist() OVER w AS cume_dist,
                   row_number() OVER w AS row_number, ntile(10) OVER w AS ntile
            FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 25.0::DOUBLE ELSE l_quantity END AS quantity FROM lineitem) WINDOW w AS (ORDER BY quantity)
        ) GROUP BY ALL""",
    "stream_tumbling": _windows(6, 6, "event_type"),
    "stream_sliding": _windows(3, 1, ""),
    "stream_sessions": f"""
        SELECT user_id, min(moment) AS start, max(moment) + {4 * HOUR} AS "end", count(*) AS n, round(sum(value), 4) AS total
        FROM {_islands(4, False)} GROUP BY user_id, island HAVING max(moment) + {4 * HOUR} <= {_CLOSED}""",
    "stream_repeats": f"""
        WITH RECURSIVE n AS (SELECT event_id, user_id, moment, row_number() OVER (PARTITION BY user_id ORDER BY moment, event_id) AS i FROM {_EVENTS}),
        kept AS (
            SELECT user_id, i, event_id, moment, moment AS last, true AS kept FROM n WHERE i = 1
            UNION ALL
            SELECT n.user_id, n.i, n.event_id, n.moment, CASE WHEN n.moment - k.last >= {12 * HOUR} THEN n.moment ELSE k.last END, n.moment - k.last >= {12 * HOUR}
            FROM kept k JOIN n ON n.user_id = k.user_id AND n.i = k.i + 1
        )
        SELECT user_id, event_id, moment FROM kept WHERE kept""",
    "stream_visits": f"""
        WITH v AS (
            SELECT user_id, island, min(moment) AS begin, max(moment) AS last, count(*) AS n, round(sum(value), 4) AS total, arg_max(event_type, event_id) AS last_kind,
                   sum(CASE WHEN NOT begins AND event_type <> kind_before THEN 1 ELSE 0 END) AS n_switches
            FROM {_islands(8, True)} GROUP BY user_id, island
        )
        SELECT user_id, begin, last, n, total, last_kind, CAST(n_switches AS BIGINT) AS n_switches FROM v
        WHERE island < (SELECT max(island) FROM v o WHERE o.user_id = v.user_id) OR last // 1000 * 1000 + {8 * HOUR} + 1000 <= {_CLOSED}""",
}
