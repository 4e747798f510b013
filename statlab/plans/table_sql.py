"""The table queries in SQL, where SQL can say them."""

from __future__ import annotations

LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_METRICS = ["p_size", "p_retailprice"]
LABEL_METRICS = ["quality", "toxic", "n_chars"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _long(source: str, ids: list[str], metrics: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {', '.join(ids)}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics
    )


def _stats_long(source: str, group: str, metrics: list[str], decimals: int, flag: bool) -> str:
    long = _long(source, [group], metrics)
    return f"""
        WITH long AS ({long})
        SELECT {f"grouping({group}) = 1 AS is_total," if flag else ""}
               CASE WHEN grouping({group}) = 1 THEN 'all' ELSE CAST({group} AS VARCHAR) END AS "group",
               metric, count(value) AS n, round(median(value), {decimals}) AS median,
               round(avg(value), {decimals}) AS mean, round(stddev_samp(value), {decimals}) AS std
        FROM long GROUP BY GROUPING SETS (({group}, metric), (metric))"""


DOCUMENT_LABELS = (
    "(SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
)


def _extremes(side: str) -> str:
    direction = "DESC" if side == "high" else "ASC"
    return f"""
        SELECT metric, '{side}' AS side, rank, p_partkey, value FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY metric ORDER BY value {direction}, p_partkey) AS INTEGER) AS rank
            FROM ({_long("part", ["p_partkey"], PART_METRICS)}) WHERE value IS NOT NULL
        ) WHERE rank <= 3"""


def _leaders(stat: str) -> str:
    return f"""
        SELECT metric, l_suppkey, total FROM (
            SELECT *, row_number() OVER (PARTITION BY metric ORDER BY round(total, 6) DESC, l_suppkey) AS place
            FROM (SELECT metric, l_suppkey, {stat}(value) AS total
                  FROM ({_long("lineitem", ["l_suppkey"], LINE_METRICS)}) GROUP BY ALL)
        ) WHERE place = 1"""


LEAD_COUNTS = f"""
    SELECT l_suppkey, count(*) AS n_metrics, CAST(min(list_position({LINE_METRICS}, metric)) AS BIGINT) AS first_seen
    FROM ({_leaders("sum")}) GROUP BY l_suppkey"""

MISSPELT = """
    CASE p_partkey % 3 WHEN 0 THEN upper(p_name)
         WHEN 1 THEN substr(p_name, 1, 2) || substr(p_name, 4)
         ELSE replace(substr(p_name, 1, 2) || substr(p_name, 4), 'e', 'é') END"""

FEE_FREE, FEE_ODD = "p_partkey % 10 = 0", "p_partkey % 17 = 0"

CATEGORIES = """
    SELECT user_id, event_type, n, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS INTEGER) AS rank
        FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
    ) WHERE rank <= 2"""

DIMENSIONS = """
    SELECT vec_id, label, unnest(range(0, 64)) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"""

EMBEDDING_MEANS = f"SELECT label, 'd' || d AS metric, avg(x) AS mean FROM ({DIMENSIONS}) GROUP BY label, d"

STANDOUT_RAW = f"""
    WITH means AS (
        SELECT l_returnflag, metric, avg(value) AS mean
        FROM ({_long("lineitem", ["l_returnflag"], [*LINE_METRICS, "l_linenumber"])}) GROUP BY ALL
    ), bars AS (
        SELECT l_returnflag, avg(mean) + stddev_samp(mean) AS bar FROM means GROUP BY l_returnflag
    )
    SELECT l_returnflag, metric, round(mean, 4) AS mean FROM means JOIN bars USING (l_returnflag) WHERE mean > bar"""

STANDOUT_SCALED = f"""
    WITH means AS ({EMBEDDING_MEANS}),
    scaled AS (
        SELECT label, metric, mean, (mean - avg(mean) OVER (PARTITION BY metric))
               / stddev_samp(mean) OVER (PARTITION BY metric) AS z FROM means
    ), bars AS (
        SELECT label, avg(z) + 1.5 * stddev_samp(z) AS bar FROM scaled GROUP BY label
    )
    SELECT label, metric, round(mean, 6) AS mean FROM scaled JOIN bars USING (label) WHERE z > bar"""

# The wording of the reports of extremes and leaders.
EXTREME_LINES = f"""
    WITH found AS ({_extremes("high")} UNION ALL {_extremes("low")}),
    blocks AS (SELECT unnest({PART_METRICS}) AS metric, unnest([1, 2]) AS block)
    SELECT CAST(block AS BIGINT) AS block, CAST(line_no AS BIGINT) AS line_no, line FROM (
        SELECT block, 1 AS line_no, 'Chỉ số: ' || metric AS line FROM blocks
        UNION ALL SELECT block, 2, '  Top 3 cầu thủ cao nhất:' FROM blocks
        UNION ALL SELECT block, 6, '  Top 3 cầu thủ thấp nhất:' FROM blocks
        UNION ALL SELECT block, 10, repeat('-', 40) FROM blocks
        UNION ALL SELECT block, CASE side WHEN 'high' THEN 2 ELSE 6 END + rank,
                         '    - ' || p_partkey || ' (Chỉ số: ' || printf('%.2f', value) || ')'
                  FROM found JOIN blocks USING (metric)
    )"""

LEADER_LINES = f"""
    WITH led AS ({_leaders("sum")}), counts AS ({LEAD_COUNTS}),
    best AS (SELECT * FROM counts ORDER BY n_metrics DESC, first_seen LIMIT 1)
    SELECT CAST(block AS BIGINT) AS block, CAST(line_no AS BIGINT) AS line_no, line FROM (
        SELECT 1 AS block, 1 AS line_no,
               'Phân tích đội có điểm số cao nhất cho từng chỉ số tích cực - line items' AS line
        UNION ALL SELECT 1, 2, repeat('=', 80)
        UNION ALL SELECT 1, 3, ''
        UNION ALL SELECT 1, 4, '1. Đội dẫn đầu cho từng chỉ số tích cực:'
        UNION ALL SELECT 2, list_position({LINE_METRICS}, metric),
                         '- ' || metric || ': ' || l_suppkey || ' (' || printf('%.2f', total) || ')' FROM led
        UNION ALL SELECT 3, 1, ''
        UNION ALL SELECT 3, 2, '2. Đội thể hiện tốt nhất:'
        UNION ALL SELECT 4, 1, 'Đội ' || l_suppkey || ' dẫn đầu trong ' || n_metrics
                         || ' chỉ số tích cực, thể hiện phong độ xuất sắc nhất tại line items.' FROM best
        UNION ALL SELECT 5, 1, ''
        UNION ALL SELECT 5, 2, '3. Danh sách các đội và số chỉ số tích cực dẫn đầu:'
        UNION ALL SELECT 6, row_number() OVER (ORDER BY n_metrics DESC, first_seen),
                         '- ' || l_suppkey || ': ' || n_metrics || ' chỉ số' FROM counts
    )"""


CUSTOMER_METRICS = ["c_acctbal", "c_custkey", "c_nationkey"]

# The four groups of customers, numbered by size and then by their place.
FITTED = """
    SELECT customer.*, CAST(place - 1 AS INTEGER) AS cluster FROM customer JOIN (
        SELECT c_nationkey % 4 AS g, row_number() OVER (ORDER BY count(*), c_nationkey % 4) AS place
        FROM customer GROUP BY 1
    ) ON c_nationkey % 4 = g"""

SPREAD = """
    SELECT CAST(k AS INTEGER) AS k, inertia, lag(inertia) OVER (ORDER BY k) - inertia AS drop FROM (
        SELECT 1 AS k, count(*) * (var_pop(x) + var_pop(y)) AS inertia
        FROM (SELECT c_nationkey % 4 * 1000.0::DOUBLE AS x, c_acctbal / 100 AS y FROM customer)
        UNION ALL
        SELECT 4, sum(s) FROM (SELECT count(*) * var_pop(c_acctbal / 100) AS s FROM customer GROUP BY c_nationkey % 4)
    )"""

# The wording of the cluster report.
def _cluster_lines(customers: str) -> str:
    return f"""
    WITH c AS ({customers}),
    sizes AS (SELECT cluster, count(*) AS size FROM c GROUP BY cluster),
    means AS (
        SELECT cluster, metric, list_position({CUSTOMER_METRICS}, metric) AS ord, avg(value) AS mean,
               printf('%.6f', avg(value)) AS shown
        FROM ({_long("c", ["cluster"], CUSTOMER_METRICS)}) GROUP BY cluster, metric
    ),
    high AS (
        SELECT cluster, string_agg(metric, ', ' ORDER BY ord) AS items FROM (
            SELECT *, avg(mean) OVER w + stddev_samp(mean) OVER w AS bar FROM means WINDOW w AS (PARTITION BY cluster)
        ) WHERE mean > bar GROUP BY cluster
    ),
    main AS (
        SELECT cluster, string_agg(c_mktsegment, ', ' ORDER BY place) AS items FROM (
            SELECT cluster, c_mktsegment,
                   row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, c_mktsegment) AS place
            FROM c GROUP BY cluster, c_mktsegment
        ) WHERE place <= 2 GROUP BY cluster
    ),
    members AS (
        SELECT * FROM (SELECT cluster, c_name, c_mktsegment,
                              row_number() OVER (PARTITION BY cluster ORDER BY c_name) AS place FROM c) WHERE place <= 5
        UNION ALL SELECT cluster, 'C_name', 'C_mktsegment', 0 FROM sizes
    )
    SELECT CAST(block AS BIGINT) AS block, CAST(line_no AS BIGINT) AS line_no, line FROM (
        SELECT unnest([1, 1, 1, 1, 1, 1, 1, 1, 10, 10, 10, 15, 15]) AS block,
               unnest([1, 2, 3, 4, 5, 6, 1004, 1005, 0, 1, 2, 1, 2]) AS line_no,
               unnest(['PHÂN TÍCH CÁC CỤM CẦU THỦ BẰNG K-MEANS (K=4)', '', 'Số cụm (K) đã sử dụng: 4', '',
                       'Số lượng cầu thủ trong mỗi cụm:', 'Cluster', '',
                       'Đặc điểm trung bình của các chỉ số cho từng cụm (giá trị gốc, sau khi xử lý NaN):', '',
                       '=== NHẬN XÉT VỀ KẾT QUẢ PHÂN CỤM ===', '2. Diễn giải các cụm:', '',
                       '3. Nhận xét về biểu đồ PCA:']) AS line
        UNION ALL SELECT 1, 1000 + cluster,
                         cluster || '    ' || lpad(CAST(size AS VARCHAR), CAST(max(length(CAST(size AS VARCHAR))) OVER () AS INTEGER), ' ')
                  FROM sizes
        UNION ALL SELECT 2 + 2 * cluster, 0, '' FROM sizes
        UNION ALL SELECT 2 + 2 * cluster, 1, '--- Cụm ' || cluster || ' (' || size || ' cầu thủ) ---' FROM sizes
        UNION ALL SELECT 2 + 2 * cluster, 1 + ord,
                         rpad(metric, 15, ' ') || lpad(shown, CAST(max(length(shown)) OVER (PARTITION BY cluster) AS INTEGER), ' ')
                  FROM means
        UNION ALL SELECT 3 + 2 * cluster, 0, '' FROM sizes
        UNION ALL SELECT 3 + 2 * cluster, 1, 'Cầu thủ ví dụ (và vị trí của họ):' FROM sizes
        UNION ALL SELECT 3 + 2 * cluster, 2 + place,
                         lpad(c_name, CAST(max(length(c_name)) OVER (PARTITION BY cluster) AS INTEGER), ' ') || ' '
                         || lpad(c_mktsegment, CAST(max(length(c_mktsegment)) OVER (PARTITION BY cluster) AS INTEGER), ' ')
                  FROM members
        UNION ALL SELECT 11 + cluster, 1, '- Cụm ' || cluster || ':' FROM sizes
        UNION ALL SELECT 11 + cluster, 2, '  + Đặc trưng bởi các chỉ số cao: ' || coalesce(items, '')
                  FROM sizes LEFT JOIN high USING (cluster)
        UNION ALL SELECT 11 + cluster, 3, '  + Chủ yếu là: ' || items FROM main
        UNION ALL SELECT 15, 3, '- Biểu đồ phân cụm 2D hiển thị các cụm trong không gian 2 chiều, giải thích '
                         || printf('%.2f', avg(CASE WHEN c_acctbal > 0 THEN 100.0 ELSE 0.0 END)) || '% phương sai.' FROM c
    )"""


def _similar(left: str, condition: str, max_distance: int) -> str:
    """The closest part name for each distinct name, then back to the rows."""
    return f"""
        WITH l AS ({left}),
        r AS (SELECT p_brand AS brand, p_name, min(p_partkey) AS id FROM part GROUP BY ALL),
        names AS (SELECT DISTINCT p_brand, folded FROM l),
        pairs AS (
            SELECT n.p_brand, n.folded, r.p_name, min(r.id) AS id, min(levenshtein(n.folded, r.p_name)) AS distance
            FROM names n JOIN r ON {condition} AND levenshtein(n.folded, r.p_name) <= {max_distance}
            GROUP BY ALL
        ),
        best AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, folded ORDER BY distance, p_name) AS place
                           FROM pairs) WHERE place = 1
        )
        SELECT l.p_partkey, l.name, best.p_name AS match_name, best.id AS match_id,
               CAST(best.distance AS INTEGER) AS distance
        FROM l LEFT JOIN best ON l.p_brand = best.p_brand AND l.folded = best.folded"""


def _nation(key: str) -> str:
    return f"CASE WHEN {key} < 18 THEN 'N' ELSE 'NATION_' END || {key}"


def _resolved(key: str) -> str:
    return f"CASE WHEN {key} < 12 OR {key} >= 18 THEN 'NATION_' ELSE 'N' END || {key}"


SQL = {
    "group_stats_with_total": """
        SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'all' ELSE l_returnflag END AS "group", """
    + ", ".join(
        f"""round(median({m}), 4) AS "Median of {m}", round(avg({m}), 4) AS "Mean of {m}",
            round(stddev_samp({m}), 4) AS "Std of {m}" """
        for m in LINE_METRICS
    )
    + " FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())",
    "group_stats_long": _stats_long("lineitem", "l_suppkey", LINE_METRICS, 4, True),
    "group_stats_single_row": """
        SELECT CASE WHEN grouping(s_nationkey) = 1 THEN 'all' ELSE CAST(s_nationkey AS VARCHAR) END AS "group",
               count(s_acctbal) AS n, printf('%.5f', median(s_acctbal)) AS median,
               printf('%.5f', avg(s_acctbal)) AS mean,
               CASE WHEN count(s_acctbal) < 2 THEN 'N/A' ELSE printf('%.5f', stddev_samp(s_acctbal)) END AS std
        FROM supplier GROUP BY GROUPING SETS ((s_nationkey), ())""",
    "null_safe_stats": _stats_long(DOCUMENT_LABELS, "lang", LABEL_METRICS, 6, False),
    "null_group_stats": _stats_long(
        "(SELECT nullif(s_nationkey, 7) AS nation, s_acctbal FROM supplier)", "nation", ["s_acctbal"], 5, True
    ),
    "stats_of_events": _stats_long("events", "user_id", ["value"], 5, True),
    "top3_per_metric": _extremes("high"),
    "bottom3_per_metric": _extremes("low"),
    "extremes_of_lines": f"""
        WITH lines AS (
            SELECT *, printf('%d/%d/%.2f', l_orderkey, l_linenumber, l_extendedprice) AS line FROM lineitem
        ), long AS ({_long("lines", ["line"], LINE_METRICS)})
        SELECT metric, side, rank, line, value FROM (
            SELECT 'high' AS side, metric, line, value,
                   CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, line) AS INTEGER) AS rank FROM long
            UNION ALL
            SELECT 'low' AS side, metric, line, value,
                   CAST(row_number() OVER (PARTITION BY metric ORDER BY value, line) AS INTEGER) AS rank FROM long
        ) WHERE rank <= 3""",
    "first5_per_group": """
        SELECT s_nationkey, s_name, s_acctbal, rank FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name) AS INTEGER) AS rank FROM supplier
        ) WHERE rank <= 5""",
    "leader_per_metric_sum": f"SELECT metric, l_suppkey, round(total, 2) AS total FROM ({_leaders('sum')})",
    "leader_per_metric_mean": f"SELECT metric, l_suppkey, round(total, 6) AS total FROM ({_leaders('avg')})",
    "leader_counts": LEAD_COUNTS,
    "best_group": f"SELECT l_suppkey, n_metrics FROM ({LEAD_COUNTS}) ORDER BY n_metrics DESC, first_seen LIMIT 1",
    "threshold_filter": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000",
    "threshold_filter_strict": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45",
    "money_parse": f"""
        SELECT p_partkey, CASE WHEN {FEE_FREE} THEN 0.0::DOUBLE WHEN {FEE_ODD} THEN NULL ELSE p_retailprice END AS fee_m,
               CASE WHEN {FEE_FREE} THEN 'free' WHEN {FEE_ODD} THEN 'unknown' ELSE 'paid' END AS fee_kind
        FROM part""",
    "route_split": """
        SELECT p_partkey, split_part(p_name, ' ', 1) AS from_club, split_part(p_name, ' ', 2) AS to_club FROM part""",
    "first_token": "SELECT p_partkey, split_part(p_name, ' ', 1) AS first_name FROM part",
    "age_decimal": "SELECT p_partkey, round(p_size + (p_partkey % 365) / 365.0::DOUBLE, 2) AS age FROM part",
    "header_rename": """
        SELECT l_orderkey, l_linenumber, l_quantity AS qty_per_90, l_tax AS tax_pct, l_discount AS discount_into_1_3
        FROM lineitem""",
    "fixed_format": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' ELSE printf('%.2f', o_totalprice / 3) END AS shown
        FROM orders""",
    "clamp_floor": "SELECT c_custkey, greatest(c_acctbal, 0.1::DOUBLE) AS clamped FROM customer",
    "median_impute": f"""
        WITH known AS (
            SELECT doc_id, quality, toxic, CASE WHEN doc_id % 5 <> 0 THEN n_chars END AS n_chars FROM {DOCUMENT_LABELS}
        ), m AS (SELECT median(quality) AS q, median(toxic) AS t, median(n_chars) AS c FROM known)
        SELECT doc_id, CAST(coalesce(quality, q) AS DOUBLE) AS quality, CAST(coalesce(toxic, t) AS DOUBLE) AS toxic,
               CAST(coalesce(n_chars, c) AS DOUBLE) AS n_chars
        FROM known, m""",
    "standardize": """
        SELECT c_custkey, round((c_acctbal - m) / s, 6) AS c_acctbal_z
        FROM customer, (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)""",
    "accent_fold": r"""
        SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '\s+', ' ', 'g'))) AS folded FROM documents""",
    "edit_distance": """
        SELECT p_partkey, CAST(levenshtein(p_name, lower(p_type)) AS INTEGER) AS distance FROM part""",
    "approx_name_join": _similar(
        f"SELECT *, lower(strip_accents(name)) AS folded FROM (SELECT p_partkey, p_brand, {MISSPELT} AS name FROM part)",
        "n.p_brand = r.brand", 2,
    ),
    "approx_name_join_loose": _similar(
        """SELECT *, name AS folded FROM (
            SELECT p_partkey, '' AS p_brand, translate(p_name, 'aiou', '') AS name FROM part)""",
        "TRUE", 3,
    ),
    "inner_match": """
        SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_acctbal > 0""",
    "one_to_many": """
        SELECT c_custkey, c_name, o_orderkey,
               row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_latest
        FROM customer JOIN orders ON c_custkey = o_custkey""",
    "alias_lookup": f"""
        SELECT c_custkey, {_nation("c_nationkey")} AS short, {_resolved("c_nationkey")} AS nation FROM customer""",
    "dest_mismatch": f"""
        SELECT o_orderkey, team, to_team FROM (
            SELECT o_orderkey, n_name AS team, {_resolved("(o_orderkey % 25)")} AS to_team
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        ) WHERE team <> to_team""",
    "metric_difference": """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
    "unpivot_metrics": _long(DOCUMENT_LABELS, ["doc_id"], LABEL_METRICS),
    "pivot_stats": "SELECT user_id, "
    + ", ".join(
        f"nullif(count(*) FILTER (WHERE event_type = '{t}'), 0) AS {t}"
        for t in EVENT_TYPES
    )
    + f", nullif(count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN ({str(EVENT_TYPES)[1:-1]})), 0) AS other"
    + " FROM events GROUP BY user_id",
    "total_with_groups": """
        SELECT coalesce(c_mktsegment, 'all') AS c_mktsegment, count(*) AS n
        FROM customer GROUP BY GROUPING SETS ((c_mktsegment), ())""",
    "distinct_groups": "SELECT DISTINCT lang, source FROM documents",
    "category_top2": CATEGORIES,
    "category_list": f"""
        SELECT user_id, string_agg(event_type, ', ' ORDER BY rank) AS main_types FROM ({CATEGORIES}) GROUP BY user_id""",
    "cluster_sizes": "SELECT label, count(*) AS size FROM embeddings GROUP BY label",
    "cluster_profile": f"SELECT label, metric, round(mean, 6) AS mean FROM ({EMBEDDING_MEANS})",
    "standout_features": STANDOUT_RAW,
    "standout_features_scaled": STANDOUT_SCALED,
    "nearest_centroid": f"""
        WITH points AS ({DIMENSIONS}),
        centres AS (SELECT label AS c, d, avg(x) AS y FROM points GROUP BY label, d),
        measured AS (
            SELECT vec_id, c, sum((x - y) * (x - y)) AS squared FROM points JOIN centres USING (d) GROUP BY vec_id, c
        )
        SELECT vec_id, c AS nearest, round(sqrt(squared), 6) AS distance FROM (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY squared, c) AS place FROM measured
        ) WHERE place = 1""",
    "regr_by_group": """
        SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
               round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
               round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
               round(regr_r2(l_extendedprice, l_quantity), 8) AS r2
        FROM lineitem GROUP BY l_returnflag""",
    "regression_quality": """
        WITH lines AS (
            SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope,
                   regr_intercept(l_extendedprice, l_quantity) AS intercept
            FROM lineitem GROUP BY l_returnflag
        ), fitted AS (
            SELECT l_linestatus, l_extendedprice AS y, intercept + slope * l_quantity - l_extendedprice AS e
            FROM lineitem JOIN lines USING (l_returnflag)
        )
        SELECT l_linestatus, count(*) AS n, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
               round(1 - avg(e * e) / var_pop(y), 8) AS r2
        FROM fitted GROUP BY l_linestatus""",
    "residuals": """
        WITH lines AS (
            SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope,
                   regr_intercept(l_extendedprice, l_quantity) AS intercept
            FROM lineitem GROUP BY l_returnflag
        )
        SELECT l_orderkey, l_linenumber, round(intercept + slope * l_quantity - l_extendedprice, 4) AS residual
        FROM lineitem JOIN lines USING (l_returnflag)""",
    "value_line": """
        WITH part_rows AS (
            SELECT p_partkey, p_type, p_retailprice - 930 AS actual, p_size,
                   CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS is_train FROM part
        ), lines AS (
            SELECT p_type, regr_slope(actual, p_size) AS slope, regr_intercept(actual, p_size) AS intercept
            FROM part_rows WHERE is_train GROUP BY p_type
        )
        SELECT p_partkey, p_type, actual, p_size, is_train,
               round(greatest(intercept + slope * p_size, 0.1::DOUBLE), 2) AS predicted
        FROM part_rows JOIN lines USING (p_type)""",
    "train_test_split": """
        SELECT c_custkey, CAST('0x' || substr(md5(c_name), 1, 8) AS BIGINT) % 100 < 80 AS is_train FROM customer""",
    "extremes_report": EXTREME_LINES,
    "leaders_report": LEADER_LINES,
    "cluster_report": _cluster_lines("SELECT *, c_nationkey % 4 AS cluster FROM customer"),
    "cluster_report_fitted": _cluster_lines(FITTED),
    "kmeans_separated": f"SELECT c_custkey, cluster FROM ({FITTED})",
    "elbow_separated": f"SELECT k, round(inertia, 0) AS inertia, round(drop, 0) AS drop FROM ({SPREAD})",
    "pca_pair": """
        WITH z AS (
            SELECT c_custkey, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER () AS a,
                   (c_nationkey - avg(c_nationkey) OVER ()) / stddev_samp(c_nationkey) OVER () / 2 AS b FROM customer
        ), s AS (
            SELECT covar_samp(a, b) AS c, (1.25 + sqrt(0.75 * 0.75 + 4 * covar_samp(a, b) * covar_samp(a, b))) / 2 AS l FROM z
        ), v AS (
            SELECT l, (l - 0.25) / sqrt((l - 0.25) * (l - 0.25) + c * c) AS p, c / sqrt((l - 0.25) * (l - 0.25) + c * c) AS q FROM s
        )
        SELECT c_custkey, round(p * a + q * b, 5) AS pc1, round(p * b - q * a, 5) AS pc2, round(l / 1.25, 5) AS explained FROM z, v""",
    "wide_group_stats": """
        SELECT CASE WHEN grouping(label) = 1 THEN 'all' ELSE CAST(label AS VARCHAR) END AS "group", """
    + ", ".join(
        f"""round(median(embedding[{i + 1}]::DOUBLE), 6) AS "Median of d{i}", round(avg(embedding[{i + 1}]::DOUBLE), 6) AS "Mean of d{i}",
            round(stddev_samp(embedding[{i + 1}]::DOUBLE), 6) AS "Std of d{i}" """
        for i in range(64)
    )
    + " FROM embeddings GROUP BY GROUPING SETS ((label), ())",
    "wide_extremes": f"""
        SELECT metric, side, CAST(rank AS INTEGER) AS rank, vec_id, value FROM (
            SELECT 'd' || d AS metric, 'high' AS side, vec_id, x AS value,
                   row_number() OVER (PARTITION BY d ORDER BY x DESC, vec_id) AS rank FROM ({DIMENSIONS})
            UNION ALL
            SELECT 'd' || d, 'low', vec_id, x, row_number() OVER (PARTITION BY d ORDER BY x, vec_id) FROM ({DIMENSIONS})
        ) WHERE rank <= 3""",
    "wide_leaders": f"""
        SELECT metric, label, round(total, 5) AS total FROM (
            SELECT *, row_number() OVER (PARTITION BY metric ORDER BY round(total, 6) DESC, label) AS place
            FROM (SELECT 'd' || d AS metric, label, sum(x) AS total FROM ({DIMENSIONS}) GROUP BY ALL)
        ) WHERE place = 1""",
    "approx_name_join_many": """
        WITH l AS (SELECT p_partkey, p_brand, substr(full_name, 1, 4) || substr(full_name, 6) AS name FROM (
                SELECT *, p_name || ' ' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS full_name FROM part)),
        r AS (SELECT p_brand, p_name || ' ' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS full_name, min(p_partkey) AS id
              FROM part GROUP BY ALL),
        best AS (
            SELECT l.p_partkey, min({'d': levenshtein(name, full_name), 'n': full_name, 'id': id}) AS b
            FROM l JOIN r USING (p_brand) WHERE levenshtein(name, full_name) <= 2 GROUP BY l.p_partkey
        )
        SELECT l.p_partkey, name, b.n AS match_name, b.id AS match_id, CAST(b.d AS INTEGER) AS distance
        FROM l LEFT JOIN best USING (p_partkey)""",
    "approx_name_join_words": """
        WITH p AS (SELECT *, substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS code FROM part),
        l AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN code || ' ' || p_name ELSE p_name || ' ' || code END AS name FROM p),
        r AS (SELECT lower(p_type) || ' ' || p_name || ' ' || lower(p_brand) || ' ' || code AS full_name, min(p_partkey) AS id FROM p GROUP BY 1),
        pairs AS (
            SELECT l.p_partkey, full_name, id, list_distinct(string_split(name, ' ')) AS a, list_distinct(string_split(full_name, ' ')) AS b
            FROM l JOIN r ON list_has_all(string_split(full_name, ' '), string_split(name, ' '))
        ),
        best AS (SELECT p_partkey, min({'d': len(b) - len(a), 'n': full_name, 'id': id}) AS b FROM pairs GROUP BY 1)
        SELECT l.p_partkey, name, b.n AS match_name, b.id AS match_id, CAST(b.d AS INTEGER) AS distance
        FROM l LEFT JOIN best USING (p_partkey)""",
    "value_line_sparse": """
        WITH part_rows AS (
            SELECT p_partkey, p_retailprice - 930 AS actual, p_size,
                   CASE p_partkey % 10 WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'only ' || p_partkey ELSE p_type END AS kind,
                   CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS is_train FROM part
        ), lines AS (
            SELECT kind, CASE WHEN var_pop(p_size) > 0 THEN covar_pop(actual, p_size) / var_pop(p_size) ELSE 0 END AS slope,
                   avg(actual) AS y, avg(p_size) AS x
            FROM part_rows WHERE is_train AND kind IS NOT NULL GROUP BY kind
        )
        SELECT p_partkey, part_rows.kind, actual, p_size, is_train,
               CASE WHEN y IS NOT NULL THEN round(greatest(y + slope * (p_size - x), 0.1::DOUBLE), 2) END AS predicted
        FROM part_rows LEFT JOIN lines ON part_rows.kind = lines.kind""",
    "value_two_features": """
        WITH part_rows AS (
            SELECT p_partkey, p_type, p_retailprice AS actual, p_size, p_partkey % 101 AS turn,
                   CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS is_train FROM part
        ), s AS (
            SELECT p_type, var_pop(p_size) AS aa, var_pop(turn) AS bb, covar_pop(p_size, turn) AS ab, covar_pop(p_size, actual) AS ay,
                   covar_pop(turn, actual) AS by_, avg(p_size) AS a, avg(turn) AS b, avg(actual) AS y
            FROM part_rows WHERE is_train GROUP BY p_type
        )
        SELECT p_partkey, is_train, round(greatest(0.1::DOUBLE, y + (bb * ay - ab * by_) / (aa * bb - ab * ab) * (p_size - a)
               + (aa * by_ - ab * ay) / (aa * bb - ab * ab) * (turn - b)), 2) AS predicted
        FROM part_rows JOIN s USING (p_type)""",
    "csv_by_name": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "table_scan": "SELECT s_acctbal, s_name, s_suppkey FROM supplier",
    "csv_roundtrip": """
        SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer""",
    "csv_multiline": """
        SELECT p_partkey, split_part(p_name, ' ', 1) AS from_club, split_part(p_name, ' ', 2) AS to_club FROM part""",
    "csv_sorted": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "report_text": f"SELECT line FROM ({EXTREME_LINES})",
}
