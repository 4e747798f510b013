"""Text reports as DataFrames of numbered lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from statlab.functions.clean import fixed
from statlab.operators.leaders import best_group, lead_counts
from statlab.session import stage

# The wording and rules of the three reports.
METRIC_HEADER = "Chỉ số: %s"
HIGHEST = "  Top %d cầu thủ cao nhất:"
LOWEST = "  Top %d cầu thủ thấp nhất:"
ENTRY = "    - %s (Chỉ số: %s)"
BLOCK_RULE = "-" * 40
LEADER_TITLE = "Phân tích đội có điểm số cao nhất cho từng chỉ số tích cực - %s"
TITLE_RULE = "=" * 80
LEADER_PART = "1. Đội dẫn đầu cho từng chỉ số tích cực:"
LEADER_ENTRY = "- %s: %s (%s)"
BEST_PART = "2. Đội thể hiện tốt nhất:"
BEST_ENTRY = "Đội %s dẫn đầu trong %d chỉ số tích cực, thể hiện phong độ xuất sắc nhất tại %s."
COUNT_PART = "3. Danh sách các đội và số chỉ số tích cực dẫn đầu:"
COUNT_ENTRY = "- %s: %d chỉ số"
CLUSTER_TITLE = "PHÂN TÍCH CÁC CỤM CẦU THỦ BẰNG K-MEANS (K=%d)"
CLUSTER_K = "Số cụm (K) đã sử dụng: %d"
CLUSTER_SIZES = "Số lượng cầu thủ trong mỗi cụm:"
CLUSTER_HEAD = "Cluster"
CLUSTER_MEANS = "Đặc điểm trung bình của các chỉ số cho từng cụm (giá trị gốc, sau khi xử lý NaN):"
CLUSTER_BLOCK = "--- Cụm %d (%d cầu thủ) ---"
CLUSTER_EXAMPLES = "Cầu thủ ví dụ (và vị trí của họ):"
CLUSTER_REMARKS = "=== NHẬN XÉT VỀ KẾT QUẢ PHÂN CỤM ==="
CLUSTER_READING = "2. Diễn giải các cụm:"
CLUSTER_NAME = "- Cụm %d:"
CLUSTER_STANDOUT = "  + Đặc trưng bởi các chỉ số cao: %s"
CLUSTER_POSITIONS = "  + Chủ yếu là: %s"
PCA_PART = "3. Nhận xét về biểu đồ PCA:"
PCA_SHARE = "- Biểu đồ phân cụm 2D hiển thị các cụm trong không gian 2 chiều, giải thích %s%% phương sai."


def _position(metrics: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric"))


def _label(metrics: Sequence[str], labels: dict[str, str] | None) -> Column:
    labels = labels or {}
    return F.get(F.array(*[F.lit(labels.get(m, m)) for m in metrics]), (F.col("ord") - 1).cast("int"))


def _aligned(column: str, over: WindowSpec) -> Column:
    return F.lpad(column, F.max(F.length(column)).over(over), " ")


def _written(spark: SparkSession, lines: Sequence[tuple[int, int, str]]) -> DataFrame:
    return spark.createDataFrame(list(lines), "block long, line_no long, line string")


def extremes_report(
    found: DataFrame, ident: str, metrics: Sequence[str], labels: dict[str, str] | None = None, k: int = 3
) -> DataFrame:
    """``block, line_no, line``: a block per metric with its ``k`` highest and lowest entities."""
    labels = labels or {}
    frame = []
    for i, m in enumerate(metrics, 1):
        frame += [(i, 1, METRIC_HEADER % labels.get(m, m)), (i, 2, HIGHEST % k), (i, k + 3, LOWEST % k),
                  (i, 2 * k + 4, BLOCK_RULE)]
    entries = found.select(
        _position(metrics).alias("block"),
        (F.col("rank") + F.when(F.col("side") == "high", 2).otherwise(k + 3)).cast("long").alias("line_no"),
        F.format_string(ENTRY, F.col(ident).cast("string"), fixed(F.col("value"))).alias("line"),
    )
    return _written(found.sparkSession, frame).unionByName(entries)


def leaders_report(
    leaders: DataFrame, group: str, metrics: Sequence[str], competition: str, labels: dict[str, str] | None = None
) -> DataFrame:
    """``block, line_no, line``: leader per metric, the best group, and the number of metrics led."""
    leaders = stage(leaders, "leaders")
    counts = lead_counts(leaders, group, metrics)
    best = best_group(counts, group)
    frame = _written(leaders.sparkSession, [
        (1, 1, LEADER_TITLE % competition), (1, 2, TITLE_RULE), (1, 3, ""), (1, 4, LEADER_PART),
        (3, 1, ""), (3, 2, BEST_PART), (5, 1, ""), (5, 2, COUNT_PART),
    ])
    name = F.col(group).cast("string")
    led = leaders.withColumn("ord", _position(metrics)).select(
        F.lit(2).cast("long").alias("block"), F.col("ord").alias("line_no"),
        F.format_string(LEADER_ENTRY, _label(metrics, labels), name, fixed(F.col("total"))).alias("line"),
    )
    top = best.select(
        F.lit(4).cast("long").alias("block"), F.lit(1).cast("long").alias("line_no"),
        F.format_string(BEST_ENTRY, name, F.col("n_metrics"), F.lit(competition)).alias("line"),
    )
    # A group leads at least one metric, so there are no more groups here than metrics.
    place = F.row_number().over(Window.orderBy(F.desc("n_metrics"), "first_seen"))
    listing = counts.select(
        F.lit(6).cast("long").alias("block"), place.cast("long").alias("line_no"),
        F.format_string(COUNT_ENTRY, name, F.col("n_metrics")).alias("line"),
    )
    return frame.unionByName(led).unionByName(top).unionByName(listing)


def clusters_report(
    sizes: DataFrame,
    means: DataFrame,
    members: DataFrame,
    standout: DataFrame,
    positions: DataFrame,
    explained: DataFrame,
    features: Sequence[str],
    k: int,
    labels: dict[str, str] | None = None,
    ident: str = "player",
    position: str = "position",
) -> DataFrame:
    """``block, line_no, line``: sizes, mean profile and example members per cluster, then their reading.

    ``sizes`` is (cluster, size), ``means`` (cluster, metric, mean), ``members`` (cluster, ident,
    position, rank), ``standout`` (cluster, standout), ``positions`` (cluster, main_positions) and
    ``explained`` a single row. All hold a few rows per cluster.
    """
    labels = labels or {}
    sizes, members = stage(sizes, "sizes"), stage(members, "members")
    spark = sizes.sparkSession
    long = "long"
    after = 2 + 2 * k
    frame = [(1, 1, CLUSTER_TITLE % k), (1, 2, ""), (1, 3, CLUSTER_K % k), (1, 4, ""), (1, 5, CLUSTER_SIZES),
             (1, 6, CLUSTER_HEAD), (1, 1000 + k, ""), (1, 1001 + k, CLUSTER_MEANS),
             (after, 0, ""), (after, 1, CLUSTER_REMARKS), (after, 2, CLUSTER_READING),
             (after + k + 1, 1, ""), (after + k + 1, 2, PCA_PART)]
    for c in range(k):
        frame += [(2 + 2 * c, 0, ""), (3 + 2 * c, 0, ""), (3 + 2 * c, 1, CLUSTER_EXAMPLES),
                  (after + 1 + c, 1, CLUSTER_NAME % c)]
    number, count = F.col("cluster"), F.col("size")
    width = Window.partitionBy()
    text = count.cast("string")
    shown_size = F.lpad(text, F.max(F.length(text)).over(width), " ")
    size_lines = sizes.select(
        F.lit(1).cast(long).alias("block"), (1000 + number).cast(long).alias("line_no"),
        F.concat(number.cast("string"), F.lit("    "), shown_size).alias("line"),
    )
    headings = sizes.select(
        (2 + 2 * number).cast(long).alias("block"), F.lit(1).cast(long).alias("line_no"),
        F.format_string(CLUSTER_BLOCK, number, count).alias("line"),
    )
    one = Window.partitionBy("cluster")
    mean_text = F.format_string("%.6f", F.col("mean"))
    shown = F.when(F.col("mean").isNull(), F.lit("NaN")).otherwise(mean_text)
    label_width = max(len(labels.get(m, m)) for m in features)
    mean_lines = means.withColumn("ord", _position(features)).withColumn("shown", shown).select(
        (2 + 2 * number).cast(long).alias("block"), (F.col("ord") + 1).cast(long).alias("line_no"),
        F.concat(F.rpad(_label(features, labels), label_width + 4, " "), _aligned("shown", one)).alias("line"),
    )
    heads = members.select("cluster").distinct().select(
        "cluster", F.lit(ident.capitalize()).alias(ident), F.lit(position.capitalize()).alias(position),
        F.lit(0).alias("rank"),
    )
    table = heads.unionByName(members.select("cluster", ident, position, "rank"))
    member_lines = table.select(
        (3 + 2 * number).cast(long).alias("block"), (F.col("rank") + 2).cast(long).alias("line_no"),
        F.concat(_aligned(ident, one), F.lit(" "), _aligned(position, one)).alias("line"),
    )
    reading = [
        sizes.select("cluster").join(lists, "cluster", "left").select(
            (after + 1 + number).cast(long).alias("block"), F.lit(no).cast(long).alias("line_no"),
            F.format_string(form, F.coalesce(F.col(column), F.lit(""))).alias("line"),
        )
        for lists, no, form, column in [
            (standout, 2, CLUSTER_STANDOUT, "standout"), (positions, 3, CLUSTER_POSITIONS, "main_positions")]
    ]
    share = explained.select(
        F.lit(after + k + 1).cast(long).alias("block"), F.lit(3).cast(long).alias("line_no"),
        F.format_string(PCA_SHARE, fixed(F.col("explained") * 100)).alias("line"),
    )
    lines = _written(spark, frame)
    for part in [size_lines, headings, mean_lines, member_lines, *reading, share]:
        lines = lines.unionByName(part)
    return lines
