"""The operators on the star-schema tables, one query each; ``table_sql`` holds the same in SQL."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab import catalog
from statlab.functions import clean
from statlab.operators import cluster, impute, joins, leaders, profile, rank, regress, reshape, stats
from statlab.plans import reports
from statlab.session import new_path, stage
from statlab.sources import files

LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_METRICS = ["p_size", "p_retailprice"]
LABEL_METRICS = ["quality", "toxic", "n_chars"]
CUSTOMER_METRICS = ["c_acctbal", "c_custkey", "c_nationkey"]
DIMENSIONS = [f"d{i}" for i in range(64)]
SHORT_NATIONS = {f"N{i}": f"NATION_{i}" for i in range(12)}
COMPETITION = "line items"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return files.read_table(spark, f"{sf}/{name}.parquet")


def rounded(df: DataFrame, decimals: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), decimals) for c in columns})


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


# --- group statistics


def group_stats_with_total(spark: SparkSession, sf: str) -> DataFrame:
    wide = stats.group_stats_wide(table(spark, sf, "lineitem"), "l_returnflag", LINE_METRICS).drop("is_total")
    return rounded(wide, 4, *[c for c in wide.columns if c != "group"])


def group_stats_long(spark: SparkSession, sf: str) -> DataFrame:
    long = stats.group_stats_long(table(spark, sf, "lineitem"), "l_suppkey", LINE_METRICS)
    return rounded(long, 4, "median", "mean", "std")


def group_stats_single_row(spark: SparkSession, sf: str) -> DataFrame:
    long = stats.group_stats_long(table(spark, sf, "supplier"), "s_nationkey", ["s_acctbal"])
    return long.select("group", "n", *[clean.fixed(F.col(c), 5).alias(c) for c in ("median", "mean", "std")])


def null_safe_stats(spark: SparkSession, sf: str) -> DataFrame:
    known = stage(labelled_documents(spark, sf), "labelled")
    long = stats.group_stats_long(known, "lang", LABEL_METRICS).drop("is_total")
    return rounded(long, 6, "median", "mean", "std")


def null_group_stats(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").withColumn("nation", F.nullif("s_nationkey", F.lit(7)))
    long = stats.group_stats_long(suppliers, "nation", ["s_acctbal"])
    return rounded(long, 5, "median", "mean", "std")


def stats_of_events(spark: SparkSession, sf: str) -> DataFrame:
    long = stats.group_stats_long(table(spark, sf, "events"), "user_id", ["value"])
    return rounded(long, 5, "median", "mean", "std")


def wide_group_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The shape of a season: 64 metrics with three statistics each."""
    wide = stats.group_stats_wide(stage(_dimensions(spark, sf), "dimensions"), "label", DIMENSIONS).drop("is_total")
    return rounded(wide, 6, *[c for c in wide.columns if c != "group"])


# --- ranking


def top3_per_metric(spark: SparkSession, sf: str) -> DataFrame:
    return rank.extremes(table(spark, sf, "part"), "p_partkey", PART_METRICS, ["high"])


def bottom3_per_metric(spark: SparkSession, sf: str) -> DataFrame:
    return rank.extremes(table(spark, sf, "part"), "p_partkey", PART_METRICS, ["low"])


def extremes_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    line = F.format_string("%d/%d/%.2f", "l_orderkey", "l_linenumber", "l_extendedprice")
    keyed = table(spark, sf, "lineitem").withColumn("line", line)
    return rank.extremes(keyed, "line", LINE_METRICS)


def wide_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return rank.extremes(stage(_dimensions(spark, sf), "dimensions"), "vec_id", DIMENSIONS)


def first5_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return profile.examples(table(spark, sf, "supplier"), "s_nationkey", "s_name", ["s_acctbal"])


# --- leaders


def _line_leaders(spark: SparkSession, sf: str, how: str) -> DataFrame:
    return leaders.metric_leaders(table(spark, sf, "lineitem"), "l_suppkey", LINE_METRICS, how)


def leader_per_metric_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_line_leaders(spark, sf, "sum"), 2, "total")


def leader_per_metric_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_line_leaders(spark, sf, "mean"), 6, "total")


def wide_leaders(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(leaders.metric_leaders(_dimensions(spark, sf), "label", DIMENSIONS), 5, "total")


def leader_counts(spark: SparkSession, sf: str) -> DataFrame:
    return leaders.lead_counts(_line_leaders(spark, sf, "sum"), "l_suppkey", LINE_METRICS)


def best_group(spark: SparkSession, sf: str) -> DataFrame:
    return leaders.best_group(leader_counts(spark, sf), "l_suppkey")


# --- filters and scalar functions


def threshold_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


def threshold_filter_strict(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where(F.col("l_quantity") > 45).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


def money_parse(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    fee = (
        F.when(key % 10 == 0, F.lit("Free")).when(key % 17 == 0, F.lit("?"))
        .otherwise(F.concat(F.lit("€"), F.col("p_retailprice").cast("string"), F.lit("M")))
    )
    return table(spark, sf, "part").select("p_partkey", fee.alias("fee")).select(
        "p_partkey", clean.fee_millions(F.col("fee")).alias("fee_m"), clean.fee_kind(F.col("fee")).alias("fee_kind")
    )


def route_split(spark: SparkSession, sf: str) -> DataFrame:
    text = F.translate("p_name", " ", "\n")
    return table(spark, sf, "part").select("p_partkey", clean.route(text).alias("r")).select("p_partkey", "r.*")


def first_token(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", clean.primary_token(F.translate("p_name", " ", ",")).alias("first_name")
    )


def age_decimal(spark: SparkSession, sf: str) -> DataFrame:
    age = F.concat_ws("-", F.col("p_size").cast("string"), F.lpad((F.col("p_partkey") % 365).cast("string"), 3, "0"))
    return table(spark, sf, "part").select("p_partkey", clean.age_years(age).alias("age"))


def header_rename(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("Qty/90"), F.col("l_tax").alias("Tax%"),
        F.col("l_discount").alias("Discount into 1/3"),
    )
    return catalog.rename_headers(raw)


def fixed_format(spark: SparkSession, sf: str) -> DataFrame:
    third = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice") / 3)
    return table(spark, sf, "orders").select("o_orderkey", clean.fixed(third).alias("shown"))


def clamp_floor(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.clamp_floor(F.col("c_acctbal")).alias("clamped")
    )


def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    known = stage(labelled_documents(spark, sf), "labelled").withColumn(
        "n_chars", F.when(F.col("doc_id") % 5 != 0, F.col("n_chars"))
    )
    return impute.median_impute(known, LABEL_METRICS).select("doc_id", *LABEL_METRICS)


def standardize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = impute.standardize(table(spark, sf, "customer"), ["c_acctbal"]).select("c_custkey", "c_acctbal_z")
    return rounded(scaled, 6, "c_acctbal_z")


def accent_fold(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(clean.fold_name(F.col("text"))).alias("folded"))


def edit_distance(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.levenshtein("p_name", F.lower("p_type")).alias("distance"))


# --- joins


def _misspelt(name: Column) -> Column:
    """One letter lost, and now and then one exchanged for an accented one."""
    lost = F.concat(name.substr(1, 2), F.substr(name, F.lit(4)))
    return F.when(F.col("p_partkey") % 3 == 0, F.upper(name)).when(
        F.col("p_partkey") % 3 == 1, lost
    ).otherwise(F.translate(lost, "e", "é"))


def approx_name_join(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    left = part.select("p_partkey", "p_brand", _misspelt(F.col("p_name")).alias("name"))
    right = part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), "p_name")
    return joins.approx_name_join(left, right, "name", "p_name", "id", ("p_brand", "brand"), 2, "left").select(
        "p_partkey", "name", "match_name", "match_id", "distance"
    )


def approx_name_join_loose(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    left = part.select("p_partkey", F.translate("p_name", "aiou", "").alias("name"))
    right = part.select(F.col("p_partkey").alias("id"), "p_name")
    return joins.approx_name_join(left, right, "name", "p_name", "id", None, 3, "left").select(
        "p_partkey", "name", "match_name", "match_id", "distance"
    )


def _full_name() -> Column:
    return F.concat_ws(" ", "p_name", F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 8))


def approx_name_join_many(spark: SparkSession, sf: str) -> DataFrame:
    """A name of its own for every part, a letter lost in it."""
    part = table(spark, sf, "part")
    name = _full_name()
    left = part.select("p_partkey", "p_brand", F.concat(name.substr(1, 4), F.substr(name, F.lit(6))).alias("name"))
    right = part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), name.alias("full_name"))
    return joins.approx_name_join(left, right, "name", "full_name", "id", ("p_brand", "brand"), 2, "left").select(
        "p_partkey", "name", "match_name", "match_id", "distance"
    )


def approx_name_join_words(spark: SparkSession, sf: str) -> DataFrame:
    """A longer official name against a shorter one; every third name has the words in another order."""
    part = table(spark, sf, "part")
    code = F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 8)
    short = F.when(F.col("p_partkey") % 3 == 0, F.concat_ws(" ", code, "p_name")).otherwise(F.concat_ws(" ", "p_name", code))
    left = part.select("p_partkey", short.alias("name"))
    right = part.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", F.lower("p_type"), "p_name", F.lower("p_brand"), code).alias("full_name"))
    return joins.approx_name_join(left, right, "name", "full_name", "id", None, 1, "left", shared_words=True).select(
        "p_partkey", "name", "match_name", "match_id", "distance"
    )


def inner_match(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return joins.inner_match(orders, customers, ["c_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


def one_to_many(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate"
    )
    return joins.one_to_many(customers, orders, "c_custkey", ["o_orderdate", "o_orderkey"]).select(
        "c_custkey", "c_name", "o_orderkey", "is_latest"
    )


def _nation_name(key: str) -> Column:
    return F.concat(F.when(F.col(key) < 18, F.lit("N")).otherwise(F.lit("NATION_")), F.col(key).cast("string"))


def alias_lookup(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "customer").select("c_custkey", _nation_name("c_nationkey").alias("short"))
    return joins.resolve_alias(named, "short", SHORT_NATIONS, "nation")


def dest_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    claimed = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 25).alias("claimed_key")
    ).withColumn("r", clean.route(F.concat(F.lit("N0\n"), _nation_name("claimed_key"))))
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("team"))
    named = joins.resolve_alias(claimed.withColumn("to_club", F.col("r.to_club")), "to_club", SHORT_NATIONS, "to_team")
    return joins.contradicting(joins.inner_match(named, customers, ["c_custkey"]), "to_team", "team").select(
        "o_orderkey", "team", "to_team"
    )


def metric_difference(spark: SparkSession, sf: str) -> DataFrame:
    buyers = table(spark, sf, "orders").where(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return reshape.missing_from(table(spark, sf, "customer").select("c_custkey", "c_name"), buyers, "c_custkey")


# --- reshaping


def unpivot_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.to_long(labelled_documents(spark, sf), ["doc_id"], LABEL_METRICS, keep_nulls=True)


def pivot_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The known types have columns of their own; whatever else there is, is counted in the last."""
    known = ["click", "error", "purchase", "signup", "view"]
    kind = F.when(F.col("event_type").isin(known), F.col("event_type")).otherwise("other").alias("kind")
    counted = table(spark, sf, "events").groupBy("user_id", kind).agg(F.count("*").alias("n"))
    return reshape.to_wide(counted, ["user_id"], "kind", "n", [*known, "other"])


def total_with_groups(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    size = F.count("*").alias("n")
    groups = customers.groupBy("c_mktsegment").agg(size)
    total = groups.agg(F.sum("n").alias("n")).withColumn("c_mktsegment", F.lit(None).cast("string"))
    return reshape.union_total(groups, total.select("c_mktsegment", "n"), "c_mktsegment")


def distinct_groups(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.distinct_values(table(spark, sf, "documents"), "lang", "source")


# --- profiles


def category_top2(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_categories(table(spark, sf, "events"), "user_id", "event_type")


def category_list(spark: SparkSession, sf: str) -> DataFrame:
    return profile.listed(category_top2(spark, sf), "user_id", "event_type", "rank", "main_types")


def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return profile.sizes(table(spark, sf, "embeddings"), "label")


def _dimensions(spark: SparkSession, sf: str) -> DataFrame:
    values = F.col("embedding")
    return table(spark, sf, "embeddings").select("vec_id", "label", *[values[i].alias(d) for i, d in enumerate(DIMENSIONS)])


def cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Means of an array column: one vector per group is aggregated, not 64 columns."""
    means = cluster.group_centroids(table(spark, sf, "embeddings"), "label", "embedding")
    long = means.select("label", F.posexplode("centroid").alias("d", "mean"))
    return rounded(long.select("label", F.concat(F.lit("d"), F.col("d")).alias("metric"), "mean"), 6, "mean")


def _flag_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile(table(spark, sf, "lineitem"), "l_returnflag", [*LINE_METRICS, "l_linenumber"])


def standout_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.standouts(_flag_profile(spark, sf), "l_returnflag"), 4, "mean")


def standout_features_scaled(spark: SparkSession, sf: str) -> DataFrame:
    means = profile.profile(_dimensions(spark, sf), "label", DIMENSIONS)
    return rounded(profile.standouts(means, "label", 1.5, scaled=True), 6, "mean")


# --- clustering and projection


def nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    centres = cluster.group_centroids(vectors, "label", "embedding")
    near = cluster.nearest_centroid(vectors, "embedding", centres, "label").select("vec_id", "nearest", "distance")
    return rounded(near, 6, "distance")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.scaled_features(table(spark, sf, "embeddings"), "embedding")


def kmeans_k4(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.kmeans_labels(_vectors(spark, sf), 4, ident="vec_id").select("vec_id", "cluster")


def elbow(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.elbow(_vectors(spark, sf), range(1, 7), ident="vec_id")


def _far_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in four groups far apart, as vectors."""
    group = (F.col("c_nationkey") % 4 * 1000).cast("double")
    vector = F.array(group, F.col("c_acctbal") / 100)
    return table(spark, sf, "customer").withColumn("features", array_to_vector(vector))


def kmeans_separated(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.kmeans_labels(_far_groups(spark, sf), 4, ident="c_custkey").select("c_custkey", "cluster")


def elbow_separated(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cluster.elbow(_far_groups(spark, sf), [1, 4], ident="c_custkey"), 0, "inertia", "drop")


def pca_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Two standardised columns, the second at half its weight, so that the components have a closed form."""
    scaled = impute.standardize(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    pair = scaled.withColumn("features", array_to_vector(F.array(F.col("c_acctbal_z"), F.col("c_nationkey_z") / 2)))
    share = cluster.project(pair, 1).select("c_custkey", "explained")
    found = cluster.project(pair, 2).select("c_custkey", "pc1", "pc2").join(share, "c_custkey")
    return rounded(found, 5, "pc1", "pc2", "explained")


def pca_2d(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.project(_vectors(spark, sf)).select("vec_id", "pc1", "pc2", "explained")


# --- regression


def regr_by_group(spark: SparkSession, sf: str) -> DataFrame:
    lines = regress.line_by_group(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity")
    return rounded(rounded(lines, 4, "slope", "intercept"), 8, "r2")


def regression_quality(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    lines = stage(regress.line_by_group(items, ["l_returnflag"], "l_extendedprice", "l_quantity"), "lines")
    fitted = items.join(lines, "l_returnflag").withColumn(
        "predicted", F.col("intercept") + F.col("slope") * F.col("l_quantity")
    )
    good = regress.quality(fitted, ["l_linestatus"], "l_extendedprice", "predicted")
    return rounded(rounded(good, 4, "mae", "rmse"), 8, "r2")


def residuals(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    lines = stage(regress.line_by_group(items, ["l_returnflag"], "l_extendedprice", "l_quantity"), "lines")
    fitted = items.join(lines, "l_returnflag").withColumn(
        "predicted", F.col("intercept") + F.col("slope") * F.col("l_quantity")
    )
    return fitted.select(
        "l_orderkey", "l_linenumber", F.round(regress.residual("predicted", "l_extendedprice"), 4).alias("residual")
    )


def value_line_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a category, with an empty one, and a category each for a tenth of the parts."""
    key = F.col("p_partkey")
    kind = F.when(key % 10 == 1, F.lit("")).when(key % 10 == 2, F.lit(None)).when(
        key % 10 == 3, F.concat(F.lit("only "), key.cast("string"))).otherwise(F.col("p_type"))
    part = table(spark, sf, "part").select("p_partkey", kind.alias("kind"), (F.col("p_retailprice") - 930).alias("actual"), "p_size")
    return regress.estimate_by_category(part, "kind", ["p_size"], "actual", "p_partkey")


def value_two_features(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(
        "p_partkey", "p_type", F.col("p_retailprice").alias("actual"), "p_size", (F.col("p_partkey") % 101).alias("turn"))
    return regress.estimate_by_category(part, "p_type", ["p_size", "turn"], "actual", "p_partkey").select("p_partkey", "predicted", "is_train")


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", regress.in_training(F.col("c_name")).alias("is_train")
    )


def value_line(spark: SparkSession, sf: str) -> DataFrame:
    """One feature, so that SQL can fit the same models on the same training rows."""
    part = table(spark, sf, "part").select("p_partkey", "p_type", (F.col("p_retailprice") - 930).alias("actual"), "p_size")
    return regress.estimate_by_category(part, "p_type", ["p_size"], "actual", "p_partkey")


def value_model(spark: SparkSession, sf: str) -> DataFrame:
    sold = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count("*").cast("double").alias("sales"), F.avg("l_quantity").alias("quantity"),
        F.avg("l_extendedprice").alias("price"),
    )
    part = table(spark, sf, "part").select("p_partkey", "p_type", F.col("p_retailprice").alias("actual"), "p_size")
    estimated = regress.estimate_by_category(
        part.join(sold, "p_partkey"), "p_type", ["p_size", "sales", "quantity", "price"], "actual", "p_partkey"
    )
    return estimated.orderBy(F.desc("predicted"), "p_partkey").select(
        "p_partkey", "p_type", "actual", "predicted", "is_train",
        F.round(regress.residual("predicted", "actual"), 2).alias("residual"),
    )


# --- reports and files


def extremes_report(spark: SparkSession, sf: str) -> DataFrame:
    found = rank.extremes(table(spark, sf, "part"), "p_partkey", PART_METRICS)
    return reports.extremes_report(found, "p_partkey", PART_METRICS)


def leaders_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.leaders_report(_line_leaders(spark, sf, "sum"), "l_suppkey", LINE_METRICS, COMPETITION)


def _customer_report(customers: DataFrame) -> DataFrame:
    means = stage(profile.profile(customers, "cluster", CUSTOMER_METRICS), "means")
    order = F.array_position(F.array(*[F.lit(m) for m in CUSTOMER_METRICS]), F.col("metric"))
    high = profile.standouts(means, "cluster").withColumn("ord", order)
    segments = profile.top_categories(customers, "cluster", "c_mktsegment")
    return reports.clusters_report(
        profile.sizes(customers, "cluster"), means,
        profile.examples(customers, "cluster", "c_name", ["c_mktsegment"]),
        profile.listed(high, "cluster", "metric", "ord", "standout"),
        profile.listed(segments, "cluster", "c_mktsegment", "rank", "main_positions"),
        customers.agg(F.avg(F.when(F.col("c_acctbal") > 0, 1.0).otherwise(0.0)).alias("explained")),
        CUSTOMER_METRICS, 4, None, "c_name", "c_mktsegment",
    )


def cluster_report(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_report(table(spark, sf, "customer").withColumn("cluster", F.col("c_nationkey") % 4))


def cluster_report_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """The report of clusters that were fitted."""
    fitted = cluster.kmeans_labels(_far_groups(spark, sf), 4, ident="c_custkey").drop("features")
    return _customer_report(stage(fitted, "fitted"))


def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType()),
    ])
    return files.read_table(spark, f"{sf}/supplier.parquet", schema).select("s_acctbal", "s_name", "s_suppkey")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    path = new_path(spark, "customers-csv")
    files.write_csv(known, path)
    return files.read_csv(spark, path, known.schema)


def csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Columns in another order, and one that is not asked for."""
    known = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = new_path(spark, "customers-csv")
    files.write_csv(known, path, ["c_acctbal", "c_mktsegment", "c_custkey", "c_name"])
    return files.read_csv(spark, path, known.select("c_custkey", "c_name", "c_acctbal").schema)


def csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    routes = table(spark, sf, "part").select("p_partkey", F.translate("p_name", " ", "\n").alias("route"))
    path = new_path(spark, "routes-csv")
    files.write_csv(routes, path)
    read = files.read_csv(spark, path, routes.schema, multiline=True)
    return read.select("p_partkey", clean.route(F.col("route")).alias("r")).select("p_partkey", "r.*")


def csv_sorted(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = new_path(spark, "sorted-csv")
    files.write_sorted_csv(known, path, [F.desc("c_acctbal"), "c_custkey"])
    return files.read_csv(spark, path, known.schema)


def report_text(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "report-text")
    files.write_lines(extremes_report(spark, sf), path, ["block", "line_no"])
    return spark.read.text(path).withColumnRenamed("value", "line")


QUERIES = {
    f.__name__: f
    for f in [
        group_stats_with_total, group_stats_long, group_stats_single_row, null_safe_stats, null_group_stats,
        stats_of_events, top3_per_metric, bottom3_per_metric, extremes_of_lines, first5_per_group, leader_per_metric_sum,
        leader_per_metric_mean, leader_counts, best_group, threshold_filter, threshold_filter_strict, money_parse,
        route_split, first_token, age_decimal, header_rename, fixed_format, clamp_floor, median_impute, standardize,
        accent_fold, edit_distance, approx_name_join, approx_name_join_loose, inner_match, one_to_many, alias_lookup,
        dest_mismatch, metric_difference, unpivot_metrics, pivot_stats, total_with_groups, distinct_groups,
        category_top2, category_list, cluster_sizes, cluster_profile, standout_features, standout_features_scaled,
        nearest_centroid, kmeans_k4, elbow, pca_2d, regr_by_group, regression_quality, residuals, train_test_split,
        value_line, value_model, cluster_report, value_line_sparse, value_two_features, kmeans_separated,
        elbow_separated, pca_pair, wide_group_stats, wide_extremes, wide_leaders, approx_name_join_many,
        approx_name_join_words, csv_by_name, cluster_report_fitted,
        extremes_report, leaders_report, table_scan, csv_roundtrip, csv_multiline, csv_sorted, report_text,
    ]
}
