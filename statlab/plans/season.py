"""The analyses of one season of player statistics, from the base tables to the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab.catalog import CLUSTER_FEATURES, LABEL_OF, METRICS, POSITIVE_METRICS, rename_headers
from statlab.functions.clean import age_years, fee_kind, fee_millions, fixed, primary_token, route
from statlab.operators import cluster, profile
from statlab.operators.impute import median_impute
from statlab.operators.joins import approx_name_join, contradicting, resolve_alias
from statlab.operators.leaders import metric_leaders
from statlab.operators.rank import extremes, first_per_group
from statlab.operators.regress import estimate_by_category
from statlab.operators.stats import PREFIX, STATS, group_stats_wide
from statlab.plans import reports
from statlab.session import stage


def prepare_players(raw: DataFrame, min_minutes: float = 90) -> DataFrame:
    """Snake-case columns, age in years, and only players with more than ``min_minutes``.

    Written once, so that every analysis reads the columns it needs and not the source text again.
    """
    players = rename_headers(raw)
    if isinstance(players.schema["age"].dataType, T.StringType):
        players = players.withColumn("age", age_years(F.col("age")))
    return stage(players.where(F.col("minutes") > min_minutes), "players")


def team_statistics(players: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The group table as printed: ``Group`` and three columns per metric, the total first."""
    wide = group_stats_wide(players, "team", metrics, LABEL_OF)
    names = [f"{PREFIX[s]} of {LABEL_OF[m]}" for m in metrics for s in STATS]
    return wide.orderBy(F.desc("is_total"), "group").select(
        F.col("group").alias("Group"), *[fixed(F.col(f"`{n}`")).alias(n) for n in names]
    )


def team_leaders(players: DataFrame, how: str = "sum") -> DataFrame:
    return metric_leaders(players, "team", POSITIVE_METRICS, how)


def team_leaders_report(players: DataFrame, competition: str) -> DataFrame:
    return reports.leaders_report(team_leaders(players), "team", POSITIVE_METRICS, competition, LABEL_OF)


def metric_extremes(players: DataFrame) -> DataFrame:
    return extremes(players, "player", METRICS)


def metric_extremes_report(players: DataFrame) -> DataFrame:
    return reports.extremes_report(metric_extremes(players), "player", METRICS, LABEL_OF)


#: What tells the rows of players apart; a player who changed teams has two.
IDENT = ("player", "team")


def cluster_players(players: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """Imputed players in original units with ``cluster``, ``pc1``, ``pc2``, written once for all reports."""
    vectors = cluster.imputed_features(players, CLUSTER_FEATURES)
    return stage(cluster.project(cluster.kmeans_labels(vectors, k, seed, ident=IDENT)).drop("features"), "clustered")


def cluster_elbow(players: DataFrame, ks: Sequence[int] = tuple(range(1, 11)), seed: int = 42) -> DataFrame:
    return cluster.elbow(cluster.imputed_features(players, CLUSTER_FEATURES), ks, seed, ident=IDENT)


def clusters_report(labelled: DataFrame, k: int = 4) -> DataFrame:
    means = stage(profile.profile(labelled, "cluster", CLUSTER_FEATURES), "cluster-means")
    high = profile.standouts(means, "cluster")
    named = high.withColumn("ord", F.array_position(F.array(*[F.lit(m) for m in CLUSTER_FEATURES]), F.col("metric")))
    label = F.get(F.array(*[F.lit(LABEL_OF[m]) for m in CLUSTER_FEATURES]), (F.col("ord") - 1).cast("int"))
    top = profile.top_categories(labelled, "cluster", "position")
    return reports.clusters_report(
        profile.sizes(labelled, "cluster"),
        means,
        profile.examples(labelled, "cluster", "player", ["position"]),
        profile.listed(named.withColumn("label", label), "cluster", "label", "ord", "standout"),
        profile.listed(top, "cluster", "position", "rank", "main_positions"),
        labelled.select("explained").limit(1),
        CLUSTER_FEATURES,
        k,
        LABEL_OF,
    )


def player_transfers(
    players: DataFrame,
    transfers: DataFrame,
    aliases: dict[str, str] | DataFrame,
    min_minutes: float = 900,
    max_distance: int = 3,
) -> DataFrame:
    """Transfers with parsed fee and route, kept for players above ``min_minutes`` of a similar name.

    A player with two transfers has two rows, and a transfer has one: of several players of one name it
    goes to the one in its destination, else to the first team by name. ``contradicts`` marks a transfer
    whose destination is not the team of the player it was matched to. A transfer need not agree with the
    team, since contradictions are what is looked for.
    """
    regulars = players.where(F.col("minutes") > min_minutes).select(
        F.col("player").alias("known_player"), F.col("team").alias("known_team"),
        F.col("minutes").alias("known_minutes"),
    )
    parsed = transfers.select(
        F.col("Player").alias("player"),
        F.col("Transfer Fee").alias("fee"), F.col("Transfer Type").alias("transfer"),
        fee_millions(F.col("Transfer Fee")).alias("fee_m"),
        fee_kind(F.col("Transfer Fee")).alias("fee_kind"),
        route(F.col("Transfer Type")).alias("r"),
    ).select("player", "fee", "transfer", "fee_m", "fee_kind", "r.from_club", "r.to_club")
    numbered = stage(resolve_alias(parsed, "to_club", aliases, "to_team").withColumn("_row", F.monotonically_increasing_id()), "transfers")
    matched = approx_name_join(numbered, regulars, "player", "known_player", "known_player", None, max_distance)
    namesakes = matched.withColumnRenamed("player", "source_name").join(regulars, F.col("match_id") == F.col("known_player"))
    stays = F.coalesce(F.col("known_team") == F.col("to_team"), F.lit(False))
    chosen = first_per_group(namesakes, ["_row"], [F.desc(stays), F.asc("known_team"), F.desc("known_minutes")], 1)
    return chosen.select(
        F.col("known_player").alias("player"), F.col("known_team").alias("team"),
        F.col("known_minutes").alias("minutes"), "fee", "transfer",
        "fee_m", "fee_kind", "from_club", "to_club", "to_team",
        "source_name", "distance", (F.col("to_team") != F.col("known_team")).alias("contradicts"),
    )


def transfer_table(found: DataFrame) -> DataFrame:
    """The transfers as printed: the player's name, team and minutes with the fee and route as text."""
    return found.select(
        F.col("player").alias("Player"), F.col("team").alias("Team"), F.col("minutes").cast("int").alias("Minutes"),
        F.col("fee").alias("Transfer Fee"), F.col("transfer").alias("Transfer Type"),
    )


def contradicting_transfers(transfers: DataFrame) -> DataFrame:
    return contradicting(transfers, "to_team", "team")


def value_estimates(
    players: DataFrame,
    values: DataFrame,
    loose: bool = False,
    max_distance: int = 3,
    features: Sequence[str] = METRICS,
    floor: float = 0.1,
    regressor=None,
) -> DataFrame:
    """Actual and estimated market value per player, highest estimate first.

    ``values`` has ``player, team, value_m``. Names may differ by ``max_distance`` edits, but the
    team has to agree unless ``loose``, which also takes namesakes of other teams. Players without
    a value are left out. One model per primary position.
    """
    complete = median_impute(players, features).withColumns({
        m: F.coalesce(F.col(m), F.lit(0.0)) for m in features
    })
    listed = values.select(F.col("player").alias("listed_player"), F.col("team").alias("listed_team"), "value_m")
    matched = approx_name_join(
        complete, listed.withColumn("hit", F.struct("listed_player", "value_m")),
        "player", "listed_player", "hit", None if loose else ("team", "listed_team"), max_distance,
    )
    known = matched.withColumn("actual", F.col("match_id.value_m")).withColumn(
        "position", primary_token(F.col("position"))
    )
    estimated = estimate_by_category(
        known.select("player", "team", "nation", "position", "actual", *features),
        "position", features, "actual", "player", floor=floor, regressor=regressor,
    )
    return estimated.orderBy(F.desc("predicted"), "player").select(
        F.col("player").alias("Player"), F.col("team").alias("Team"), F.col("nation").alias("Nation"),
        F.col("position").alias("Position"), F.col("actual").alias("Actual_Transfer_Value_M"),
        F.col("predicted").alias("Predicted_Transfer_Value_M"),
    )
