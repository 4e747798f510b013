"""The metric catalogue: names, order and the role each metric plays."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 72 metric labels in report order.
LABELS = [
    "Age", "Matches Played", "Starts", "Minutes", "Gls", "Ast", "crdY", "crdR", "xG", "xAG",
    "PrgC", "PrgP", "PrgR", "Gls per 90", "Ast per 90", "xG per 90", "xAG per 90", "GA90",
    "Save%", "CS%", "PK Save%", "SoT%", "SoT per 90", "G per Sh", "Dist", "Cmp", "Cmp%",
    "TotDist", "ShortCmp%", "MedCmp%", "LongCmp%", "KP", "Pass into 1_3", "PPA", "CrsPA",
    "SCA", "SCA90", "GCA", "GCA90", "Tkl", "TklW", "Deff Att", "Lost", "Blocks", "Sh", "Pass",
    "Int", "Touches", "Def Pen", "Def 3rd", "Mid 3rd", "Att 3rd", "Att Pen", "Take-Ons Att",
    "Succ%", "Tkld%", "Carries", "ProDist", "Carries 1_3", "CPA", "Mis", "Dis", "Rec",
    "Rec PrgR", "Fls", "Fld", "Off", "Crs", "Recov", "Aerl Won", "Aerl Lost", "Aerl Won%",
]

# The 56 metrics where more is better, in the order the leader report prints them.
POSITIVE = [
    "Gls", "Ast", "xG", "xAG", "PrgC", "PrgP", "PrgR", "Gls per 90", "Ast per 90", "xG per 90",
    "xAG per 90", "SCA", "SCA90", "GCA", "GCA90", "SoT%", "SoT per 90", "G per Sh", "Cmp",
    "Cmp%", "TotDist", "ShortCmp%", "MedCmp%", "LongCmp%", "KP", "Pass into 1_3", "PPA",
    "CrsPA", "Tkl", "TklW", "Blocks", "Int", "Recov", "Aerl Won", "Aerl Won%", "Touches",
    "Def Pen", "Def 3rd", "Mid 3rd", "Att 3rd", "Att Pen", "Take-Ons Att", "Succ%", "Carries",
    "ProDist", "Carries 1_3", "CPA", "Rec", "Rec PrgR", "Sh", "Pass", "Fld", "Crs", "Save%",
    "CS%", "PK Save%",
]

# Metrics only goalkeepers have, and metrics of playing volume left out of clustering.
KEEPER_ONLY = ["GA90", "Save%", "CS%", "PK Save%"]
VOLUME = ["Matches Played", "Starts", "Minutes"]


def sanitise(header: str) -> str:
    """A raw header as a label: ``Gls/90`` is ``Gls per 90``, a fraction like ``1/3`` is ``1_3``."""
    if re.search(r"\d/\d", header):
        return header.replace("/", "_")
    return header.replace("/", " per ")


def column_name(label: str) -> str:
    """The snake_case column for a label: ``PK Save%`` is ``pk_save_pct``."""
    return re.sub(r"[^0-9a-z]+", "_", label.lower().replace("%", " pct")).strip("_")


METRICS = [column_name(x) for x in LABELS]
POSITIVE_METRICS = [column_name(x) for x in POSITIVE]
CLUSTER_FEATURES = [column_name(x) for x in LABELS if x not in VOLUME]
LABEL_OF = dict(zip(METRICS, LABELS))

IDENTITY = ["player", "team", "nation", "position"]

PLAYER_STATS = T.StructType(
    [T.StructField(c, T.StringType()) for c in IDENTITY]
    + [T.StructField(m, T.DoubleType()) for m in METRICS]
)

TRANSFERS = T.StructType([
    T.StructField("Player", T.StringType()),
    T.StructField("Team", T.StringType()),
    T.StructField("Minutes", T.IntegerType()),
    T.StructField("Transfer Fee", T.StringType()),
    T.StructField("Transfer Type", T.StringType()),
])

VALUE_ESTIMATES = T.StructType([
    T.StructField("Player", T.StringType()),
    T.StructField("Team", T.StringType()),
    T.StructField("Nation", T.StringType()),
    T.StructField("Position", T.StringType()),
    T.StructField("Actual_Transfer_Value_M", T.DoubleType()),
    T.StructField("Predicted_Transfer_Value_M", T.DoubleType()),
])


def rename_headers(df: DataFrame) -> DataFrame:
    """Raw source headers to snake_case columns."""
    return df.withColumnsRenamed({c: column_name(sanitise(c)) for c in df.columns})


def metric_catalog(spark: SparkSession) -> DataFrame:
    """One row per metric: ``ord, metric, label, is_gk_only, is_positive, positive_ord, is_cluster_feature``."""
    place = {label: i for i, label in enumerate(POSITIVE, 1)}
    rows = [
        (i, column_name(x), x, x in KEEPER_ONLY, x in place, place.get(x), x not in VOLUME)
        for i, x in enumerate(LABELS, 1)
    ]
    return spark.createDataFrame(
        rows,
        "ord int, metric string, label string, is_gk_only boolean, is_positive boolean, "
        "positive_ord int, is_cluster_feature boolean",
    )
