import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab import catalog, session
from statlab.functions import clean
from statlab.sources import files


def column(spark, values, make):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r[0] for r in frame.orderBy("i").select(make(F.col("s"))).collect()]


def test_catalogue():
    assert len(catalog.METRICS) == len(set(catalog.METRICS)) == 72
    assert len(catalog.POSITIVE_METRICS) == 56 and set(catalog.POSITIVE_METRICS) < set(catalog.METRICS)
    assert len(catalog.CLUSTER_FEATURES) == 69
    assert catalog.sanitise("Gls/90") == "Gls per 90" and catalog.sanitise("Carries 1/3") == "Carries 1_3"
    assert catalog.column_name("PK Save%") == "pk_save_pct" and catalog.column_name("Take-Ons Att") == "take_ons_att"


def test_catalogue_table_and_difference(spark):
    table = catalog.metric_catalog(spark)
    assert table.count() == 72 and table.where("is_gk_only").count() == 4
    left_out = [r["label"] for r in table.where("not is_positive").orderBy("ord").collect()]
    assert len(left_out) == 16 and left_out[:4] == ["Age", "Matches Played", "Starts", "Minutes"]


def test_fold_name(spark):
    got = column(spark, ["  Łucja  NOWAŃSKA", "İnci Østergård", "éa", "Đorđe", None], clean.fold_name)
    assert got == ["lucja nowanska", "inci ostergard", "ea", "dorde", None]


def test_age(spark):
    assert column(spark, ["40-018", "17-364", "x", None], clean.age_years) == [40.05, 18.0, None, None]


def test_fee(spark):
    fees = ["€75M", "€21.4M", "Free", "?", None]
    assert column(spark, fees, clean.fee_millions) == [75.0, 21.4, 0.0, None, None]
    assert column(spark, fees, clean.fee_kind) == ["paid", "paid", "free", "unknown", "unknown"]


def test_route_and_position(spark):
    assert [tuple(r) for r in column(spark, ["A. Club\nB Club", "only"], clean.route)] == [
        ("A. Club", "B Club"), ("only", None)]
    assert column(spark, ["FW,MF", "MF,FW", "GK"], clean.primary_token) == ["FW", "MF", "GK"]


def test_clamp_and_format(spark):
    numbers = lambda f: lambda s: f(s.try_cast("double"))
    assert column(spark, ["-3", "0.05", "7", None], numbers(clean.clamp_floor)) == [0.1, 0.1, 7.0, None]
    assert column(spark, ["1.485", "1.475", "2", None], numbers(clean.fixed)) == ["1.48", "1.48", "2.00", "N/A"]


def test_csv_with_mark_and_line_break(spark, tmp_path):
    text = '﻿Player,Team,Minutes,Transfer Fee,Transfer Type\nÍgor,Dunmere,998,€75M,"E. Club\nMan T"\nBo,Ashford,N/A,Free,"X\nY"\n'
    (tmp_path / "t.csv").write_text(text, encoding="utf-8")
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), catalog.TRANSFERS, multiline=True).collect()
    assert [r["Player"] for r in rows] == ["Ígor", "Bo"]
    assert rows[0]["Transfer Type"] == "E. Club\nMan T" and rows[1]["Minutes"] is None


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "n.csv").write_text('\ufeffb,extra,a\n1,x,one\nN/A,y,two\n', encoding="utf-8")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "n.csv"), schema).collect())) == [("one", 1), ("two", None)]
    with pytest.raises(ValueError, match="no column c"):
        files.read_csv(spark, str(tmp_path / "n.csv"), T.StructType([T.StructField("c", T.StringType())]))


def test_bad_cells_are_reported(spark, tmp_path):
    (tmp_path / "b.csv").write_text("a,b\n1,2\noops,3\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "b.csv"), schema).collect()
    rows = files.read_csv(spark, str(tmp_path / "b.csv"), schema, keep_bad=True).collect()
    assert [(r["a"], r["b"], r["_bad"]) for r in rows] == [(1, 2, None), (None, 3, "oops,3")]


def test_wide_letters_and_signs_are_folded(spark):
    row = spark.createDataFrame([("\u212b\uff41\u0301 \u1e9b", "  €3M ")], "t string, fee string")
    assert row.select(clean.fold_name(F.col("t"))).first()[0] == "aa s"
    assert row.select(clean.fee_millions(F.col("fee"))).first()[0] == 3.0


def test_csv_null_marker_and_quotes(spark, tmp_path):
    frame = spark.createDataFrame([("a", None, 'say "x", y'), ("b", 2.5, None)], "k string, v double, s string")
    path = str(tmp_path / "out")
    files.write_csv(frame, path, ["s", "k", "v"])
    assert "N/A" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    back = files.read_csv(spark, path, frame.select("s", "k", "v").schema)
    assert sorted(back.select("k", "v", "s").collect()) == sorted(frame.collect())


def test_sorted_csv_is_in_one_order_over_its_files(spark, tmp_path):
    frame = spark.range(5000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files.write_sorted_csv(frame, str(tmp_path / "s"), [F.desc("v"), "id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "s").glob("*.csv"))
    lines = [tuple(map(int, x.split(","))) for p in parts for x in p.read_text().splitlines()[1:]]
    assert len(parts) > 1 and len(lines) == 5000
    assert lines == sorted(lines, key=lambda r: (-r[1], r[0]))


class Named:
    """A session that only knows its settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings
        self.sparkContext = self
        self.applicationId = "app-of-the-test"

    def get(self, key, default=None):
        return self.settings.get(key.split(".")[1], default)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.new_path(Named(checkpoint="hdfs://x/y/", master="yarn"), "z").startswith("hdfs://x/y/z-")
    with pytest.raises(ValueError):
        session.shared_folder(Named(master="yarn"))
    own = session.shared_folder(Named(master="local[2]"))
    assert own == session.shared_folder(Named(master="local[2]"))


def test_staged_table_keeps_columns_and_types(spark):
    frame = spark.range(6).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("g"), F.lit(None).cast("int").alias("x"))
    back = session.stage(frame, "six", ["g"])
    assert back.dtypes == frame.dtypes and sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
