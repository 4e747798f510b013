"""The whole analyses on a small made-up season."""

import statistics

import pytest
from pyspark.sql import functions as F

from statlab import catalog
from statlab.plans import season
from statlab.sources import files
from tests import fixtures


@pytest.fixture(scope="module")
def rows():
    return [r for r in fixtures.players() if r["minutes"] > 90]


@pytest.fixture(scope="module")
def players(spark):
    frame = spark.createDataFrame([tuple(r[f.name] for f in catalog.PLAYER_STATS) for r in fixtures.players()], catalog.PLAYER_STATS)
    return season.prepare_players(frame).repartition(3).cache()


def lines(report):
    return [r["line"] for r in report.orderBy("block", "line_no").collect()]


def test_prepare_reads_raw_headers(spark):
    raw = spark.createDataFrame([("A", "20-073", 91.0, 1.0), ("B", "30-000", 90.0, 2.0)], "Player string, Age string, Minutes double, `Gls/90` double")
    got = season.prepare_players(raw).collect()
    assert [(r["player"], r["age"], r["gls_per_90"]) for r in got] == [("A", 20.2, 1.0)]


def test_team_table(spark, players, rows, tmp_path):
    table = season.team_statistics(players)
    assert len(table.columns) == 217 and table.columns[:4] == ["Group", "Median of Age", "Mean of Age", "Std of Age"]
    got = table.collect()
    assert [r["Group"] for r in got] == ["all", *sorted(fixtures.TEAMS)]
    assert got[0]["Mean of Touches"] == f"{statistics.mean(r['touches'] for r in rows):.2f}"
    team = [r["save_pct"] for r in rows if r["team"] == got[1]["Group"] and r["save_pct"] is not None]
    assert got[1]["Median of Save%"] == ("N/A" if not team else f"{statistics.median(team):.2f}")
    files.write_csv(table, str(tmp_path / "teams"))
    assert spark.read.csv(str(tmp_path / "teams"), header=True).count() == 6


def test_extremes_report(players, rows):
    found = season.metric_extremes(players).collect()
    assert len(found) == 432
    text = lines(season.metric_extremes_report(players))
    assert len(text) == 720
    oldest = max(rows, key=lambda r: (r["age"], ))
    assert text[0] == "Chỉ số: Age" and text[1] == "  Top 3 cầu thủ cao nhất:" and text[5] == "  Top 3 cầu thủ thấp nhất:"
    assert text[2].endswith(f"(Chỉ số: {oldest['age']:.2f})") and text[9] == "-" * 40
    assert [x for x in text if x.startswith("Chỉ số")] == [f"Chỉ số: {x}" for x in catalog.LABELS]


def test_leader_report(players, rows):
    leaders = {r["metric"]: (r["team"], r["total"]) for r in season.team_leaders(players).collect()}
    assert len(leaders) == 56
    for metric in ("gls", "save_pct", "rec_prgr"):
        totals = {}
        for r in rows:
            if r[metric] is not None:
                totals[r["team"]] = totals.get(r["team"], 0) + r[metric]
        best = min(totals, key=lambda t: (-round(totals[t], 6), t))
        assert leaders[metric] == (best, pytest.approx(totals[best]))
    text = lines(season.team_leaders_report(players, "Some League"))
    assert text[:4] == ["Phân tích đội có điểm số cao nhất cho từng chỉ số tích cực - Some League", "=" * 80, "",
                        "1. Đội dẫn đầu cho từng chỉ số tích cực:"]
    assert [x.split(":")[0][2:] for x in text[4:60]] == catalog.POSITIVE
    counted = [int(x.rsplit(": ", 1)[1].split()[0]) for x in text[text.index("3. Danh sách các đội và số chỉ số tích cực dẫn đầu:") + 1:]]
    assert sum(counted) == 56 and counted == sorted(counted, reverse=True)


def test_clusters(players, rows):
    labelled = season.cluster_players(players)
    found = labelled.collect()
    assert len(found) == len(rows) and {r["cluster"] for r in found} == {0, 1, 2, 3}
    assert 0 < found[0]["explained"] <= 1
    keepers = [r["save_pct"] for r in rows if r["save_pct"] is not None]
    filled = {round(r["save_pct"], 9) for r in found if r["position"] != "GK"}
    assert filled == {round(statistics.median(keepers), 9)}
    text = lines(season.clusters_report(labelled))
    assert text[0] == "PHÂN TÍCH CÁC CỤM CẦU THỦ BẰNG K-MEANS (K=4)"
    at = text.index("Cluster")
    sizes = [x.split() for x in text[at + 1:at + 5]]
    assert [s[0] for s in sizes] == list("0123") and sum(int(s[1]) for s in sizes) == len(rows)
    block = text.index(f"--- Cụm 0 ({sizes[0][1]} cầu thủ) ---")
    assert [x[:17].strip() for x in text[block + 1:block + 70]] == [x for x in catalog.LABELS if x not in catalog.VOLUME]
    assert len({len(x) for x in text[block + 1:block + 70]}) == 1
    assert text[block + 71] == "Cầu thủ ví dụ (và vị trí của họ):"
    assert text[block + 72].split() == ["Player", "Position"]
    assert sum(x.startswith("  + Chủ yếu là: ") for x in text) == 4
    assert text[-1].endswith("% phương sai.")


def test_elbow(players):
    rows = season.cluster_elbow(players, range(1, 4)).collect()
    assert rows[0]["inertia"] > rows[-1]["inertia"]


def test_transfers(spark, players, rows, tmp_path):
    regular = [r for r in rows if r["minutes"] > 900][:2]
    a, b = regular
    data = [
        (a["player"], a["team"], 1000, "€21.4M", "X\nShort"),
        (a["player"].upper(), a["team"], 1000, "Free", "Y\nElsewhere"),
        (b["player"], b["team"], 1000, "€5M", f"Z\n{b['team']}"),
        ("Completely Different", "x", 1000, "€5M", "Z\nQ"),
    ]
    transfers = spark.createDataFrame(data, catalog.TRANSFERS)
    found = season.player_transfers(players, transfers, {"Short": a["team"]}, max_distance=0)
    got = sorted((r["player"], r["fee_m"], r["fee_kind"], r["to_team"], r["contradicts"]) for r in found.collect())
    assert got == sorted([
        (a["player"], 21.4, "paid", a["team"], False), (a["player"], 0.0, "free", "Elsewhere", True),
        (b["player"], 5.0, "paid", b["team"], False),
    ])
    printed = season.transfer_table(found)
    assert printed.columns == [f.name for f in catalog.TRANSFERS] and printed.dtypes[2] == ("Minutes", "int")
    files.write_csv(printed, str(tmp_path / "fees"))
    back = files.read_csv(spark, str(tmp_path / "fees"), catalog.TRANSFERS, multiline=True)
    assert sorted(back.collect()) == sorted(printed.collect())
    assert [r["to_team"] for r in season.contradicting_transfers(found).collect()] == ["Elsewhere"]


def test_a_transfer_goes_to_one_of_several_namesakes(spark):
    names = ["player", "team", "minutes"]
    players = spark.createDataFrame([("Ann Lee", "A", 1000.0), ("Ann Lee", "B", 1000.0), ("Bo", "C", 1000.0)], names)
    data = [("Ann Lee", "B", 1000, "€1M", "X\nB"), ("Ann Lee", "B", 1000, "€2M", "X\nZ"), ("Bo", "C", 1000, "Free", "X")]
    found = season.player_transfers(players, spark.createDataFrame(data, catalog.TRANSFERS), {}, max_distance=0)
    assert sorted((r["player"], r["team"], r["fee"], r["contradicts"]) for r in found.collect()) == [
        ("Ann Lee", "A", "€2M", True), ("Ann Lee", "B", "€1M", False), ("Bo", "C", "Free", None)]


def test_value_estimates(spark, players, rows, tmp_path):
    listed = [(r["player"].lower(), r["team"], float(i)) for i, r in enumerate(rows) if i % 5]
    values = spark.createDataFrame(listed, "player string, team string, value_m double")
    found = season.value_estimates(players, values, max_distance=0)
    got = found.collect()
    assert found.columns == [f.name for f in catalog.VALUE_ESTIMATES]
    assert len(got) == len(listed) and len({r["Player"] for r in got}) == len(listed)
    predicted = [r["Predicted_Transfer_Value_M"] for r in got]
    assert predicted == sorted(predicted, reverse=True) and min(predicted) >= 0.1
    assert {r["Position"] for r in got} <= {"GK", "DF", "MF", "FW"}
    files.write_sorted_csv(found, str(tmp_path / "v"), [F.desc("Predicted_Transfer_Value_M"), "Player"])
    assert files.read_csv(spark, str(tmp_path / "v"), catalog.VALUE_ESTIMATES).count() == len(listed)
