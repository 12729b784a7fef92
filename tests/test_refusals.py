"""Inputs that must be refused or kept, never lost: one failing input per rule."""

import pytest
from pyspark.sql import functions as F

from roadlens.functions.timeofday import Period, periods_from
from roadlens.operators import compare, links, performance, profiles, transfer, transit
from roadlens.operators.quality import QualityError
from roadlens.sources import tables

PERF = "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, link_id STRING, volume DOUBLE, speed_mph DOUBLE"
LINK = "from_node_id BIGINT, to_node_id BIGINT, link_id STRING, TAZ INT, FT INT, district_id INT, length_in_mile DOUBLE, free_speed DOUBLE"


def test_incomplete_pairs_are_matched_by_link_id(spark):
    perf = spark.createDataFrame([("am", None, 2, "7", 100.0, 30.0), ("am", 3, 4, "8.0", 50.0, 30.0), ("md", 3, 4, "8", 60.0, 30.0)], PERF)
    net = spark.createDataFrame([(1, 2, "7", 2000, 1, 1, 2.0, 60.0), (3, 4, "8", 2000, 1, 1, 2.0, 60.0)], LINK)
    rows = {(r.time_period, r.link_id): r for r in performance.preprocess_performance(perf, net).collect()}
    assert len(rows) == 3 and rows["am", "7"].TAZ == 2000 and rows["am", "7"].from_node_id is None and rows["am", "7"].length == 2.0
    with pytest.raises(QualityError):
        performance.preprocess_performance(perf.drop("link_id"), net)


def test_no_period_left(spark):
    perf = spark.createDataFrame([("am", 3, 4, "8", 0.1, 30.0)], PERF)
    net = spark.createDataFrame([(3, 4, "8", 2000, 1, 1, 2.0, 60.0)], LINK)
    with pytest.raises(Exception, match="no period with volume"):
        performance.preprocess_performance(perf, net).collect()


def test_profiles_refuse_unmatched_and_repeated_links(spark):
    perf = spark.createDataFrame([("am", 1, 2, "a", 100.0, 30.0), ("am", 3, 4, "b", 50.0, 30.0)], PERF)
    one = spark.createDataFrame([("am", 1, 2, 60.0)], "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, vdf_free_speed_mph DOUBLE")
    periods, keys = [Period("am", 360, 540)], ["from_node_id", "to_node_id"]
    with pytest.raises(Exception, match="without a link"):
        profiles.profile_inputs(perf, one, periods, keys).collect()
    with pytest.raises(Exception, match="duplicate"):
        profiles.profile_inputs(perf.limit(1), one.union(one), periods, keys).collect()
    assert profiles.profile_inputs(perf.where("from_node_id = 1"), one, periods, keys).count() == 1


def test_transit_difference_needs_both_sides(spark):
    cells = spark.createDataFrame([("BD", "am", 4.0, 2.0, 1.0, 3.0), ("NB", "am", 1.0, 1.0, 1.0, 1.0), ("BD", "md", 8.0, 2.0, 1.0, 3.0)],
                                  "scenario STRING, time_period STRING, delay DOUBLE, person_delay DOUBLE, person_hour DOUBLE, person_mile DOUBLE")
    got = {(r.scenario, r.time_period): r.delay for r in transit.transit_report(cells).collect()}
    assert got["DIFF", "am"] == 3.0 and got["DIFF", "md"] is None and got["BD", "md"] == 8.0 and got["DIFF", "total"] == 11.0


def test_repeated_daily_rows(spark):
    perf = spark.createDataFrame([("am", 1, 2, 100.0, 10.0, 1), ("am", 1, 2, 200.0, 20.0, 2)],
                                 "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, volume DOUBLE, speed_mph DOUBLE, line INT")
    plan = periods_from({"am": "0600_0900", "md": "0900_1500"})
    with pytest.raises(Exception, match="repeated link and period"):
        compare.daily_aggregate(perf, plan).collect()
    assert compare.daily_aggregate(perf, plan, order="line").first().volume == 200.0


def network(spark, **cells):
    base = {"link_id": "1", "from_node_id": 1, "to_node_id": 2, "ATYPE": "1", "FTYPE": "1", "CAPCLASS": "11", "SPDCLASS": "11", "DISTANCE": "1",
            "AMLANE": "2", "AMLIMIT": "0", "AMTOLL": "0"} | cells
    return spark.createDataFrame([base], ", ".join(f"{k} {'BIGINT' if k.endswith('node_id') else 'STRING'}" for k in base))


def test_conversion_rules(spark):
    def reason(nodes=None, **cells):
        return links.period_links(network(spark, **cells), ["am"], nodes).first().reject_reason
    nodes = spark.createDataFrame([(1,), (None,)], "node_id BIGINT")
    assert reason(AMLANE="2.5") == "lanes_not_integer" and reason(AMLANE="0") == "no_lanes" and reason(CAPCLASS="x") == "capacity_class_not_integer"
    assert reason(nodes) == "unknown_node" and reason(to_node_id=1) == "self_loop" and reason(AMLANE=" 2 ") != "lanes_not_integer"
    wide = spark.createDataFrame([("vdf_code", "100")], "data_type STRING, vdf_code STRING")
    with pytest.raises(QualityError, match="no row `all`"):
        links.parameter_table(wide)


def test_one_run_below_outputs(spark, tmp_path):
    for run in ("one", "two"):
        (tmp_path / "Outputs" / run).mkdir(parents=True)
        (tmp_path / "Outputs" / run / "link_am.csv").write_text(f"a\n{run}\n")
    with pytest.raises(QualityError, match="more than one"):
        tables.resolve_period_file(spark, str(tmp_path), "am", "link.csv")
    assert tables.read_period_tables(spark, str(tmp_path), ["am"], "link.csv", "two").first().a == "two"


def test_a_dearer_path_that_passes_is_kept(spark):
    config = transfer.TransferConfig()
    e = "named_struct('cost', {c}D, 'len', {c}D, 'overlap', {o}D, 'turned', {t}D, 'facility', {q}D, 'naming', {q}D)"

    def edge(a, b, cost, good):
        return f"SELECT 1L b_a, 9L b_b, 100D b_len, {a}L e_from, {b}L e_to, " + e.format(c=cost, o=cost if good else 0, t=cost if good else 0, q=1 if good else 0) + " e"
    edges = spark.sql(" UNION ALL ".join([edge(1, 2, 40, False), edge(2, 9, 40, False), edge(1, 3, 50, True), edge(3, 9, 50, True)]))
    found = transfer.search_paths(edges, config).collect()
    assert [[(x.a, x.b) for x in r.path] for r in found] == [[(1, 3), (3, 9)]]
    assert edges.where(F.col("e.cost") < 45).count() == 2 and transfer.search_paths(edges.where(F.col("e.cost") < 45), config).count() == 0


def test_old_parameter_columns_go_by_their_last_digit(spark):
    from roadlens.operators.links import drop_old_parameter_columns

    names = ["VDF_alpha1", "VDF_alpha12", "QVDF_x_1", "QVDF_2", "VDF_alpha", "QVDF_n", "XVDF_1", "VDF_1a", "vdf_1"]
    frame = spark.range(1).toDF("VDF_alpha1")
    for n in names[1:-1]:
        frame = frame.selectExpr("*", f"1 AS `{n}`")
    assert drop_old_parameter_columns(frame).columns == ["VDF_alpha", "QVDF_n", "XVDF_1", "VDF_1a"]
