"""Crosswalk joins and their report."""

import pytest
from pyspark.sql import functions as F

from vocatio.operators import crosswalk, quality, sizing

MAPPING = [
    ("1-01", "15-1.00", "T1", 0.9, "high"),
    ("1-01", "15-2.00", "T2", 0.9, "low"),
    ("1-02", "11-1.00", "T3", 0.5, "low"),
]


@pytest.fixture
def mapping(spark):
    schema = "dadian_code string, onet_code string, onet_title string, similarity_score double, confidence string"
    return spark.createDataFrame(MAPPING, schema)


@pytest.fixture
def detail(spark):
    return spark.createDataFrame(
        [("15-1.00", "D1", "K1")], "`O*NET-SOC Code` string, Description string, All_Tasks string"
    )


def matched(spark, codes):
    rows = [
        (n, "2021", "L" if code else "", "1" if code else "", code) for n, code in enumerate(codes)
    ]
    return spark.createDataFrame(
        rows,
        "n int, year string, match_Level1_Name string, match_Level1_Code string, match_Level4_Code string",
    )


def test_hits_misses_and_fan_out(spark, mapping, detail):
    df = matched(spark, ["1-01", "1-02", "9-99", "", None, "未匹配"])
    found = crosswalk.add_crosswalk(df, mapping, detail)
    assert found.columns[5:] == [
        "level1", "level1_code", "onet_code", "onet_title", "onet_similarity_score",
        "onet_confidence", "onet_description", "onet_tasks",
    ]
    rows = sorted((r["n"], r["onet_code"], r["onet_description"], r["level1_code"]) for r in found.fillna("-").collect())
    assert rows == [
        (0, "15-1.00", "D1", "1"),
        (0, "15-2.00", "-", "1"),
        (1, "11-1.00", "-", "1"),
        (2, "-", "-", "1"),
        (3, "-", "-", "00"),
        (4, "-", "-", "00"),
        (5, "-", "-", "1"),
    ]
    assert {r["level1"] for r in found.where("n in (3, 4)").collect()} == {"未匹配"}


def test_best_only_and_no_details(spark, mapping):
    df = matched(spark, ["1-01", "1-02", ""])
    found = crosswalk.add_crosswalk(df, mapping, best_only=True)
    assert "onet_description" not in found.columns
    assert sorted((r["n"], r["onet_code"]) for r in found.fillna("-").collect()) == [
        (0, "15-1.00"), (1, "11-1.00"), (2, "-"),
    ]


def test_other_code_column(spark, mapping):
    df = matched(spark, ["1-02"]).withColumnRenamed("match_Level4_Code", "code")
    row = crosswalk.add_crosswalk(df, mapping, code_column="code").first()
    assert row["onet_title"] == "T3"


def test_joins_with_and_without_broadcast_are_equal(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 6 == 1, F.lit(None).cast("string"))
        .when(F.col("id") % 6 == 4, F.lit(" "))
        .otherwise((F.col("id") % 50).cast("string"))
        .alias("k"),
        "id",
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("3", 3), ("zz", 4), (None, 5), (" ", 6), ("", 7)], "code string, v int"
    )
    small = sizing.left_join(left, sizing.dimension(right), ("k", "code"))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    plain = left.join(right, left.k == right.code, "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sizing.left_join(left, sizing.dimension(right, max_bytes=0), ("k", "code"))
        assert "SortMergeJoin" in large._jdf.queryExecution().toString()
        assert small.columns == large.columns == ["k", "id", "code", "v"]
        for found in (small, large):
            assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
        blank = large.where("k IS NULL OR k = ' '").select(F.spark_partition_id().alias("p")).distinct()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert blank.count() > 1  # spread over several tasks
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_nothing_runs_while_a_crosswalk_is_planned(spark, mapping, detail):
    df = matched(spark, ["1-01", ""])
    spark.sparkContext.setJobGroup("planning", "planning")
    crosswalk.add_crosswalk(df, mapping, detail)
    crosswalk.join_report(df, mapping)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")


def test_size_is_measured(spark):
    rows = spark.createDataFrame([("abc", 1, [1.0, 2.0])], "s string, n int, v array<double>")
    count, size = sizing.measure(rows)
    assert count == 1 and size == (3 + 8) + (8 + 8) + (16 + 8)
    assert sizing.measure(rows.limit(0)) == (0, 0)


def test_join_report(spark, mapping):
    def report(codes):
        rows = crosswalk.join_report(matched(spark, codes), mapping).collect()
        return tuple(rows[0]) if rows else None

    assert report(["1-01"] * 19 + ["9-99"]) == (20, 1, 0.05, False)
    assert report(["1-01"] * 18 + ["9-99"] * 2) == (20, 2, 0.1, True)
    assert report(["", None, "未匹配"]) == (3, 0, 0.0, False)


def test_join_report_without_rows(spark, mapping):
    empty = matched(spark, ["1-01"]).where("n < 0")
    assert crosswalk.join_report(empty, mapping).collect() == []


def test_reconciliation(spark):
    before = spark.createDataFrame([("2020",)] * 3 + [("2021",)] * 2 + [("2022",)], "year string")
    after = spark.createDataFrame([("2020",)] * 3 + [("2021",)] * 5 + [("2023",)], "year string")
    rows = sorted(tuple(r) for r in quality.reconcile(before, after).collect())
    assert rows == [("2020", 3, 3, 0, "equal"), ("2021", 2, 5, 3, "differs")]


def test_marked_dimensions_stay_marked_when_joined(spark):
    """The postings are not shuffled for a crosswalk whose mapping and details are both marked."""
    matched = spark.createDataFrame(
        [("1-1", "a", "1")], "match_Level4_Code string, match_Level1_Name string, match_Level1_Code string"
    )
    mapping = F.broadcast(spark.createDataFrame(
        [("1-1", "11-0001.00", "t", 0.5, "high")],
        "dadian_code string, onet_code string, onet_title string, similarity_score double, confidence string",
    ))
    detail = F.broadcast(spark.createDataFrame(
        [("11-0001.00", "d", "x")], "`O*NET-SOC Code` string, Description string, All_Tasks string"
    ))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = crosswalk.add_crosswalk(matched, mapping, detail, code_column="match_Level4_Code")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
        assert [r["onet_description"] for r in found.collect()] == ["d"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
