"""Cleaning: order of dedup and filter, counters, independence of partitions."""

import random

import pytest
from pyspark.sql import functions as F

from vocatio.operators import clean

LONG, SHORT = "x" * 30, "x " * 29
SCHEMA = "year string, rec_id string, position_responsibilities string, ord long, extra string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(y, i, t, n, f"e{n}") for n, (y, i, t) in enumerate(rows)], SCHEMA
    )


def kept(df):
    return sorted(row["ord"] for row in clean.clean_postings(df, order_by=("ord",)).collect())


def counts(df):
    found = clean.clean_counts(df, order_by=("ord",)).collect()
    return {row["year"]: row.asDict() for row in found}


def test_short_first_copy_hides_the_long_one(spark):
    df = frame(
        spark,
        [
            ("2021", "a", LONG),
            ("2021", "a", LONG),
            ("2021", "b", SHORT),
            ("2021", "b", LONG),
            ("2022", "a", LONG),
            ("2021", "c", None),
            ("2021", "d", "　" * 60),
            ("2021", "e", LONG[:29]),
            ("2021", "f", LONG + "y"),
        ],
    )
    assert kept(df) == [0, 4, 8]
    assert counts(df)["2021"] == {
        "year": "2021",
        "dropped_total": 6,
        "kept": 2,
        "dropped_dup": 2,
        "dropped_short": 4,
        "total": 8,
    }


def test_null_and_blank_ids_are_one_group(spark):
    df = frame(spark, [("2021", None, LONG), ("2021", "", LONG), ("2021", " ", LONG)])
    assert kept(df) == [0, 2]


def test_other_columns_pass_through(spark):
    found = clean.clean_postings(frame(spark, [("2021", "a", LONG)]), order_by=("ord",))
    assert found.columns == ["year", "rec_id", "position_responsibilities", "ord", "extra"]
    assert found.first()["extra"] == "e0"


@pytest.mark.parametrize("missing", ["rec_id", "position_responsibilities", "year", "ord"])
def test_missing_columns_are_refused(spark, missing):
    df = frame(spark, [("2021", "a", LONG)]).drop(missing)
    with pytest.raises(ValueError, match=missing):
        clean.clean_postings(df, order_by=("ord",))
    with pytest.raises(ValueError, match=missing):
        clean.clean_counts(df, order_by=("ord",))


def test_random_rows_equal_brute_force_for_any_partitioning(spark):
    rng = random.Random(5)
    # One id holds a third of the rows.
    rows = [
        (
            rng.choice(["2020", "2021"]),
            "hot" if rng.random() < 0.34 else str(rng.randint(0, 200)),
            rng.choice([LONG, SHORT, LONG + "z", None]),
        )
        for _ in range(1500)
    ]
    seen, expected, stats = set(), [], {}
    for n, (year, key, text) in enumerate(rows):
        stat = stats.setdefault(year, {"total": 0, "kept": 0, "dropped_dup": 0, "dropped_short": 0})
        stat["total"] += 1
        if (year, key) in seen:
            stat["dropped_dup"] += 1
            continue
        seen.add((year, key))
        good = len("".join((text or "").split())) >= 30
        stat["kept" if good else "dropped_short"] += 1
        if good:
            expected.append(n)
    df = frame(spark, rows)
    for partitions in (1, 8):
        moved = df.repartition(partitions, F.rand(1))
        assert kept(moved) == expected
        found = counts(moved)
        for year, stat in stats.items():
            assert {k: found[year][k] for k in stat} == stat
            assert stat["total"] == found[year]["kept"] + found[year]["dropped_total"]


def test_copies_are_reduced_before_the_shuffle(spark):
    df = frame(spark, [("2021", "a", LONG)])
    plan = clean.clean_postings(df, order_by=("ord",))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange")
