"""Arrival of files, the end-to-end job and standardization."""

import os
import time
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import models
from vocatio.operators import dictionary, standardize
from vocatio.operators.clean import clean_postings
from vocatio.operators.match import MatchSettings
from vocatio.plans import analytics
from vocatio.plans.classify import STAGES, Job, chosen_stages, classify
from vocatio.sources.datasets import read_dataset, write_final
from vocatio.sources.postings import read_postings
from vocatio.streaming import arrivals

COLUMNS = ["rec_id", "position_responsibilities"]
LONG = "word " * 40


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(",".join(COLUMNS) + "\n")
        out.writelines(f'{key},"{text}"\n' for key, text in rows)


def ids(df):
    rows = df.select("year", F.coalesce("rec_id", F.lit("")), F.right("position_responsibilities", F.lit(1)))
    return sorted(tuple(r) for r in rows.collect())


def ingest(spark, folder, **options):
    stream = arrivals.stream_postings(spark, f"{folder}/in", COLUMNS, **options)
    arrivals.start_append(stream, f"{folder}/raw", f"{folder}/state").awaitTermination()
    return read_dataset(spark, f"{folder}/raw")


def test_a_stream_resumes_and_takes_each_file_once(spark, folder):
    put(f"{folder}/in", "p_2020.csv", [("a", LONG + "1"), ("b", "two\nlines")])
    assert ingest(spark, folder).count() == 2
    assert ingest(spark, folder).count() == 2
    put(f"{folder}/in", "p_2021.csv", [("a", LONG + "2"), ("too,many", "cells")])
    with pytest.raises(StreamingQueryException, match="too many cells"):
        ingest(spark, folder)
    rows = ingest(spark, folder, bad_rows="skip")
    assert sorted((r["year"], r["rec_id"]) for r in rows.collect()) == [
        ("2020", "a"), ("2020", "b"), ("2021", "a"),
    ]


def test_refreshed_years_equal_the_batch_result(spark, folder):
    rows = [(str(i % 40), ("short" if i % 7 == 0 else LONG) + str(i % 10)) for i in range(400)]
    put(f"{folder}/in", "p_2020_a.csv", rows[:200])
    put(f"{folder}/in", "p_2020_b.csv", rows[200:])
    ingest(spark, folder, max_files_per_trigger=1)
    out = f"{folder}/clean"
    assert arrivals.refresh_years(spark, f"{folder}/raw", out) == ["2020"]
    batch = clean_postings(read_postings(spark, f"{folder}/in/*.csv"))
    assert ids(read_dataset(spark, out)) == ids(batch)
    # A finished year is left alone unless asked for; a new year is added.
    put(f"{folder}/in", "p_2021.csv", [("a", LONG + "9")])
    ingest(spark, folder)
    assert arrivals.refresh_years(spark, f"{folder}/raw", out) == ["2021"]
    assert arrivals.refresh_years(spark, f"{folder}/raw", out) == []
    assert arrivals.refresh_years(spark, f"{folder}/raw", out, redo=True) == ["2020", "2021"]
    assert read_dataset(spark, out).where("year = '2021'").count() == 1
    # A finished year that receives more rows is cleaned again, as a whole.
    put(f"{folder}/in", "p_2021_b.csv", [("a", LONG + "7"), ("z", LONG + "8")])
    ingest(spark, folder)
    assert arrivals.refresh_years(spark, f"{folder}/raw", out) == ["2021"]
    late = read_dataset(spark, out).where("year = '2021'")
    assert ids(late) == [("2021", "a", "9"), ("2021", "z", "8")]
    assert arrivals.refresh_years(spark, f"{folder}/raw", out) == []


def test_dedup_on_arrival_remembers_earlier_batches(spark, folder):
    schema = "year string, rec_id string, position_responsibilities string, ord long"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        out, state = f"{folder}/out", f"{folder}/state"
        arrivals.start_clean(stream, out, state, order_by=("ord",)).awaitTermination()
        return ids(read_dataset(spark, f"{folder}/out"))

    first = [("2020", "a", LONG + "1", 1), ("2020", "b", "short", 2), ("2020", None, LONG + "n", 3)]
    hot = [("2020", "hot", LONG + str(n % 10), n) for n in range(153, 99, -1)]
    found = arrive(first + hot)
    assert found == [("2020", "", "n"), ("2020", "a", "1"), ("2020", "hot", "0")]
    later = [
        ("2020", "a", LONG + "2", 4),
        ("2020", "b", LONG + "2", 5),
        ("2020", "", LONG + "2", 6),
        ("2021", "a", LONG + "3", 7),
    ]
    assert arrive(later) == [*found, ("2021", "a", "3")]
    # A micro-batch that was written but not committed is taken again, without a trace.
    os.remove(f"{folder}/state/commits/1")
    if os.path.exists(f"{folder}/state/commits/.1.crc"):
        os.remove(f"{folder}/state/commits/.1.crc")
    assert arrive([("2021", "z", LONG + "4", 8)]) == [*found, ("2021", "a", "3"), ("2021", "z", "4")]


def test_a_batch_looks_up_its_own_ids_only(spark, folder):
    """The files of the state store that a batch writes do not grow with the number of batches."""
    schema = "year string, rec_id string, position_responsibilities string, ord long"

    def written():
        found = {}
        for top, _, names in os.walk(f"{folder}/state/ids/state"):
            found |= {os.path.join(top, n): os.path.getsize(os.path.join(top, n)) for n in names if n.endswith(".changelog")}
        return found

    sizes = []
    for batch in range(6):
        rows = [("2020", f"{batch}-{n}", LONG, n) for n in range(200)] + [("2020", f"0-{batch}", LONG, 900 + batch)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        before = written()
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        arrivals.start_clean(stream, f"{folder}/out", f"{folder}/state", order_by=("ord",)).awaitTermination()
        sizes.append(sum(size for path, size in written().items() if path not in before))
    assert read_dataset(spark, f"{folder}/out").count() == 1200
    assert sizes[0] > 0 and max(sizes[1:]) < 2 * sizes[0]


def test_a_model_stage_resumes_after_a_failure(spark, folder):
    asked = spark.sparkContext.accumulator(0)

    def stage(broken):
        def factory():
            def generate(prompts):
                if broken and any("second" in p for p in prompts):
                    raise RuntimeError("model lost")
                asked.add(len(prompts))
                return [p.upper() for p in prompts]

            return generate

        return lambda df: standardize.standardize(df, factory, "")

    def store(text, year):
        rows = [(f"{text} {n}", year) for n in range(5)]
        df = spark.createDataFrame(rows, "position_responsibilities string, year string")
        df.coalesce(1).write.mode("append").partitionBy("year").parquet(f"{folder}/in")
        time.sleep(1.1)  # files are taken in order of their modification time

    def run(broken=False):
        arrivals.run_resumable(
            spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", stage(broken), 1
        )
        return read_dataset(spark, f"{folder}/out").count()

    store("first", "2020")
    store("second", "2021")
    with pytest.raises(Exception, match="model lost"):
        run(broken=True)
    assert asked.value == 5
    assert run() == 10 and asked.value == 10
    store("third", "2021")
    assert run() == 15 and asked.value == 15
    found = read_dataset(spark, f"{folder}/out").where("standardized_job_description like 'THIRD%'")
    assert [r["year"] for r in found.select("year").distinct().collect()] == ["2021"]


# --- standardization ----------------------------------------------------------


def test_blank_postings_are_not_sent(spark):
    sent = spark.sparkContext.accumulator(0)

    def factory():
        def generate(prompts):
            sent.add(len(prompts))
            assert all(p.startswith("<") and p.endswith(">") for p in prompts)
            return ["无法识别" if "x" in p else " 1.做饭2.洗碗 " for p in prompts]

        return generate

    df = spark.createDataFrame(
        [("a", "岗位职责：做饭"), ("b", " "), ("c", None), ("d", "x")], "id string, position_responsibilities string"
    ).withColumn("year", F.lit("2020"))
    found = standardize.standardize(df, factory, "<", ">")
    rows = {r["id"]: (r["standardized_job_description"], r["standardize_ok"]) for r in found.collect()}
    assert sent.value == 2
    assert rows == {
        "a": ("1. 做饭；\n2. 洗碗；", True),
        "b": ("", False),
        "c": ("", False),
        "d": ("无法识别", False),
    }
    counts = standardize.standardize_counts(found).first()
    assert (counts["processed"], counts["success"], counts["failed"]) == (4, 1, 3)
    with pytest.raises(ValueError, match="position_responsibilities"):
        standardize.standardize(df.drop("position_responsibilities"), factory, "")


def test_rule_based_stand_in(ask):
    texts = ["岗位职责：1.做饭；2、洗碗。\n任职要求：会", "", "；。", "a\nb\nc\nd\ne\nf"]
    assert ask(standardize.rule_based_duties, texts) == [
        "1. 做饭\n2. 洗碗", "无法识别", "无法识别", "1. a\n2. b\n3. c\n4. d\n5. e",
    ]


# --- end to end ---------------------------------------------------------------


@pytest.fixture(scope="module")
def job(spark):
    raw = spark.createDataFrame(
        [(0, "word man", "words", "1", "Class", "1-1-1-1"), (1, "zebra zoo", "zz", "2", "Zoo", "2-1-1-1")],
        "occ_idx int, Level4_Name string, main_task string, Level1_Code string, Level1_Name string, Level4_Code string",
    )
    entries = dictionary.prepare_dictionary(raw)
    mapping = spark.createDataFrame(
        [("1-01-01-01", "15-1.00", "T", 0.5, "high")],
        "dadian_code string, onet_code string, onet_title string, similarity_score double, confidence string",
    )
    return Job(
        dictionary=dictionary.embedded_dictionary(entries, lambda: models.letter_profile()),
        mapping=mapping,
        embed=lambda: models.letter_profile(),
        settings=MatchSettings(min_embed_score=0.6),
        order_by=("ord",),
    )


@pytest.fixture
def posted(spark):
    rows = [("2020", "a", LONG, 1), ("2020", "a", LONG, 2), ("2021", "b", "zebra zoo " * 9, 3), ("2021", "c", "short", 4)]
    return spark.createDataFrame(rows, "year string, rec_id string, position_responsibilities string, ord long")


def test_stored_stages_equal_the_lazy_plan(spark, job, posted, folder):
    lazy = classify(posted, job)
    stored = classify(posted, job, store=folder)
    assert sorted(lazy.columns) == sorted(stored.columns)
    columns = sorted(lazy.columns)
    assert sorted(map(str, lazy.select(columns).collect())) == sorted(map(str, stored.select(columns).collect()))
    assert sorted(os.listdir(folder)) == sorted([*STAGES, "answers"])
    found = {r["rec_id"]: (r["match_occupation"], r["onet_code"], r["level1_code"]) for r in stored.collect()}
    assert found == {"a": ("word man", "15-1.00", "1"), "b": ("zebra zoo", None, "2")}
    # Starting later takes the stored stage as input; other years are left alone.
    year = read_dataset(spark, f"{folder}/standardize", ["2021"])
    again = classify(year, job, start_from="match", store=folder)
    assert [r["rec_id"] for r in again.collect()] == ["b"]
    assert read_dataset(spark, f"{folder}/crosswalk").count() == 2


def test_a_lost_run_is_resumed_without_asking_again(spark, job, folder):
    asked = spark.sparkContext.accumulator(0)

    def counting(lost_at):
        def factory():
            embed = models.letter_profile()

            def run(texts):
                if any(lost_at in text for text in texts):
                    raise RuntimeError("model lost")
                asked.add(len(texts))
                return embed(texts)

            return run

        return factory

    def letters(n):
        return "".join(chr(97 + int(c)) for c in str(n))

    rows = [("2020", f"r{n}", f"{LONG} {letters(n % 40)}", n) for n in range(120)]
    posted = spark.createDataFrame(rows, "year string, rec_id string, position_responsibilities string, ord long")
    posted = posted.repartition(4)
    expected = classify(posted, job)
    columns = sorted(expected.columns)
    with pytest.raises(Exception, match="model lost"):
        classify(posted, replace(job, embed=counting(f" {letters(17)}；"), answer_batch=3), store=folder)
    before = asked.value
    assert 0 < before < 40
    kept = spark.read.parquet(f"{folder}/answers/embed").count()
    found = classify(posted, replace(job, embed=counting("never")), store=folder)
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))
    assert spark.read.parquet(f"{folder}/answers/embed").count() == 40  # equal texts are asked once
    assert asked.value - before == 40 - kept
    classify(posted, replace(job, embed=counting("never")), store=folder)
    assert asked.value - before == 40 - kept
    # Another version of the model has answers of its own.
    classify(posted, replace(job, embed=counting("never"), model_names=("generate", "embed 2", "rerank")), store=folder)
    assert asked.value - before == 80 - kept


def test_nothing_left_after_cleaning(spark, job, posted, folder):
    none = posted.where("rec_id = 'c'")
    assert classify(none, job, store=folder).count() == 0


def test_ranges_of_stages(job, posted):
    assert chosen_stages() == STAGES
    assert chosen_stages("match") == ("match", "crosswalk")
    assert chosen_stages("match", "clean") == ("clean",)
    with pytest.raises(ValueError, match="unknown stage"):
        chosen_stages("nothing")
    assert classify(posted, job, only="clean").columns == posted.columns
    assert fixed.STANDARDIZED_COLUMN in classify(posted, job, only="standardize").columns


def test_reports(spark):
    final = spark.createDataFrame(
        [("2020", "A", "15-1", "T", "是", 0.5), ("2020", "A", "15-2", "U", "是", 0.7), ("2020", "B", None, None, "否", 0.1),
         ("2021", "B", "151", "V", "是", 0.9)],
        "year string, level1 string, onet_code string, onet_title string, is_match string, embed_score double",
    )

    def rows(df):
        return [tuple(r) for r in df.collect()]

    assert rows(analytics.count_by_level1(final)) == [("2020", "A", 2), ("2020", "B", 1), ("2021", "B", 1)]
    assert rows(analytics.occupation_trend(final, "15-")) == [("2020", "T", 1), ("2020", "U", 1)]
    assert rows(analytics.match_quality(final)) == [("2020", "否", 1, 0.1), ("2020", "是", 2, 0.6), ("2021", "是", 1, 0.9)]
    assert rows(analytics.of_year(final, 2021).select("level1")) == [("B",)]
    assert analytics.spot_check(final, ["year"], 2).count() == 2
    sample = analytics.review_sample(final, "onet_title", 3, "s").collect()
    assert sample == analytics.review_sample(final.repartition(4), "onet_title", 3, "s").collect()
    assert rows(analytics.first_rows(final, ("year", "level1", "onet_code"), 1)) == [final.first()]


def test_reports_prune_the_stored_dataset(spark, folder):
    final = spark.createDataFrame(
        [("2020", "1", "15-1", "T", "x"), ("2021", "1", "15-2", "U", "x")],
        "year string, level1_code string, onet_code string, onet_title string, unused string",
    )
    write_final(final, folder)
    stored = analytics.of_year(read_dataset(spark, folder), "2021")
    trend = analytics.occupation_trend(stored, "15-")
    assert [tuple(r) for r in trend.collect()] == [("2021", "U", 1)]
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(onet_code,15-)" in plan
    assert "(year#" in plan[plan.index("PartitionFilters") :] and "unused" not in plan
