# -*- coding: utf-8 -*-
"""Vector search and the decision tree, leaf by leaf."""

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import blocks, models, vectors
from vocatio.operators import dictionary as dictionaries
from vocatio.operators import match as matching
from vocatio.operators.match import MatchSettings, add_candidates

TEXT = "一二三四五六七八九十"


def vector_frame(spark, matrix, key="occ_idx"):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} int, embedding array<float>")


def search(spark, queries, keys, k, **options):
    found = vector_frame(spark, queries, "q").withColumn(
        "c", vectors.cosine_topk(F.col("embedding"), vector_frame(spark, keys), k, **options)
    )
    rows = found.select("q", "c").collect()
    return {r["q"]: None if r["c"] is None else [tuple(c) for c in r["c"]] for r in rows}


def slow_search(queries, keys, k):
    def unit(v):
        v = np.asarray(v, np.float32).astype(np.float64)
        return v / (np.linalg.norm(v) or 1.0)

    out = {}
    for q, query in enumerate(queries):
        scored = [(i, round(float(unit(query) @ unit(key)), 6) + 0.0) for i, key in enumerate(keys)]
        out[q] = sorted(scored, key=lambda p: (-p[1], p[0]))[:k]
    return out


def test_ties_zero_vectors_and_k_beyond_the_dictionary(spark):
    keys = [[1, 0], [0, 1], [1, 0], [0, 0], [2, 0]]
    found = search(spark, [[3, 0], [0, 0], None], keys, 3)
    assert found[0] == [(0, 1.0), (2, 1.0), (4, 1.0)]
    assert found[1] == [(0, 0.0), (1, 0.0), (2, 0.0)]
    assert found[2] is None
    assert len(search(spark, [[1, 1]], keys, 99)[0]) == 5


def test_empty_dictionary_and_missing_vectors(spark):
    assert search(spark, [[1, 0]], [], 3) == {0: []}
    assert search(spark, [[1, 0]], [None, [1, 0]], 3) == {0: [(1, 1.0)]}


def block_search(spark, queries, keys, k, max_block_bytes):
    held = blocks.build_blocks(vector_frame(spark, keys), max_block_bytes)
    asked = vector_frame(spark, queries, "q").select(F.col("q").cast("long").alias("row"), F.col("embedding").alias("vector"))
    rows = blocks.search_blocks(asked, held, k, max_block_bytes).collect()
    return held, {r["row"]: [(c["occ_idx"], c["score"] + 0.0) for c in r["candidates"]] for r in rows}


@pytest.mark.parametrize("max_block_bytes", [vectors.MAX_BLOCK_BYTES, 2000, 700])
def test_search_equals_brute_force_for_any_blocking(spark, max_block_bytes):
    rng = np.random.default_rng(0)
    keys = rng.integers(-2, 3, (60, 6)).tolist()
    queries = rng.integers(-2, 3, (80, 6)).tolist()
    expected = slow_search(queries, keys, 7)
    if max_block_bytes == vectors.MAX_BLOCK_BYTES:
        found = search(spark, queries, keys, 7)
        assert {q: [(i, s + 0.0) for i, s in c] for q, c in found.items()} == expected
    else:
        with pytest.raises(vectors.TooLarge):
            search(spark, queries, keys, 7, max_block_bytes=max_block_bytes)
    held, found = block_search(spark, queries, keys, 7, max_block_bytes)
    assert found == expected
    assert held.rows.count() > 60 * 6 * 8 // max_block_bytes


def test_blocks_that_cannot_hold_better_entries_are_skipped(spark, monkeypatch):
    """Clusters on a sphere: a vector meets few of the blocks, and no result is lost."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    keys = [(c + rng.normal(scale=0.05, size=16)).tolist() for c in centres for _ in range(40)] + [[0.0] * 16]
    queries = [(c + rng.normal(scale=0.05, size=16)).tolist() for c in centres for _ in range(5)] + [[0.0] * 16, None]
    sent = []
    met = blocks._met
    monkeypatch.setattr(blocks, "_met", lambda rows, *more: (sent.append(rows.count()), met(rows, *more))[1])
    held, found = block_search(spark, queries, keys, 5, 5000)
    assert found == slow_search(queries[:-1], keys, 5) and len(found) == len(queries) - 1
    n_blocks = held.rows.count()
    assert n_blocks > 12 and sum(sent) < 0.6 * n_blocks * len(queries)


def test_large_dictionaries_keep_every_posting(spark):
    rng = np.random.default_rng(3)
    keys = rng.normal(size=(50, 4)).tolist()
    rows = [(i, "a text of some length" if i % 5 else "short", rng.normal(size=4).tolist() if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, standardized_job_description string, embedding array<double>")
    small = add_candidates(df, vector_frame(spark, keys), max_block_bytes=300)
    whole = add_candidates(df, vector_frame(spark, keys))
    assert small.columns == whole.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, whole.collect()))
    assert add_candidates(df, vector_frame(spark, []), max_block_bytes=1).count() == 60


def test_search_does_not_shuffle_the_postings(spark):
    queries = vector_frame(spark, [[1, 0]], "q")
    column = vectors.cosine_topk(F.col("embedding"), vector_frame(spark, [[1, 0]]), 1)
    plan = queries.select("q", column)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") == 1


def test_column_maths(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    rows = df.select(vectors.l2_normalize(F.col("v")).alias("u"), vectors.dot(F.col("v"), F.col("v")).alias("d")).collect()
    assert [list(r["u"]) for r in rows] == [[0.6, 0.8], [0.0, 0.0]]
    assert [r["d"] for r in rows] == [25.0, 0.0]


# --- decision tree ------------------------------------------------------------

NAMES = ["法官", "厨师", "僧人"]


@pytest.fixture(scope="module")
def occupations(spark):
    rows = [
        (i, name, f"任务{i}", f"{i}", "大类", f"{i}-1", "中类", f"{i}-1-2", "小类", f"{i}-1-2-3",
         [float(i == j) for j in range(3)])
        for i, name in enumerate(NAMES)
    ]
    raw = spark.createDataFrame(
        rows,
        "occ_idx int, Level4_Name string, main_task string, Level1_Code string, Level1_Name string, "
        "Level2_Code string, Level2_Name string, Level3_Code string, Level3_Name string, "
        "Level4_Code string, embedding array<float>",
    )
    return dictionaries.prepare_dictionary(raw)


def vector(judge=0.0, cook=0.0, monk=0.0):
    """Unit vector with the given cosines; the rest goes to a fourth axis."""
    rest = max(0.0, 1.0 - judge**2 - cook**2 - monk**2)
    return [judge, cook, monk, rest**0.5]


def run(spark, occupations, cases, settings=MatchSettings(), rerank=None):
    """Match rows with given candidates (and rerank scores) to their outcome."""
    rows = []
    for n, (text, scores) in enumerate(cases):
        order = sorted(range(3), key=lambda i: (-scores[i], i)) if scores else None
        found = [(i, float(scores[i])) for i in order] if scores else None
        given = [float(rerank[n][i]) for i in order] if rerank and rerank[n] else None
        rows.append((n, text, found, given))
    df = spark.createDataFrame(
        rows,
        f"n int, standardized_job_description string, candidates {vectors.CANDIDATE_TYPE}, "
        "rerank_scores array<double>",
    )
    if rerank is None:
        df = df.drop("rerank_scores")
    out = matching.decide(df, occupations, settings)
    return out, {r["n"]: r for r in out.collect()}


def outcome(row):
    return row["match_occupation"], row["embed_score"], row["rerank_score"], row["match_rank"], row["is_match"]


def test_leaves_without_reranking(spark, occupations):
    cases = [
        ("短", None),
        (None, None),
        (" 无法识别 ", None),
        (TEXT, (0.1, 0.549999, 0.2)),
        (TEXT, (0.1, 0.55, 0.2)),
        (TEXT, (0.7, 0.3, 0.2)),
        (TEXT + "法院", (0.7, 0.3, 0.2)),
        (TEXT, (0.75, 0.3, 0.2)),
        (TEXT, (0.749999, 0.3, 0.2)),
        (TEXT, (0.6, 0.6, 0.2)),
    ]
    frame, rows = run(spark, occupations, cases)
    miss = ("未匹配", "否")
    assert [outcome(rows[n]) for n in range(len(cases))] == [
        (miss[0], 0.0, 0.0, 1, miss[1]),
        (miss[0], 0.0, 0.0, 1, miss[1]),
        (miss[0], 0.0, 0.0, 1, miss[1]),
        (miss[0], 0.549999, 0.0, 1, miss[1]),
        ("厨师", 0.55, 0.0, 1, "是"),
        (miss[0], 0.7, 0.0, 1, miss[1]),
        ("法官", 0.7, 0.0, 1, "是"),
        ("法官", 0.75, 0.0, 1, "是"),
        (miss[0], 0.749999, 0.0, 1, miss[1]),
        (miss[0], 0.6, 0.0, 1, miss[1]),
    ]
    assert frame.columns[2:] == [
        "match_occupation", "match_main_task", "match_Level1_Code", "match_Level1_Name",
        "match_Level2_Code", "match_Level2_Name", "match_Level3_Code", "match_Level3_Name",
        "match_Level4_Code", "match_Level4_Name", "embed_score", "rerank_score", "match_rank",
        "is_match",
    ]
    types = dict(frame.dtypes)
    assert (types["embed_score"], types["rerank_score"], types["match_rank"]) == ("double", "double", "int")
    cook, missed = rows[4], rows[3]
    assert (cook["match_Level4_Code"], cook["match_Level2_Code"]) == ("1-01-02-03", "1-01")
    assert (cook["match_main_task"], missed["match_main_task"]) == ("任务1", "未匹配")
    assert missed["match_Level4_Code"] == "" and missed["match_Level1_Name"] == ""


def test_leaves_with_reranking(spark, occupations):
    near = (0.7, 0.65, 0.6)
    cases = [
        (TEXT, near),
        (TEXT, near),
        (TEXT, near),
        (TEXT + "佛教", near),
        (TEXT, (0.2, 0.6, 0.1)),
        ("短", None),
        (TEXT, (0.1, 0.5, 0.2)),
    ]
    given = [(0.1, 0.199, 0.05), (0.3, 0.9, 0.1), (0.2, 0.2, 0.2), (0.1, 0.3, 0.8), None, None, None]
    _, rows = run(spark, occupations, cases, rerank=given)
    assert [outcome(rows[n]) for n in range(len(cases))] == [
        ("未匹配", 0.7, 0.199, 1, "否"),  # best rerank score too low: both scores kept
        ("厨师", 0.65, 0.9, 2, "是"),  # rank 2 wins
        ("未匹配", 0.7, 0.2, 1, "否"),  # tie: first wins, then its rule fails
        ("僧人", 0.6, 0.8, 3, "是"),  # rule passes by keyword
        ("厨师", 0.6, 0.0, 1, "是"),  # not eligible: falls back to the top candidate
        ("未匹配", 0.0, 0.0, 1, "否"),
        ("未匹配", 0.5, 0.0, 1, "否"),
    ]


def test_rule_failure_after_reranking_keeps_the_chosen_scores(spark, occupations):
    _, rows = run(
        spark, occupations, [(TEXT, (0.6, 0.7, 0.65))], rerank=[(0.3, 0.1, 0.9)]
    )
    assert outcome(rows[0]) == ("未匹配", 0.65, 0.9, 1, "否")


def test_labels_and_rules_are_parameters(spark, occupations):
    settings = MatchSettings(
        min_embed_score=0.1, unmatched_label="none", is_match_yes="y", is_match_no="n",
        suspicious_occupations={"厨师": ["菜"]},
    )
    _, rows = run(
        spark, occupations, [(TEXT, (0.2, 0, 0)), (TEXT, (0, 0.2, 0)), (TEXT + "菜", (0, 0.2, 0))],
        settings,
    )
    assert [(r["match_occupation"], r["is_match"]) for r in (rows[0], rows[1], rows[2])] == [
        ("法官", "y"), ("none", "n"), ("厨师", "y"),
    ]


def test_whole_match_with_models(spark, occupations):
    asked = spark.sparkContext.accumulator(0)

    def embed_factory():
        def embed(texts):
            asked.add(len(texts))
            return np.array([[t.count("法"), t.count("菜"), t.count("佛")] for t in texts], float)

        return embed

    def rerank_factory():
        return lambda pairs: [1.0 if "厨" in candidate else 0.0 for _, candidate in pairs]

    texts = ["法" * 12, "菜" * 12, "菜" * 9, None, "法" * 6 + "菜" * 5 + "人"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, standardized_job_description string")
    found = matching.match(df, occupations, embed=embed_factory).collect()
    assert asked.value == 3  # valid texts only, each of them once
    found.sort(key=lambda r: r["n"])
    assert [r["match_occupation"] for r in found] == ["法官", "厨师", "未匹配", "未匹配", "法官"]
    again = matching.match(df, occupations, embed=embed_factory, rerank=rerank_factory)
    rows = again.orderBy("n").collect()
    assert [(r["match_occupation"], r["match_rank"], r["rerank_score"]) for r in rows] == [
        ("厨师", 2, 1.0), ("厨师", 1, 1.0), ("未匹配", 1, 0.0), ("未匹配", 1, 0.0), ("厨师", 2, 1.0),
    ]
    counts = matching.match_counts(again.withColumn("year", F.lit("2021"))).first()
    assert (counts["total"], counts["matched"], counts["unmatched"]) == (5, 3, 2)


def test_absent_text_column_matches_nothing(spark, occupations):
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "n int, embedding array<float>")
    row = matching.match(df, occupations).first()
    assert (row["is_match"], row["embed_score"]) == ("否", 0.0)


# --- adapters -----------------------------------------------------------------


def test_generator_skips_nulls_and_is_built_once_per_worker(spark):
    built = spark.sparkContext.accumulator(0)

    def factory():
        built.add(1)
        return lambda prompts: [p.upper() for p in prompts]

    df = spark.createDataFrame([("a",), (None,), ("b",)], "t string").coalesce(1)
    assert [r[0] for r in df.select(models.generated(F.col("t"), factory)).collect()] == ["A", None, "B"]
    assert built.value == 1

    def named_factory():
        name = f"{os.getpid()} {uuid.uuid4().hex}"
        return lambda prompts: [name for _ in prompts]

    many = spark.range(200).repartition(200).select(F.col("id").cast("string").alias("t"))
    named = many.select(models.generated(F.col("t"), named_factory).alias("g"))
    names = {r["g"] for r in named.collect()} | {r["g"] for r in named.collect()}
    assert len(names) == len({name.split()[0] for name in names}) < 200


@pytest.mark.parametrize("max_block_bytes", [vectors.MAX_BLOCK_BYTES, 60])
def test_reranker_gets_pairs_in_small_calls(spark, max_block_bytes):
    def factory():
        def rerank(pairs):
            assert 0 < len(pairs) <= 2
            return [float(len(q) * 10 + len(c)) for q, c in pairs]

        return rerank

    texts = spark.createDataFrame([(i, "x" * i) for i in range(6)], "occ_idx int, occupation_text string")
    df = spark.createDataFrame(
        [("q", [3, 1, 5]), ("qq", None), ("qqq", []), ("q" * 4, [0, 9])], "t string, c array<int>"
    ).coalesce(1)
    column = models.reranked(F.col("t"), F.col("c"), texts, factory, 2, max_block_bytes)
    assert [r[0] for r in df.select(column).collect()] == [[13.0, 11.0, 15.0], None, [], [40.0, 0.0]]


def test_a_missing_answer_is_an_error(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    with pytest.raises(Exception, match="1 answers to 2 prompts"):
        df.select(models.generated(F.col("t"), lambda: lambda prompts: prompts[:1])).collect()


def test_embedding_is_normalized(spark):
    df = spark.createDataFrame([("aab",), (None,), ("!",)], "t string")
    rows = df.select(models.embedded(F.col("t"), lambda: models.letter_profile())).collect()
    assert rows[0][0][:2] == pytest.approx([2 / 5**0.5, 1 / 5**0.5])
    assert rows[1][0] is None and sum(rows[2][0]) == 0.0


# --- dictionary ---------------------------------------------------------------


def test_vector_cache_is_reused_until_content_or_model_changes(spark, occupations, folder):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def embed(texts):
            calls.add(len(texts))
            return np.ones((len(texts), 2))

        return embed

    plain = occupations.drop("embedding")

    def vectors_of(table, model="m"):
        return dictionaries.cached_dictionary(table, factory, folder, model).count()

    assert vectors_of(plain) == 3 and calls.value == 3
    assert vectors_of(plain.repartition(5)) == 3 and calls.value == 3
    edited = plain.withColumn("occupation_text", F.concat("occupation_text", F.lit("!")))
    assert vectors_of(edited) == 3 and calls.value == 6
    assert vectors_of(plain, "other") == 3 and calls.value == 9
    recoded = plain.withColumn("Level1_Code", F.lit("9"))
    found = dictionaries.cached_dictionary(recoded, factory, folder, "m")
    assert {r["Level1_Code"] for r in found.collect()} == {"9"} and calls.value == 9
    assert found.columns == [*plain.columns, "embedding"]


def test_default_rules_are_attached(spark, occupations):
    found = dictionaries.with_keywords(occupations).collect()
    words = {r["Level4_Name"]: r["rule_keywords"] for r in found}
    assert words["厨师"] is None and words["法官"] == fixed.SUSPICIOUS_OCCUPATIONS["法官"]


def test_vectors_go_to_blocks_without_one_task_per_block(spark):
    """Numbers of copies are broadcast, whatever Spark's threshold: a block's vectors are not brought together first."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(64)]
    held = blocks.build_blocks(spark.createDataFrame(rows, "occ_idx int, embedding array<double>"), 1024)
    rows = [(0, 0, i, b"\0" * 32) for i in range(100)]
    sent = spark.createDataFrame(rows, "pivot int, part int, row long, vector binary")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = blocks._met(sent, held, 3, 10)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
        assert met.select("row").distinct().count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prompts_reach_the_model_in_slices(spark):
    """However large the Arrow batch, few prompts are held as Python strings."""

    def factory():
        def generate(prompts):
            if len(prompts) > models.PROMPTS_PER_CALL:
                raise ValueError(f"{len(prompts)} prompts at once")
            return [p + "!" for p in prompts]

        return generate

    asked = spark.range(0, 3000, 1, 1).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("t"))
    found = asked.select("id", models.generated(F.col("t"), factory).alias("g")).collect()
    assert all(r["g"] == (f"{r['id']}!" if r["id"] % 3 else None) for r in found) and len(found) == 3000
