"""The thirteen operators as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vocatio.llm import (
    alignment, decontamination, digest_index, language_id, language_model, near_duplicates, packing, periodic_runs,
    phrase_prints, secret_scan, token_rollup, url_rules, warc,
)
from vocatio.llm.tables import stored, table
from vocatio.sources.folders import fresh_folder

# The rules given with the task, then the method's own patterns.
RULES = [
    url_rules.place("allow", "org", "/"),
    url_rules.place("block", "example.org", "/es/"),
    url_rules.place("block", "example.org", "/en/1"),
    url_rules.place("allow", "com", "/fr/"),
    url_rules.place("block", "com", "/de/"),
]
PATTERNS = [
    url_rules.words_in_host("block", "cheap", "pills"),
    url_rules.words_in_host("block", "free", "bets"),
    url_rules.words_in_host("block", "online", "casino"),
    url_rules.words_in_host("block", "adult", "cams"),
    *url_rules.listed_rules(
        [
            "! lines of a filter list",
            "||example.net/fr/*?page=",
            "||example.net^*?utm_source=feed|",
            "-x.example.*^es/*.html|",
            "@@||m.*.example.net^",
        ]
    ),
]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.fit_and_identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_prints.compare_with_next(table(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_model.learn_and_score(docs, train=~language_model.held_out())
    return found.withColumn("held_out", language_model.held_out())


def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), RULES + PATTERNS).drop("pattern")


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, all are counted anew by the next tokenizer version, toxic ones go."""
    docs = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    store = fresh_folder(spark, "rollup")
    token_rollup.commit(token_rollup.inserted(docs, "words-1"), store, 1)
    token_rollup.commit(token_rollup.revised(docs, "words-1", "words-2"), store, 2)
    token_rollup.commit(token_rollup.deleted(docs, "words-2").join(toxic, "doc_id", "left_semi"), store, 3)
    return token_rollup.totals(spark, store)


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least=0).drop("complete")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 1024, with_ids=False).drop("bucket")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", F.col("start_word").cast("long").alias("start_word"),
        F.col("n_words").cast("long").alias("n_words"), F.round("similarity", 9).alias("similarity"),
    )


def op10_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents")).drop("n_random")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """In texts whose h = crc32(doc_id) ends in 0, all words from a on repeat the p words there.

    With n words and g = h div 10, a is g mod n and p is 1 + (n - a) div (3 + g mod 8).
    """
    h = "crc32(coalesce(CAST(doc_id AS string), ''))"
    a, p = "CAST(g % n AS int)", "CAST(1 + (n - g % n) DIV (3 + g % 8) AS int)"
    rest = f"(n - {a})"
    words = r"filter(split(text, r'[\x20\x09-\x0D]+'), w -> w <> '')"
    planted = docs.withColumn("h", F.expr(h)).withColumn("words", F.expr(f"IF(h % 10 = 0, {words}, NULL)"))
    planted = planted.withColumn("n", F.size("words")).withColumn("g", F.expr("h DIV 10"))
    again = f"slice(flatten(array_repeat(slice(words, {a} + 1, {p}), CAST({rest} DIV {p} + 1 AS int))), 1, {rest})"
    text = f"IF(n > 0, array_join(concat(slice(words, 1, {a}), {again}), ' '), text)"
    return planted.select("doc_id", F.expr(text).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS first, -r.period AS least)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("best", F.expr(best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.first")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.least")).alias("period"),
        F.expr("1000 * best.length DIV (-best.least)").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents come in as two batches, so that the second meets the index that the first has left."""
    return digest_index.exact_duplicates(table(spark, sf_dir, "documents"), fresh_folder(spark, "digests"), batches=2)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
    )
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = stored(found.withColumn("groups_sha256", digest).drop("groups"), "alignments")
    return alignment.with_counts(found).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_all").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )


QUERIES = {
    run.__name__: run
    for run in (
        op1_language_id, op2_near_duplicates, op3_phrase_fingerprints, op4_lm_scores, op5_url_verdicts,
        op6_token_rollup, op7_warc_round_trip, op8_packing, op9_decontamination, op10_secret_spans,
        op11_periodic_runs, op12_exact_dedup, op13_alignment,
    )
}
