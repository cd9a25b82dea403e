# -*- coding: utf-8 -*-
"""Every registered query with its DuckDB counterpart."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import oracle as sql, views
from vocatio.functions import models, text as rules, vectors
from vocatio.operators import clean, crosswalk, dictionary, quality, sizing, standardize
from vocatio.operators.match import MatchSettings, add_candidates, candidate_rows, match, match_counts
from vocatio.plans import analytics
from vocatio.plans.classify import Job, classify
from vocatio.sources import datasets
from vocatio.sources.folders import fresh_folder
from vocatio.sources import postings as files
from vocatio.sources.postings import read_postings
from vocatio.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def registered(oracle: str | None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        ENTRIES[run.__name__] = Entry(run, oracle)
        return run

    return add


ORDER = ("ord",)
NEAR = MatchSettings(min_embed_score=0.5)


# --- cleaning -----------------------------------------------------------------


@registered(sql.with_ctes(sql.CLEANING, "SELECT * FROM clean"))
def clean_posts(spark, sf_dir):
    return clean.clean_postings(views.postings(spark, sf_dir), order_by=ORDER)


CLEAN_STATS = f"""
  SELECT year, CAST(total - kept AS BIGINT) AS dropped_total, kept,
         CAST(total - firsts AS BIGINT) AS dropped_dup, CAST(firsts - kept AS BIGINT) AS dropped_short,
         total
  FROM (SELECT year, count(*) AS firsts, count(*) FILTER ({sql.EFFECTIVE_LEN} >= 30) AS kept
        FROM firsts GROUP BY year)
  JOIN (SELECT year, count(*) AS total FROM postings GROUP BY year) USING (year)"""


@registered(sql.with_ctes(sql.CLEANING, CLEAN_STATS))
def clean_stats(spark, sf_dir):
    return clean.clean_counts(views.postings(spark, sf_dir), order_by=ORDER)


@registered(
    sql.with_ctes(
        sql.CLEANING, f"SELECT year, rec_id, ord, {sql.EFFECTIVE_LEN} AS effective_len FROM postings"
    )
)
def effective_length(spark, sf_dir):
    text = F.col("position_responsibilities")
    return views.postings(spark, sf_dir).select(
        "year", "rec_id", "ord", rules.effective_length(text).cast("long").alias("effective_len")
    )


@registered(
    r"""SELECT page_id, coalesce(nullif(regexp_extract(url, '(19|20)[0-9]{2}'), ''), 'unknown') AS year
        FROM pages"""
)
def year_from_name(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select(
        "page_id", rules.year_from_name(F.col("url")).alias("year")
    )


@registered(sql.with_ctes(sql.CLEANING, CLEAN_STATS))
def clean_counts_stored(spark, sf_dir):
    """Counters as the command line keeps them: written by year, replaced year by year."""
    root = fresh_folder(spark, "counts")
    counts = clean.clean_counts(views.postings(spark, sf_dir), order_by=ORDER)
    datasets.write_counts(counts, root)
    datasets.write_counts(counts.where(F.col("year") > "2019"), root)
    return datasets.read_dataset(spark, root)


# --- text rules ---------------------------------------------------------------


@registered(f"SELECT doc_id, {sql.collapsed('text')} AS collapsed FROM documents")
def collapse_whitespace(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", rules.collapse_whitespace(F.col("text")).alias("collapsed")
    )


@registered(
    sql.with_ctes(
        {"codes": sql.RAW_CODES}, f"SELECT p_partkey, raw, {sql.level_code('raw')} AS code FROM codes"
    )
)
def level_code_normalize(spark, sf_dir):
    codes = views.raw_codes(spark, sf_dir)
    return codes.withColumn("code", rules.normalize_level_code(F.col("raw")))


@registered(
    sql.with_ctes(
        {"entries": sql.NAMES_AND_TASKS},
        f"SELECT p_partkey, {sql.joined_text('name', 'task')} AS occupation_text FROM entries",
    )
)
def occupation_text(spark, sf_dir):
    entries = views.names_and_tasks(spark, sf_dir)
    return entries.select(
        "p_partkey", rules.occupation_text(F.col("name"), F.col("task")).alias("occupation_text")
    )


@registered(
    sql.with_ctes(
        {"headed": sql.HEADED, **sql.duty_ctes("headed", "doc_id", "raw")},
        "SELECT doc_id, duty FROM duties",
    )
)
def duty_sections(spark, sf_dir):
    return views.headed_documents(spark, sf_dir).select(
        "doc_id", rules.duty_text(F.col("raw")).alias("duty")
    )


@registered(
    sql.with_ctes(
        {"headed": sql.HEADED, **sql.duty_ctes("headed", "doc_id", "raw")},
        f"SELECT doc_id, {sql.PROMPT_PREFIX} || substr(duty, 1, 1024) || '<end>' AS prompt FROM duties",
    )
)
def prompt_text(spark, sf_dir):
    prefix = "\n".join(rules.prompt_texts())
    return views.headed_documents(spark, sf_dir).select(
        "doc_id", rules.prompt(F.col("raw"), prefix, "<end>").alias("prompt")
    )


@registered(
    sql.with_ctes(
        {"lists": sql.NUMBERED}, f"SELECT doc_id, {sql.numbered('raw')} AS formatted FROM lists"
    )
)
def numbered_format(spark, sf_dir):
    return views.numbered_documents(spark, sf_dir).select(
        "doc_id", rules.format_numbered(F.col("raw")).alias("formatted")
    )


@registered(
    sql.with_ctes(
        {"headed": sql.HEADED, **sql.rule_based_ctes("headed", "doc_id", "raw")},
        "SELECT doc_id, standardized, ok FROM standardized",
    )
)
def standardize_rule_based(spark, sf_dir):
    headed = views.headed_documents(spark, sf_dir)
    return standardize.standardize_by_rule(headed, "raw").select(
        "doc_id",
        F.col("standardized_job_description").alias("standardized"),
        F.col("standardize_ok").alias("ok"),
    )


@registered(
    sql.with_ctes(
        {
            **sql.CLEANING,
            "keyed": "SELECT *, rec_id || ' ' || year || ' ' || ord AS key FROM postings",
            **sql.rule_based_ctes("keyed", "key", "position_responsibilities"),
        },
        """SELECT year, count(*) AS processed, count(*) FILTER (ok) AS success,
                  count(*) FILTER (NOT ok) AS failed
           FROM (SELECT year, ok FROM keyed JOIN (SELECT DISTINCT key, ok FROM standardized) USING (key))
           GROUP BY year""",
    )
)
def standardize_stats(spark, sf_dir):
    done = standardize.standardize_by_rule(views.postings(spark, sf_dir))
    return standardize.standardize_counts(done)


@registered(
    sql.with_ctes(
        {
            "headed": sql.HEADED,
            **sql.duty_ctes("headed", "doc_id", "raw"),
            "bodies": "SELECT doc_id, substr(duty, 1, 1024) AS body FROM duties",
        },
        f"SELECT doc_id, {sql.numbered('body')} AS standardized FROM bodies",
    )
)
def standardize_with_model(spark, sf_dir):
    """The model adapter with a model that repeats the posting of its prompt."""
    prefix = "\n".join(rules.prompt_texts())

    def factory():
        return lambda prompts: [prompt[len(prefix) :] for prompt in prompts]

    headed = views.headed_documents(spark, sf_dir)
    return standardize.standardize(headed, factory, prefix, text_column="raw").select(
        "doc_id", F.col("standardized_job_description").alias("standardized")
    )


@registered(
    sql.with_ctes(
        sql.CLEANING,
        f"""SELECT year, rec_id, ord, {sql.is_invalid('position_responsibilities')} AS invalid
            FROM postings""",
    )
)
def invalid_inputs(spark, sf_dir):
    invalid = rules.is_invalid_input(F.col("position_responsibilities"))
    return views.postings(spark, sf_dir).select("year", "rec_id", "ord", invalid.alias("invalid"))


# --- vectors and matching -----------------------------------------------------


@registered(
    f"""SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(v[i] / {sql.norm('v')}, 6) AS value
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
                     unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""
)
def l2_normalize(spark, sf_dir):
    unit = vectors.l2_normalize(F.col("embedding"))
    return (
        views.table(spark, sf_dir, "embeddings")
        .select("vec_id", F.posexplode(unit).alias("dim", "value"))
        .withColumn("value", F.round("value", 6))
    )


@registered(
    sql.with_ctes(
        {
            "docs": "SELECT doc_id, text FROM documents",
            **sql.profile_ctes("profiled", "docs", "text"),
        },
        f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS dim, round(v[i], 6) AS value
            FROM (SELECT doc_id, v, unnest(range(1, 27)) AS i FROM profiled
                  WHERE NOT {sql.is_invalid('text')})""",
    )
)
def embed_texts(spark, sf_dir):
    """The embedding adapter with the letter-profile stand-in."""
    text = F.col("text")
    valid = F.when(~rules.is_invalid_input(text), text)
    return (
        views.documents(spark, sf_dir)
        .select("doc_id", models.embedded(valid, lambda: models.letter_profile()).alias("v"))
        .select("doc_id", F.posexplode("v").alias("dim", "value"))
        .withColumn("value", F.round(F.col("value").cast("double"), 6))
    )


def _dictionary(spark, sf_dir):
    """A dimension of 160 rows at most, held once for its several uses."""
    return dictionary.prepare_dictionary(views.occupations(spark, sf_dir)).cache()


@registered(
    sql.with_ctes(
        {"jobs": sql.JOBS, "occ": sql.OCCUPATIONS, **sql.search_ctes()},
        "SELECT doc_id, CAST(rank AS INTEGER) AS rank, CAST(occ_idx AS INTEGER) AS occ_idx, score FROM top",
    )
)
def cosine_topk(spark, sf_dir):
    found = add_candidates(views.jobs(spark, sf_dir), _dictionary(spark, sf_dir), NEAR)
    return candidate_rows(found, "doc_id")


@registered(
    sql.with_ctes(
        {"jobs": sql.JOBS, "occ": sql.OCCUPATIONS, **sql.search_ctes()},
        "SELECT doc_id, CAST(rank AS INTEGER) AS rank, CAST(occ_idx AS INTEGER) AS occ_idx, score FROM top",
    )
)
def cosine_topk_blocks(spark, sf_dir):
    """The same search with blocks of 16 KB: no task holds the dictionary whole."""
    found = add_candidates(views.jobs(spark, sf_dir), _dictionary(spark, sf_dir), NEAR, 16 * 1024)
    return candidate_rows(found, "doc_id")


def _matched(spark, sf_dir, settings=NEAR, **options):
    return match(views.jobs(spark, sf_dir), _dictionary(spark, sf_dir), settings, **options)


@registered(sql.with_ctes(sql.match_ctes(min_score=0.5), "SELECT * FROM matched"))
def match_top1(spark, sf_dir):
    return _matched(spark, sf_dir)


@registered(sql.with_ctes(sql.match_ctes(min_score=0.55), "SELECT * FROM matched"))
def match_default_threshold(spark, sf_dir):
    return _matched(spark, sf_dir, MatchSettings())


@registered(
    sql.with_ctes(sql.match_ctes(min_score=0.3, rules=views.RULES), "SELECT * FROM matched")
)
def match_suspicious(spark, sf_dir):
    settings = MatchSettings(min_embed_score=0.3, suspicious_occupations=views.RULES)
    return _matched(spark, sf_dir, settings)


RERANK = MatchSettings(
    min_embed_score=0.4,
    rerank_min_embed_score=0.45,
    rerank_score_threshold=0.01,
    suspicious_occupations=views.RULES,
)


@registered(
    sql.with_ctes(
        sql.match_ctes(min_score=0.4, rules=views.RULES, rerank=(0.01, 0.45)),
        "SELECT * FROM matched",
    )
)
def match_rerank(spark, sf_dir):
    return _matched(spark, sf_dir, RERANK, rerank=lambda: models.word_overlap())


@registered(
    sql.with_ctes(
        sql.match_ctes(min_score=0.5),
        """SELECT year, count(*) AS total, count(*) FILTER (is_match = '是') AS matched,
                  count(*) FILTER (is_match = '否') AS unmatched FROM matched GROUP BY year""",
    )
)
def match_stats(spark, sf_dir):
    return match_counts(_matched(spark, sf_dir))


# --- crosswalk ----------------------------------------------------------------


def _final(spark, sf_dir, details=True, best_only=False):
    return crosswalk.add_crosswalk(
        _matched(spark, sf_dir),
        views.mapping(spark, sf_dir),
        views.detail(spark, sf_dir) if details else None,
        best_only=best_only,
    )


@registered(sql.with_ctes(sql.final_ctes(0.5), "SELECT * FROM final"))
def crosswalk_join(spark, sf_dir):
    return _final(spark, sf_dir)


@registered(sql.with_ctes(sql.final_ctes(0.5, details=False), "SELECT * FROM final"))
def crosswalk_join_no_details(spark, sf_dir):
    return _final(spark, sf_dir, details=False)


@registered(
    sql.with_ctes(sql.final_ctes(0.5, mapping="best_mapping"), "SELECT * FROM final")
)
def crosswalk_best_only(spark, sf_dir):
    return _final(spark, sf_dir, best_only=True)


@registered(
    sql.with_ctes(
        {**sql.match_ctes(min_score=0.5), "mapping": sql.MAPPING},
        """SELECT total, failed, failed / total AS failure_rate, failed / total > 0.05 AS alarm
           FROM (SELECT count(*) AS total, count(*) FILTER (match_Level4_Code <> ''
                   AND match_Level4_Code NOT IN (SELECT dadian_code FROM mapping)) AS failed
                 FROM matched) WHERE total > 0""",
    )
)
def join_failure_rate(spark, sf_dir):
    report = crosswalk.join_report(_matched(spark, sf_dir), views.mapping(spark, sf_dir))
    return report.withColumn("failed", F.col("failed").cast("long"))


# --- reports ------------------------------------------------------------------

FINAL = sql.final_ctes(0.5)


@registered(
    sql.with_ctes(
        FINAL, "SELECT year, level1, count(*) AS cnt FROM final GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2"
    )
)
def count_by_year_level1(spark, sf_dir):
    return analytics.count_by_level1(_final(spark, sf_dir))


@registered(
    sql.with_ctes(
        FINAL,
        """SELECT year, level1, count(*) AS cnt FROM final WHERE year = '2021'
           GROUP BY 1, 2 ORDER BY 3 DESC""",
    )
)
def count_by_year_level1_one_year(spark, sf_dir):
    return analytics.count_by_level1(analytics.of_year(_final(spark, sf_dir), "2021"))


@registered(
    sql.with_ctes(
        FINAL,
        """SELECT year, onet_title, count(*) AS cnt FROM final WHERE onet_code LIKE '15-%'
           GROUP BY 1, 2 ORDER BY 1, 3 DESC""",
    )
)
def onet_prefix_trend(spark, sf_dir):
    return analytics.occupation_trend(_final(spark, sf_dir), "15-")


@registered(
    sql.with_ctes(
        FINAL,
        """SELECT year, is_match, count(*) AS cnt,
                  CAST(sum(CAST(embed_score AS DECIMAL(18, 6))) AS DOUBLE) / count(embed_score) AS avg_score
           FROM final GROUP BY 1, 2 ORDER BY 1, 2""",
    )
)
def match_quality(spark, sf_dir):
    return analytics.match_quality(_final(spark, sf_dir))


@registered(
    sql.with_ctes(
        sql.match_ctes(min_score=0.5),
        """SELECT doc_id, match_occupation, embed_score, is_match FROM matched
           ORDER BY md5('review' || doc_id), doc_id LIMIT 20""",
    )
)
def sample_review(spark, sf_dir):
    chosen = _matched(spark, sf_dir).select("doc_id", "match_occupation", "embed_score", "is_match")
    return analytics.review_sample(chosen, "doc_id", 20, "review")


@registered(
    sql.with_ctes(
        {**sql.CLEANING, "counted": "SELECT year, count(*) AS c FROM clean GROUP BY 1"},
        """SELECT year, p AS prev_rows, c AS curr_rows, abs(c - p) AS difference,
                  CASE WHEN c = p THEN 'equal' ELSE 'differs' END AS status
           FROM counted JOIN (SELECT year, count(*) AS p FROM postings GROUP BY 1) USING (year)""",
    )
)
def stage_reconciliation(spark, sf_dir):
    posted = views.postings(spark, sf_dir)
    return quality.reconcile(posted, clean.clean_postings(posted, order_by=ORDER))


# --- stored stages ------------------------------------------------------------


@registered(sql.with_ctes(FINAL, "SELECT * FROM final"))
def partitioned_roundtrip(spark, sf_dir):
    root = fresh_folder(spark, "final")
    datasets.write_final(_final(spark, sf_dir), root)
    return datasets.read_dataset(spark, root)


@registered(sql.with_ctes(sql.CLEANING, "SELECT * FROM clean"))
def compact_year(spark, sf_dir):
    """Every stored year is compacted; the compacted files are read back."""
    root, merged = fresh_folder(spark, "stored"), fresh_folder(spark, "merged")
    cleaned = clean.clean_postings(views.postings(spark, sf_dir), order_by=ORDER)
    datasets.write_dataset(cleaned, root)
    for year in datasets.years_in(datasets.read_dataset(spark, root)):
        datasets.compact_year(spark, root, year, merged)
    return spark.read.parquet(f"{merged}/*_final.parquet")


@registered(
    sql.with_ctes(
        sql.CLEANING,
        """SELECT ord, rec_id, position_responsibilities, year, origin FROM postings
           UNION ALL SELECT item_id, 'b', text, NULL, NULL FROM benchmark""",
    )
)
def align_schema_union(spark, sf_dir):
    first = views.postings(spark, sf_dir)
    other = views.table(spark, sf_dir, "benchmark").select(
        F.lit(None).alias("origin"),
        F.col("text").alias("position_responsibilities"),
        F.col("item_id").cast("string").alias("ord"),
        F.lit("b").alias("rec_id"),
        F.lit(None).cast("int").alias("year"),
    )
    return datasets.union_aligned(first, other)


TEXT_POSTINGS = """SELECT CAST(ord AS VARCHAR) AS ord, rec_id, position_responsibilities, year, origin
                   FROM """


@registered(sql.with_ctes(sql.CLEANING, TEXT_POSTINGS + "postings"))
def csv_roundtrip(spark, sf_dir):
    folder = fresh_folder(spark, "csv")
    datasets.write_csv(views.postings(spark, sf_dir), folder)
    return read_postings(spark, f"{folder}/*/*.csv", year_from="folder").drop(
        *clean.ORDER_COLUMNS
    )


def _as_csv(df, path):
    """A file of its own, such as a reference sheet."""
    df.coalesce(1).write.options(header="true", quote='"', escape='"').csv(path)
    return path


@registered(sql.with_ctes(sql.CLEANING, TEXT_POSTINGS + "postings"))
def csv_split_files(spark, sf_dir):
    """One file per year whose cells hold line breaks, read by many tasks in ranges of 128 KB."""
    folder = fresh_folder(spark, "csv")
    datasets.write_csv(views.postings(spark, sf_dir).repartition("year"), folder)
    ranges = spark.newSession()
    ranges.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    ranges.conf.set("spark.sql.files.openCostInBytes", "128k")
    return read_postings(ranges, f"{folder}/*/*.csv", year_from="folder").drop(*clean.ORDER_COLUMNS)


@registered(sql.with_ctes(sql.CLEANING, TEXT_POSTINGS + "postings WHERE year IN ('2016', '2021')"))
def yearly_files(spark, sf_dir):
    """Two years found by the template of their names, lines of cells without breaks in mind or not."""
    folder = fresh_folder(spark, "raw")
    posted = views.postings(spark, sf_dir)
    columns = [name for name in posted.columns if name != "year"]
    for year in ("2016", "2019", "2021"):
        of_year = posted.where(F.col("year") == year).select(*columns)
        of_year.write.options(
            header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(files.input_path(folder, year))
    paths = [files.input_path(folder, year) for year in ("2016", "2021")]
    return read_postings(spark, paths, year_from="folder").drop(*clean.ORDER_COLUMNS)


MALFORMED = {
    "postings": sql.POSTINGS,
    "good": "SELECT * FROM postings WHERE ord % 7 <> 3",
    "firsts": sql.FIRSTS.replace("FROM postings", "FROM good"),
    "bad": "SELECT year, count(*) AS quarantined FROM postings WHERE ord % 7 = 3 GROUP BY year",
    "counts": f"""SELECT year, count(*) AS firsts, count(*) FILTER ({sql.EFFECTIVE_LEN} >= 30) AS kept
                  FROM firsts GROUP BY year""",
}


@registered(
    sql.with_ctes(
        MALFORMED,
        """SELECT year, total, kept, CAST(good - firsts AS BIGINT) AS dropped_dup,
                  CAST(firsts - kept AS BIGINT) AS dropped_short, coalesce(quarantined, 0) AS quarantined
           FROM counts JOIN (SELECT year, count(*) AS total FROM postings GROUP BY 1) USING (year)
             JOIN (SELECT year, count(*) AS good FROM good GROUP BY 1) USING (year) LEFT JOIN bad USING (year)""",
    )
)
def malformed_rows(spark, sf_dir):
    """A seventh of the rows has a cell too many: one pass stores all rows, and all are accounted for."""
    folder, store = fresh_folder(spark, "csv"), fresh_folder(spark, "postings")
    columns = ["ord", "rec_id", "position_responsibilities", "origin"]
    posted = views.postings(spark, sf_dir)
    cells = F.to_csv(F.struct(*columns), {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.concat(cells, F.when(F.col("ord") % 7 == 3, ",one more").otherwise(""))
    lines = posted.select("year", F.lit(1).alias("n"), "ord", line.alias("value"))
    header = posted.select("year").distinct().select("year", F.lit(0), F.lit(0), F.lit(",".join(columns)))
    ordered = lines.union(header).repartition("year").sortWithinPartitions("year", "n", "ord")
    ordered.select("year", "value").write.partitionBy("year").text(folder)
    files.ingest_postings(spark, f"{folder}/*/*.txt", store, year_from="folder")
    counts = clean.clean_counts(files.ingested(spark, store))
    bad = files.quarantined(spark, store).groupBy("year").agg(F.count("bad_record").alias("quarantined"))
    found = counts.join(bad, "year", "left").fillna(0, ["quarantined"])
    return found.select(
        "year", (F.col("total") + F.col("quarantined")).alias("total"), "kept", "dropped_dup", "dropped_short", "quarantined"
    )


@registered(
    sql.with_ctes(
        {"mapping": sql.MAPPING, "detail": sql.DETAIL},
        """SELECT dadian_code, onet_code, onet_title, similarity_score, confidence, Description AS description,
                  All_Tasks AS tasks FROM mapping LEFT JOIN detail ON soc = onet_code""",
    )
)
def reference_tables(spark, sf_dir):
    """Crosswalk and details written as sheets and loaded from them."""
    folder = fresh_folder(spark, "sheets")
    mapping = files.read_mapping(spark, _as_csv(views.mapping(spark, sf_dir), f"{folder}/mapping.csv"))
    detail = files.read_reference_table(spark, _as_csv(views.detail(spark, sf_dir), f"{folder}/detail.csv"))
    joined = sizing.left_join(sizing.dimension(mapping), sizing.dimension(detail), ("onet_code", "O*NET-SOC Code"))
    return joined.select(
        "dadian_code", "onet_code", "onet_title", "similarity_score", "confidence",
        F.col("Description").alias("description"), F.col("All_Tasks").alias("tasks"),
    )


@registered(
    sql.with_ctes(
        {"entries": sql.PART_OCCUPATIONS},
        f"""SELECT CAST(row_number() OVER (ORDER BY occ_idx) - 1 AS INTEGER) AS occ_idx, Level4_Name, Level2_Code,
                   {sql.joined_text('Level4_Name', 'main_task')} AS occupation_text FROM entries""",
    )
)
def dictionary_sheet(spark, sf_dir):
    """The dictionary loaded from its sheet, numbered in file order."""
    sheet = views.part_occupations(spark, sf_dir).orderBy("occ_idx").drop("occ_idx")
    path = _as_csv(sheet, fresh_folder(spark, "sheet"))
    entries = dictionary.prepare_dictionary(files.read_occupations(spark, path))
    return entries.select("occ_idx", "Level4_Name", "Level2_Code", "occupation_text")


@registered(sql.with_ctes(sql.CLEANING, "SELECT year, rec_id, ord FROM clean ORDER BY year, ord, rec_id LIMIT 50"))
def first_rows(spark, sf_dir):
    """The first rows in an explicit order, as for a smoke run; the spot check sees as many."""
    cleaned = clean.clean_postings(views.postings(spark, sf_dir), order_by=ORDER)
    first = analytics.first_rows(cleaned, ("year", "ord", "rec_id"), 50)
    return analytics.spot_check(first, ["year", "rec_id", "ord"], 50)


# --- incremental arrival ------------------------------------------------------


@registered(sql.with_ctes(sql.CLEANING, "SELECT * FROM clean"))
def incremental_clean(spark, sf_dir):
    """Documents and first turns arrive in several micro-batches, then all later turns."""
    inbox, out, state = (fresh_folder(spark, name) for name in ("inbox", "out", "state"))
    posted, turns = views.document_postings(spark, sf_dir), views.turn_postings(spark, sf_dir)
    passes = (
        datasets.union_aligned(posted, turns.where("ord < 2")),
        datasets.align_to_schema(turns.where("ord >= 2"), posted.schema),
    )
    for arriving in passes:
        # Copies share a file: the order of files within one pass is not defined.
        arriving.repartition(8, "rec_id").write.mode("append").parquet(inbox)
        stream = (
            spark.readStream.schema(posted.schema).option("maxFilesPerTrigger", 4).parquet(inbox)
        )
        arrivals.start_clean(stream, out, state, order_by=ORDER).awaitTermination()
    return datasets.read_dataset(spark, out).drop("batch")


@registered(sql.with_ctes(sql.CLEANING, TEXT_POSTINGS + "clean"))
def ingest_and_refresh(spark, sf_dir):
    """CSV files are ingested as a stream, then cleaned in their file order."""
    inbox, raw, state, out = (
        fresh_folder(spark, name) for name in ("inbox", "raw", "state", "out")
    )
    posted = views.postings(spark, sf_dir)
    ordered = posted.repartitionByRange("year", "ord").sortWithinPartitions("year", "ord")
    datasets.write_csv(ordered, inbox)
    columns = [name for name in posted.columns if name != "year"]
    stream = arrivals.stream_postings(spark, inbox, columns, 8, year_from="folder")
    arrivals.start_append(stream, raw, state).awaitTermination()
    arrivals.refresh_years(spark, raw, out)
    return datasets.read_dataset(spark, out).drop(*clean.ORDER_COLUMNS)


@registered(sql.with_ctes(sql.CLEANING, TEXT_POSTINGS + "clean"))
def late_arrivals(spark, sf_dir):
    """Conversation turns arrive for years that were cleaned with documents only."""
    inbox, raw, state, out = (
        fresh_folder(spark, name) for name in ("inbox", "raw", "state", "out")
    )
    passes = views.document_postings(spark, sf_dir), views.turn_postings(spark, sf_dir)
    for number, arriving in enumerate(passes):
        ordered = arriving.repartitionByRange("year", "ord").sortWithinPartitions("year", "ord")
        datasets.write_csv(ordered, f"{inbox}/{number}")
        columns = [name for name in arriving.columns if name != "year"]
        stream = arrivals.stream_postings(spark, inbox, columns, 8, year_from="folder")
        arrivals.start_append(stream, raw, state).awaitTermination()
        arrivals.refresh_years(spark, raw, out)
    return datasets.read_dataset(spark, out).drop(*clean.ORDER_COLUMNS)


REPLACED = {
    "before": sql.POSTINGS,
    "postings": """SELECT ord, CASE WHEN year = '2019' THEN 'new ' || rec_id ELSE rec_id END AS rec_id,
                     position_responsibilities, year, origin FROM before""",
    "firsts": sql.FIRSTS,
    "clean": sql.CLEAN,
}


@registered(sql.with_ctes(REPLACED, "SELECT * FROM clean"))
def replaced_file(spark, sf_dir):
    """The files of a finished year are replaced by others with as many rows: the year is cleaned again."""
    raw, out = fresh_folder(spark, "raw"), fresh_folder(spark, "out")
    posted = views.postings(spark, sf_dir)
    datasets.write_dataset(posted, raw)
    arrivals.refresh_years(spark, raw, out, order_by=ORDER)
    renamed = posted.where("year = '2019'").withColumn("rec_id", F.concat(F.lit("new "), "rec_id"))
    datasets.write_dataset(renamed, raw)
    arrivals.refresh_years(spark, raw, out, order_by=ORDER)
    return datasets.read_dataset(spark, out)


@registered(sql.with_ctes(sql.match_ctes(min_score=0.5), "SELECT * FROM matched"))
def match_resumable(spark, sf_dir):
    """Matching in micro-batches of stored files, each committed on its own."""
    inbox, out, state = (fresh_folder(spark, name) for name in ("inbox", "out", "state"))
    datasets.write_dataset(views.jobs(spark, sf_dir), inbox, rebalance=False)
    entries = _dictionary(spark, sf_dir)
    arrivals.run_resumable(spark, inbox, out, state, lambda df: match(df, entries, NEAR), 5)
    return datasets.read_dataset(spark, out)


@registered(sql.with_ctes(sql.CLEANING, "SELECT * FROM clean WHERE year > '2019'"))
def skip_finished_years(spark, sf_dir):
    """The first five years are already stored, the others remain to be done."""
    root = fresh_folder(spark, "done")
    cleaned = clean.clean_postings(views.postings(spark, sf_dir), order_by=ORDER)
    datasets.write_dataset(cleaned.where(F.col("year") <= "2019"), root)
    return datasets.skip_finished_years(cleaned, root)


@registered(
    sql.with_ctes(
        {
            "entries": sql.PART_OCCUPATIONS,
            "texts": f"""SELECT 'edited ' || Level4_Code AS Level4_Code, CAST(occ_idx AS INTEGER) AS occ_idx,
                           {sql.joined_text('Level4_Name', 'main_task')} AS occupation_text
                         FROM entries""",
            **sql.profile_ctes("profiled", "texts", "occupation_text"),
        },
        """SELECT occ_idx, Level4_Code, occupation_text, CAST(i - 1 AS INTEGER) AS dim, round(v[i], 6) AS value
           FROM (SELECT *, unnest(range(1, 27)) AS i FROM profiled)""",
    )
)
def vector_cache_refresh(spark, sf_dir):
    """Later calls find the vectors of the first one, and the codes of their own sheet."""
    cache = fresh_folder(spark, "cache")
    entries = dictionary.prepare_dictionary(views.part_occupations(spark, sf_dir))
    edited = entries.withColumn("Level4_Code", F.concat(F.lit("edited "), "Level4_Code"))
    for sheet in (entries, entries, edited):
        cached = dictionary.cached_dictionary(
            sheet, lambda: models.letter_profile(), cache, "letters"
        )
    return cached.select(
        "occ_idx", "Level4_Code", "occupation_text", F.posexplode("embedding").alias("dim", "value")
    ).withColumn("value", F.round(F.col("value").cast("double"), 6))


# --- end to end ---------------------------------------------------------------

CLASSIFIED = {
    **sql.CLEANING,
    "keyed": "SELECT *, year || ' ' || rec_id AS key FROM clean",
    **sql.rule_based_ctes("keyed", "key", "position_responsibilities"),
    "entries": sql.PART_OCCUPATIONS,
    "occ_texts": f"SELECT *, {sql.joined_text('Level4_Name', 'main_task')} AS occupation_text FROM entries",
    **sql.profile_ctes("occ_vectors", "occ_texts", "occupation_text"),
    "occ": "SELECT * EXCLUDE (occupation_text) FROM occ_vectors",
    "job_texts": """SELECT key, year, rec_id, ord, position_responsibilities, origin,
                      standardized AS standardized_job_description, ok AS standardize_ok
                    FROM keyed JOIN standardized USING (key)""",
    **sql.profile_ctes("job_vectors", "job_texts", "standardized_job_description"),
    "jobs": "SELECT * EXCLUDE (v), v AS q FROM job_vectors",
    **sql.search_ctes("key"),
    **sql.decision_ctes(
        "year, rec_id, ord, position_responsibilities, origin, standardized_job_description, "
        "standardize_ok",
        key="key",
        min_score=0.8,
        rerank=(0.0, 0.85),
    ),
    **sql.crosswalk_ctes(),
}


def _job(spark, sf_dir):
    entries = dictionary.prepare_dictionary(views.part_occupations(spark, sf_dir))
    return Job(
        dictionary=dictionary.embedded_dictionary(
            entries, lambda: models.letter_profile()
        ).cache(),
        mapping=views.mapping(spark, sf_dir),
        detail=views.detail(spark, sf_dir),
        embed=lambda: models.letter_profile(),
        rerank=lambda: models.word_overlap(),
        settings=MatchSettings(
            min_embed_score=0.8, rerank_min_embed_score=0.85, rerank_score_threshold=0.0
        ),
        order_by=ORDER,
    )


@registered(sql.with_ctes(CLASSIFIED, "SELECT * FROM final"))
def classify_end_to_end(spark, sf_dir):
    return classify(views.postings(spark, sf_dir), _job(spark, sf_dir))


@registered(sql.with_ctes(CLASSIFIED, "SELECT * FROM final"))
def classify_stored(spark, sf_dir):
    """The same, with every stage written and read back."""
    store = fresh_folder(spark, "stages")
    return classify(views.postings(spark, sf_dir), _job(spark, sf_dir), store=store)


def _letters_until(mark):
    """The stand-in embedding, lost at the first text whose hash begins with ``mark``."""

    def factory():
        embed = models.letter_profile()

        def run(texts):
            if any(hashlib.md5(text.encode()).hexdigest().startswith(mark) for text in texts):
                raise RuntimeError("model lost")
            return embed(texts)

        return run

    return factory


@registered(sql.with_ctes(CLASSIFIED, "SELECT * FROM final"))
def classify_resumed(spark, sf_dir):
    """The embedding model is lost in the middle; the second run asks only what has no answer yet."""
    store, job = fresh_folder(spark, "stages"), _job(spark, sf_dir)
    posted = views.postings(spark, sf_dir)
    try:
        classify(posted, replace(job, embed=_letters_until("ff"), answer_batch=100), store=store)
    except Exception as lost:  # the model's own error comes through Spark
        if "model lost" not in str(lost):
            raise
    return classify(posted, job, store=store)
