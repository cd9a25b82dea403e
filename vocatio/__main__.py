"""Command line: ``classify`` runs the stages, ``merge`` compacts the result.

    python -m vocatio classify --raw DIR --store DIR ...
    python -m vocatio merge --store DIR --out DIR --years 2020 2021

Models are named ``module:factory``; a factory takes no arguments and returns
the function that ``vocatio.functions.models`` describes.
"""

from __future__ import annotations

import argparse
import importlib
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from vocatio import fixed_values as fixed
from vocatio.operators.clean import clean_counts
from vocatio.operators.crosswalk import CODE_COLUMN, join_report
from vocatio.operators.dictionary import cached_dictionary, prepare_dictionary
from vocatio.operators.match import MatchSettings, match_counts
from vocatio.operators.quality import reconcile
from vocatio.operators.sizing import dimension
from vocatio.operators.standardize import standardize_counts
from vocatio.plans.classify import STAGES, Job, chosen_stages, classify
from vocatio.sources import datasets, manifests, postings

STAND_IN_EMBED = "vocatio.functions.models:letter_profile"
SETTINGS = (
    "top_k",
    "min_embed_score",
    "rerank_score_threshold",
    "rerank_min_embed_score",
    "rule_bypass_score",
)


def factory(name: str | None):
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vocatio")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("classify")
    run.add_argument("--raw", help="folder of the yearly postings files")
    run.add_argument("--store", required=True, help="folder of the stored stages")
    run.add_argument("--years", nargs="*", help="years to treat; all by default")
    run.add_argument("--bad-rows", choices=("fail", "skip"), default="fail", help="rows with too many cells")
    run.add_argument("--single-line", action="store_true", help="cells hold no line breaks: files can be split")
    run.add_argument("--start-from", choices=STAGES, default="clean")
    run.add_argument("--only", choices=STAGES)
    run.add_argument("--skip-finished", action="store_true")
    run.add_argument("--occupations", help="dictionary sheet as CSV")
    run.add_argument("--mapping", help="crosswalk CSV")
    run.add_argument("--detail", help="CSV with descriptions; none if absent")
    run.add_argument("--generate", help="text model")
    run.add_argument("--prompt-prefix", help="text before a posting; the built-in prompt if absent")
    run.add_argument("--prompt-suffix", default="", help="text after a posting")
    run.add_argument("--embed", help="embedding model")
    run.add_argument("--rerank", help="reranking model; no reranking if absent")
    run.add_argument("--dry-run", action="store_true", help="stand-ins in place of models not given")
    run.add_argument("--min-effective-len", type=int, default=fixed.MIN_EFFECTIVE_LEN)
    for name in SETTINGS:
        default = getattr(MatchSettings(), name)
        run.add_argument(f"--{name.replace('_', '-')}", type=type(default), default=default)
    run.add_argument("--rules", help="JSON file: words per suspicious occupation")
    run.add_argument("--code-column", default=CODE_COLUMN)
    run.add_argument("--best-only", action="store_true", help="one crosswalk partner per code")
    merge = commands.add_parser("merge")
    merge.add_argument("--store", required=True)
    merge.add_argument("--out", required=True)
    merge.add_argument("--years", nargs="*")
    args = parser.parse_args(arguments)
    if args.command == "classify" and not args.dry_run:
        stages = chosen_stages(args.start_from, args.only)
        for stage, name in (("standardize", "generate"), ("match", "embed")):
            if stage in stages and getattr(args, name) is None:
                parser.error(f"--{name} is needed, or --dry-run for a stand-in")
    return args


def _manifest(spark: SparkSession, args: argparse.Namespace, stages: tuple[str, ...]) -> DataFrame:
    """The input's files by year, from their listing only."""
    if stages[0] == "clean":
        return manifests.of_files(spark, postings.input_path(args.raw, "*"))
    return manifests.of_dataset(spark, _input_root(args, stages))


def _years(spark: SparkSession, args: argparse.Namespace, stages: tuple[str, ...], now: DataFrame) -> list[str]:
    """The years to treat; a finished one is one whose input files are those of the stored manifest."""
    years = args.years or sorted(row["year"] for row in now.select("year").collect())
    if args.skip_finished:
        done = manifests.finished(spark, now, _taken_root(args, stages), f"{args.store}/{stages[-1]}")
        years = sorted(set(years) - done)
    return years


def _taken_root(args: argparse.Namespace, stages: tuple[str, ...]) -> str:
    return f"{args.store}/{stages[-1]}_from_{stages[0]}"


def _input_root(args: argparse.Namespace, stages: tuple[str, ...]) -> str:
    return f"{args.store}/{STAGES[STAGES.index(stages[0]) - 1]}"


def _input(
    spark: SparkSession, args: argparse.Namespace, stages: tuple[str, ...], years: list[str]
) -> DataFrame:
    """The first stage's input; raw files are parsed once and stored with their malformed rows."""
    if stages[0] != "clean":
        return datasets.read_dataset(spark, _input_root(args, stages), years)
    root = f"{args.store}/postings"
    paths = [postings.input_path(args.raw, year) for year in years]
    postings.ingest_postings(spark, paths, root, multi_line=not args.single_line)
    bad = postings.quarantined(spark, root, years).groupBy("year").count().orderBy("year").collect()
    for row in bad:
        print(f"{row['year']}: {row['count']} rows with too many cells, kept in {root}")
    if bad and args.bad_rows == "fail":
        raise SystemExit("malformed rows; --bad-rows skip leaves them out")
    return postings.ingested(spark, root, years)


def _job(spark: SparkSession, args: argparse.Namespace, stages: tuple[str, ...]) -> Job:
    dictionary = mapping = detail = None
    model = args.embed or STAND_IN_EMBED
    embed = factory(model)
    settings = replace(MatchSettings(), **{name: getattr(args, name) for name in SETTINGS})
    if args.rules:
        with open(args.rules, encoding="utf-8") as rules:
            settings = replace(settings, suspicious_occupations=json.load(rules))
    prompt = {} if args.prompt_prefix is None else {"prompt_prefix": args.prompt_prefix}
    if "match" in stages:
        entries = prepare_dictionary(postings.read_occupations(spark, args.occupations))
        dictionary = dimension(cached_dictionary(entries, embed, f"{args.store}/vectors", model))
    if "crosswalk" in stages:
        mapping = dimension(postings.read_mapping(spark, args.mapping))
        detail = dimension(postings.read_reference_table(spark, args.detail)) if args.detail else None
    return Job(
        dictionary=dictionary,
        mapping=mapping,
        detail=detail,
        generate=factory(args.generate),
        embed=embed,
        rerank=factory(args.rerank),
        prompt_suffix=args.prompt_suffix,
        settings=settings,
        min_effective_len=args.min_effective_len,
        code_column=args.code_column,
        best_only=args.best_only,
        model_names=(
            f"{args.generate} {args.prompt_prefix} {args.prompt_suffix}", model, f"{args.rerank}"
        ),
        **prompt,
    )


def _classify(spark: SparkSession, args: argparse.Namespace) -> None:
    stages = chosen_stages(args.start_from, args.only)
    now = _manifest(spark, args, stages)
    years = _years(spark, args, stages, now)
    if not years:
        print("nothing to do: all years are finished")
        return
    job = _job(spark, args, stages)
    source = _input(spark, args, stages, years)
    classify(source, job, args.start_from, args.only, args.store, years)
    manifests.store(now, years, _taken_root(args, stages))
    if "clean" in stages:
        datasets.write_counts(clean_counts(source, job.min_effective_len), f"{args.store}/clean_counts")
        datasets.read_dataset(spark, f"{args.store}/clean_counts").orderBy("year").show()
    if "standardize" in stages:
        done = datasets.read_dataset(spark, f"{args.store}/standardize", years)
        datasets.write_counts(standardize_counts(done), f"{args.store}/standardize_counts")
        datasets.read_dataset(spark, f"{args.store}/standardize_counts").orderBy("year").show()
    for before, after in zip(stages, stages[1:]):
        print(f"rows from {before} to {after}")
        reconcile(
            datasets.read_dataset(spark, f"{args.store}/{before}"),
            datasets.read_dataset(spark, f"{args.store}/{after}"),
        ).orderBy("year").show()
    if "match" in stages:
        matched = datasets.read_dataset(spark, f"{args.store}/match")
        match_counts(matched).orderBy("year").show()
        if "crosswalk" in stages:
            join_report(matched, job.mapping, job.code_column).show()


def _merge(spark: SparkSession, args: argparse.Namespace) -> None:
    root = f"{args.store}/crosswalk"
    years = args.years or datasets.years_in(datasets.read_dataset(spark, root))
    for year in years:
        rows = datasets.compact_year(spark, root, year, args.out)
        print(f"{year}: skipped, no rows" if rows is None else f"{year}: {rows} rows")


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = SparkSession.builder.appName("vocatio").getOrCreate()
    {"classify": _classify, "merge": _merge}[args.command](spark, args)


if __name__ == "__main__":
    main()
