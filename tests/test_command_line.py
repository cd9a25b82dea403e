"""The command line over small files, from raw CSV to merged years."""

import os

import pytest

from vocatio import __main__ as command
from vocatio.sources.datasets import read_dataset

TEXT = "word man writes many words for a living every day"


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(content)
    return path


def test_from_raw_files_to_merged_years(spark, folder, capsys):
    header = "rec_id,position_responsibilities\n"
    for year in (2020, 2021):
        rows = f"a,{TEXT}\na,{TEXT}\nb,short\n"
        put(f"{folder}/raw/recruitment_infos_content_{year}.csv", header + rows)
    occupations = put(
        f"{folder}/o.csv",
        "Level1_Code,Level1_Name,Level4_Code,Level4_Name,main_task\n"
        "1,Class,1-1-1-1,word man,writes many words\n2,Zoo,2-1-1-1,zzz,zz\n",
    )
    mapping = put(
        f"{folder}/m.csv",
        "dadian_code,onet_code,onet_title,similarity_score,confidence\n1-01-01-01,15-1.00,T,0.5,high\n",
    )
    detail = put(f"{folder}/d.csv", "O*NET-SOC Code,Description,All_Tasks\n15-1.00,D,K\n")
    common = ["--store", f"{folder}/store", "--raw", f"{folder}/raw", "--occupations", occupations]
    common += ["--mapping", mapping, "--detail", detail, "--dry-run"]
    command.main(["classify", *common, "--years", "2020"])
    final = read_dataset(spark, f"{folder}/store/crosswalk")
    assert [(r["year"], r["rec_id"], r["onet_description"]) for r in final.collect()] == [
        ("2020", "a", "D")
    ]
    counted = read_dataset(spark, f"{folder}/store/clean_counts").collect()
    assert [(r["year"], r["total"]) for r in counted] == [("2020", 3)]
    counted = read_dataset(spark, f"{folder}/store/standardize_counts").collect()
    assert [(r["year"], r["processed"]) for r in counted] == [("2020", 1)]
    command.main(["classify", *common, "--skip-finished"])
    assert read_dataset(spark, f"{folder}/store/crosswalk").count() == 2
    assert read_dataset(spark, f"{folder}/store/clean_counts").count() == 2
    command.main(["classify", *common, "--skip-finished"])
    assert "nothing to do" in capsys.readouterr().out
    # Another file in place of one, with as many rows, is seen.
    put(f"{folder}/raw/recruitment_infos_content_2021.csv", header + f"z,{TEXT}\nz,{TEXT}\ny,short\n")
    command.main(["classify", *common, "--skip-finished"])
    final = read_dataset(spark, f"{folder}/store/crosswalk")
    assert sorted((r["year"], r["rec_id"]) for r in final.collect()) == [("2020", "a"), ("2021", "z")]
    put(f"{folder}/raw/recruitment_infos_content_2021.csv", header + f"z,{TEXT},more\nx,{TEXT}\n")
    with pytest.raises(SystemExit, match="malformed"):
        command.main(["classify", *common, "--skip-finished"])
    command.main(["classify", *common, "--skip-finished", "--bad-rows", "skip"])
    assert "2021: 1 rows with too many cells" in capsys.readouterr().out
    command.main(["classify", *common, "--only", "crosswalk"])
    assert read_dataset(spark, f"{folder}/store/crosswalk").count() == 2
    command.main(["merge", "--store", f"{folder}/store", "--out", f"{folder}/out", "--years", "2020", "1999"])
    printed = capsys.readouterr().out
    assert "2020: 1 rows" in printed and "1999: skipped" in printed 
    assert spark.read.parquet(f"{folder}/out/2020_final.parquet").count() == 1


def test_models_are_asked_for_unless_it_is_a_dry_run(capsys):
    with pytest.raises(SystemExit):
        command.parse(["classify", "--store", "x", "--embed", "m:e"])
    assert "--generate is needed" in capsys.readouterr().err
    chosen = command.parse(["classify", "--store", "x", "--only", "match", "--embed", "m:e", "--top-k", "3"])
    assert (chosen.top_k, chosen.min_embed_score) == (3, command.MatchSettings().min_embed_score)


def test_unknown_stage_is_refused():
    with pytest.raises(SystemExit):
        command.parse(["classify", "--store", "x", "--only", "nothing"])
