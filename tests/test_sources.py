"""Files in and out."""

import os
import pickle
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vocatio.sources import datasets, folders, manifests, postings, records

HEADER = "rec_id,position_responsibilities,city\n"


def put(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode("utf-8"))
    return path


def texts(df):
    rows = df.orderBy("ord_file", "ord_block", "ord_pos").collect()
    return [(r["rec_id"], r["position_responsibilities"], r["city"]) for r in rows]


def test_cells_of_all_kinds(spark, folder):
    put(
        folder,
        "recruitment_infos_content_2021.csv",
        b"\xef\xbb\xbf"
        + (
            HEADER
            + 'a,"line one\nline ""two"", end",x\n'
            + "b, padded ,y\n"
            + "\n"
            + "c\n"
            + "d,NA,z\n"
            + "e,one,two,three\n"
            + 'f,"back\\slash",\n'
        ).encode()
        + b"g,bad \xff byte,w\n",
    )
    df = postings.read_postings(spark, f"{folder}/*.csv", bad_rows="skip")
    assert df.columns == [*HEADER.strip().split(","), "year", "ord_file", "ord_block", "ord_pos"]
    assert texts(df) == [
        ("a", 'line one\nline "two", end', "x"),
        ("b", " padded ", "y"),
        ("c", None, None),
        ("d", "NA", "z"),
        ("f", "back\\slash", None),
        ("g", "bad � byte", "w"),
    ]
    assert {r["year"] for r in df.collect()} == {"2021"}
    with pytest.raises(Exception, match="too many cells"):
        postings.read_postings(spark, f"{folder}/*.csv").count()
    marked = postings.read_postings(spark, f"{folder}/*.csv", bad_rows="mark")
    row = marked.where("bad_record IS NOT NULL").first()
    assert (row["year"], row["rec_id"], row["bad_record"]) == ("2021", None, "e,one,two,three")
    assert marked.count() == 7


def test_an_empty_file_is_an_error(spark, folder):
    put(folder, "p_2020.csv", HEADER + "a,t,x\n")
    put(folder, "p_2021.csv", "")
    with pytest.raises(ValueError, match="empty"):
        postings.read_postings(spark, f"{folder}/*.csv")


RANGES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def small_ranges(spark):
    def cut(size):
        for name in RANGES:
            spark.conf.set(name, str(size))

    yield cut
    for name in RANGES:
        spark.conf.unset(name)


def awkward_cells(draw):
    return draw.choice(
        ["", "plain", "two\nlines", 'say ""so""', "a,b", "\r\n\r\n", '""', "\n", 'end""', "x" * 90, '""\n"",""\n', "ümlaut 日本"]
    )


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_ranges_cut_anywhere_give_the_records_of_a_whole_file(spark, folder, small_ranges, line_end):
    """Quotes, doubled quotes, line ends and whole cells across borders; a file of one range is the measure."""
    draw = random.Random(11)
    rows, expected = [], []
    for i in range(400):
        cells = [awkward_cells(draw) for _ in range(2)]
        quoted = [f'"{c}"' if draw.random() < 0.5 or any(x in c for x in ',"\r\n') else c for c in cells]
        if i % 29 == 0:
            quoted[1] = 'stray " quote" in a plain cell'
            cells[1] = quoted[1].replace('"', '""')
        rows.append(",".join([f"k{i}", *quoted]) + line_end + (line_end if i % 17 == 0 else ""))
        expected.append((f"k{i}", *(c.replace('""', '"') for c in cells)))
    put(folder, "p_2020.csv", ("\ufeff" + HEADER.replace("\n", line_end) + "".join(rows)).encode())
    put(folder, "p_2021.csv", "position_responsibilities,rec_id\nother,z")
    whole = sorted(texts(postings.read_postings(spark, folder).fillna("")))
    assert whole == sorted([*expected, ("z", "other", "")])
    for size in (4000, 1000, 300):
        small_ranges(size)
        found = postings.read_postings(spark, folder).fillna("")
        assert sorted(texts(found)) == whole
        in_order = [i for i, _, _ in texts(found) if i != "z"]
        assert in_order == [f"k{i}" for i in range(400)]
    assert found.select("ord_block").distinct().count() > 5


def test_small_ranges_share_tasks(spark, folder, small_ranges):
    """Tasks number as the bytes ask for, and what each is sent grows by a few bytes per range."""
    put(folder, "p_2020.csv", HEADER + "".join(f'k{i},"two\nlines",x\n' for i in range(8000)))
    small_ranges(300)
    read = postings.read_postings(spark, folder)
    most = records.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    files = postings.list_files(spark, folder)
    assert records._lines(spark, files).rdd.getNumPartitions() <= most
    assert read.select("ord_block").distinct().count() > 400 > most
    assert read.count() == read.select("rec_id").distinct().count() == 8000
    inside = {("file:/" + "x" * 90, 128 * i): i % 2 == 0 for i in range(10_000)}
    assert len(pickle.dumps(records._starts(inside))) < 12 * len(inside)


def test_headers_come_from_one_scan(spark, folder):
    """As many jobs for thirty files as for two."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(name, multi_line):
        spark.sparkContext.setJobGroup(name, name)
        frame = postings.read_postings(spark, f"{folder}/{name}", multi_line=multi_line)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert frame.count() == {"few": 2, "many": 30}[name]
        return len(tracker.getJobIdsForGroup(name))

    for name, n in (("few", 2), ("many", 30)):
        for i in range(n):
            put(f"{folder}/{name}", f"p_{1980 + i}.csv", HEADER + f"a,t{i},x\n")
    assert jobs("few", True) == jobs("many", True)
    assert jobs("few", False) == jobs("many", False)


def test_files_that_end_inside_a_cell_or_have_no_header(spark, folder):
    put(f"{folder}/a", "p_2020.csv", HEADER + 'a,"never closed,x\nb,t,y\n')
    with pytest.raises(ValueError, match="not closed"):
        postings.read_postings(spark, f"{folder}/a")
    for multi_line in (True, False):
        put(f"{folder}/b{multi_line}", "p_2020.csv", "\n\n")
        with pytest.raises(ValueError, match="no header"):
            postings.read_postings(spark, f"{folder}/b{multi_line}", multi_line=multi_line)


def test_repeated_and_empty_names_of_columns(spark, folder):
    put(folder, "p_2020.csv", "a,,a,B\n1,2,3,4\n")
    for multi_line in (True, False):
        df = postings.read_postings(spark, folder, multi_line=multi_line)
        assert df.columns[:4] == ["a0", "_c1", "a2", "B"] and df.first()["_c1"] == "2"


def test_malformed_rows_are_kept_apart(spark, folder):
    put(f"{folder}/in", "p_2020.csv", HEADER + 'a,t,x\nb,"two\nlines",y,z\n')
    put(f"{folder}/in", "p_2021.csv", HEADER + "c,t,x,1,2\n")
    for multi_line in (True, False):
        store = f"{folder}/store{multi_line}"
        if not multi_line:
            put(f"{folder}/in", "p_2020.csv", HEADER + "a,t,x\nb,two lines,y,z\n")
        postings.ingest_postings(spark, f"{folder}/in", store, multi_line=multi_line)
        assert [r["rec_id"] for r in postings.ingested(spark, store).collect()] == ["a"]
        bad = postings.quarantined(spark, store).orderBy("year").collect()
        assert [r["year"] for r in bad] == ["2020", "2021"] and bad[0]["bad_record"].startswith("b,")
        # A later delivery without malformed rows replaces its year.
        put(f"{folder}/again", "p_2021.csv", HEADER + "c,t,x\n")
        postings.ingest_postings(spark, f"{folder}/again", store, multi_line=multi_line)
        assert postings.quarantined(spark, store).count() == 1 and postings.ingested(spark, store).count() == 2
        put(f"{folder}/in", "p_2020.csv", HEADER + 'a,t,x\nb,"two\nlines",y,z\n')


def test_manifests_see_replaced_files(spark, folder):
    put(f"{folder}/in", "p_2020.csv", HEADER + "a,t,x\n")
    put(f"{folder}/in", "p_2021.csv", HEADER + "a,t,x\n")
    sample(spark, [("2020", "1", 1), ("2021", "1", 1)]).write.partitionBy("year").parquet(f"{folder}/done")

    def now():
        return manifests.of_files(spark, f"{folder}/in/*.csv")

    assert manifests.finished(spark, now(), f"{folder}/m", f"{folder}/done") == set()
    manifests.store(now(), ["2020", "2021"], f"{folder}/m")
    assert manifests.finished(spark, now(), f"{folder}/m", f"{folder}/done") == {"2020", "2021"}
    put(f"{folder}/in", "p_2021.csv", HEADER + "b,t,x\n")
    os.utime(f"{folder}/in/p_2021.csv", (1, 1))
    assert manifests.finished(spark, now(), f"{folder}/m", f"{folder}/done") == {"2020"}


def test_split_files_keep_their_order(spark, folder):
    put(folder, "p_2020.csv", HEADER + "".join(f"{i},t{i},x\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = postings.read_postings(spark, folder, multi_line=False)
        assert df.select("ord_block").distinct().count() > 3
        assert [int(i) for i, _, _ in texts(df)] == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_windows_line_ends(spark, folder):
    put(folder, "x_2020.csv", (HEADER + 'a,"one\ntwo",x\nb,t,y\n').replace("\n", "\r\n"))
    found = texts(postings.read_postings(spark, folder))
    assert [(i, t.replace("\r\n", "\n"), c) for i, t, c in found] == [
        ("a", "one\ntwo", "x"),
        ("b", "t", "y"),
    ]


def test_files_with_different_headers_are_united_by_name(spark, folder):
    put(folder, "p_2019.csv", HEADER + "a,t,x\n")
    put(folder, "p_2020.csv", "city,rec_id,position_responsibilities,pay\ny,b,u,9\n")
    df = postings.read_postings(spark, folder)
    found = {r["rec_id"]: (r["year"], r["city"], r["pay"]) for r in df.collect()}
    assert found == {"a": ("2019", "x", None), "b": ("2020", "y", "9")}


def test_missing_input_and_header(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        postings.read_postings(spark, f"{folder}/none/*.csv")
    put(folder, "empty_2020.csv", "")
    with pytest.raises(ValueError, match="empty"):
        postings.read_postings(spark, folder)
    blank = put(folder, "blank_2020.csv", "\n")
    with pytest.raises(ValueError, match="no header"):
        postings.header_of(spark, blank)


def test_paths_per_year():
    path = postings.input_path("/data/", 2021)
    assert path == "/data/recruitment_infos_content_2021.csv"


def test_reference_tables(spark, folder):
    path = put(
        folder,
        "m.csv",
        "onet_code,dadian_code,similarity_score,onet_title,confidence\n15-1,1-02,0.5,T,high\n",
    )
    row = postings.read_mapping(spark, path).first()
    assert (row["dadian_code"], row["similarity_score"]) == ("1-02", 0.5)
    path = put(folder, "o.csv", "Level1_Code,main_task\n" + "01,t\n" * 5)
    table = postings.read_occupations(spark, path)
    assert [r["occ_idx"] for r in table.collect()] == [0, 1, 2, 3, 4]
    assert table.first()["Level1_Code"] == "01"


def sample(spark, rows):
    return spark.createDataFrame(rows, "year string, level1_code string, n int")


def stored(spark, root):
    return sorted(tuple(r) for r in datasets.read_dataset(spark, root).select("year", "level1_code", "n").collect())


def test_partitions_keep_text_and_reruns_replace_only_their_own(spark, folder):
    root = f"{folder}/final"
    datasets.write_final(sample(spark, [("2020", "00", 1), ("2020", "1", 2), ("2021", "01", 3)]), root)
    before = stored(spark, root)
    assert before == [("2020", "00", 1), ("2020", "1", 2), ("2021", "01", 3)]
    datasets.write_final(sample(spark, [("2021", "01", 4), ("2021", "01", 5)]), root)
    again = [("2020", "00", 1), ("2020", "1", 2), ("2021", "01", 4), ("2021", "01", 5)]
    assert stored(spark, root) == again
    datasets.write_final(sample(spark, [("2021", "01", 4), ("2021", "01", 5)]), root)
    assert stored(spark, root) == again
    only = datasets.read_dataset(spark, root, ["2020"])
    assert "PartitionFilters: [" in only._jdf.queryExecution().toString()
    assert only.count() == 2


def test_finished_years_are_skipped(spark, folder):
    df = sample(spark, [("2020", "1", 1), ("2021", "1", 2)])
    assert datasets.skip_finished_years(df, f"{folder}/out").count() == 2
    datasets.write_dataset(df.where("year = '2020'"), f"{folder}/out")
    assert [r["n"] for r in datasets.skip_finished_years(df, f"{folder}/out").collect()] == [2]


def test_compaction(spark, folder):
    root = f"{folder}/final"
    rows = [("2020", str(i % 8), i) for i in range(200)] + [("2021", "1", 1)]
    datasets.write_final(sample(spark, rows), root)
    assert datasets.compact_year(spark, root, 2020, folder) == 200
    merged = spark.read.parquet(f"{folder}/2020_final.parquet")
    assert merged.count() == 200 and "level1_code" in merged.columns
    assert len(merged.inputFiles()) == 1
    assert datasets.compact_year(spark, root, 2020, f"{folder}/many", target_file_bytes=1000) == 200
    assert len(spark.read.parquet(f"{folder}/many/2020_final.parquet").inputFiles()) > 1
    assert datasets.compact_year(spark, root, 1999, folder) is None
    assert datasets.compact_year(spark, f"{folder}/nothing", 2020, folder) is None


def test_aligned_union(spark):
    first = spark.createDataFrame([(1, "a")], "n long, s string")
    other = spark.createDataFrame([("b", "2", True)], "s string, n string, more boolean")
    both = datasets.union_aligned(first, other)
    assert both.schema == first.schema
    assert sorted(tuple(r) for r in both.collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="'n'"):
        datasets.align_to_schema(other.drop("n"), first.schema)


def test_counts_are_replaced_not_appended(spark, folder):
    counts = spark.createDataFrame([("2020", 5), ("2021", 6)], "year string, kept long")
    for _ in range(2):
        datasets.write_counts(counts, f"{folder}/counts")
    assert datasets.read_dataset(spark, f"{folder}/counts").count() == 2


def test_csv_round_trip_keeps_cells(spark, folder):
    rows = [("a", ' x "q", \n y ', "2020"), ("b", "\\", "2021"), ("c", "o,p", "2020")]
    df = spark.createDataFrame(rows, "rec_id string, t string, year string")
    datasets.write_csv(df, f"{folder}/csv")
    back = postings.read_postings(spark, f"{folder}/csv/*/*.csv", year_from="folder")
    assert sorted(tuple(r) for r in back.select("rec_id", "t", "year").collect()) == rows


def test_small_tables_are_spread_and_large_ones_are_not(spark, folder, monkeypatch):
    spark.range(100).coalesce(1).write.parquet(f"{folder}/t")
    spread = datasets.read_spread(spark, f"{folder}/t", "id")
    assert spread.count() == 100 and "Repartition" in spread._jdf.queryExecution().toString()
    monkeypatch.setattr(datasets, "SMALL_BYTES_PER_CORE", 1)
    plain = datasets.read_spread(spark, f"{folder}/t", "id")
    assert "Repartition" not in plain._jdf.queryExecution().toString()


class Session:
    """Only what ``shared_folder`` asks of a session."""

    def __init__(self, master, setting):
        self.conf = {folders.SETTING: setting} if setting else {}
        self.sparkContext = type("C", (), {"master": master, "applicationId": "app-" + master})


def test_shared_folder_comes_from_the_session():
    assert folders.shared_folder(Session("yarn", "hdfs:///x/")) == "hdfs:///x"
    assert folders.shared_folder(Session("local[2]", "/shared")) == "/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        folders.shared_folder(Session("yarn", None))
    local = folders.shared_folder(Session("local[2]", None))
    assert folders.shared_folder(Session("local[2]", None)) == local
