"""Sources, sinks, stages and jobs."""

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tonetide.plans import postprocess, reports
from tonetide.sources import readers, schemas, writers
from tonetide.sources.fingerprints import of_files, of_table
from tonetide.sources.ingest import clean_file, ingest, quarantine_report, quarantined
from tonetide.operators.ngrams import with_sanitized
from tonetide.plans.inspect import plan_text
from tonetide.sources.stages import is_complete, made_with, shared_dir, stage


@pytest.fixture
def out(spark):
    return shared_dir(spark)


def raw_comments(folder):
    Path(folder).mkdir(parents=True)
    lines = [
        {"id": "c1", "body": "Tab\there, é!", "score": 3, "created_utc": 1514700000,
         "link_id": "t3_3t", "author_flair_text": "Ohio", "edited": False, "extra": 1},
        {"id": "c2", "body": None, "score": -1, "created_utc": 1514700001,
         "link_id": "t3_3t", "author_flair_text": None, "edited": 1514700009.0},
    ]
    path = f"{folder}/comments.json"
    Path(path).write_text("".join(json.dumps(x) + "\n" for x in lines), encoding="utf-8")
    return path


def test_comment_schema(spark, out):
    df = readers.read_comments(spark, raw_comments(out))
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    assert (len(kinds), kinds.count("string"), kinds.count("boolean"), kinds.count("bigint")) == (
        25, 14, 6, 5,
    )
    rows = {r.id: r for r in df.collect()}
    assert rows["c1"].edited == "false" and rows["c1"].gilded is None
    assert rows["c2"].body is None and rows["c2"].score == -1


def test_bz2_is_read_by_extension(spark, out):
    df = readers.read_comments(spark, raw_comments(out))
    df.write.option("compression", "bzip2").json(f"{out}/bz2")
    assert [p for p in Path(f"{out}/bz2").iterdir() if p.suffix == ".bz2"]
    assert readers.read_comments(spark, f"{out}/bz2").collect() == df.collect()


def test_labels_stay_text(spark, out):
    Path(out).mkdir(parents=True)
    path = f"{out}/labels.csv"
    Path(path).write_text("Input_id,labeldem,labelgop,labeldjt\na,1,-1,0\nb,x,,1\n")
    rows = [tuple(r) for r in readers.read_labels(spark, path).collect()]
    assert rows == [("a", "1", "-1", "0"), ("b", "x", None, "1")]


def test_write_table_fails_if_it_exists(spark, out):
    writers.write_table(spark.range(3), f"{out}/t")
    with pytest.raises(AnalysisException):
        writers.write_table(spark.range(3), f"{out}/t")


def test_write_report_is_one_ordered_file(spark, out):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), F.lit(0.5).alias("Positive"))
    for _ in range(2):  # the second run replaces the first
        writers.write_report(df.repartition(5), f"{out}/r.csv", ["k"])
    parts = [p for p in Path(f"{out}/r.csv").iterdir() if p.suffix == ".csv"]
    assert len(parts) == 1
    lines = parts[0].read_text().splitlines()
    assert lines[0] == "k,Positive" and lines[1:] == [f"{i},0.5" for i in range(500)]


def test_stage_reuses_only_finished_output(spark, out):
    runs = []

    def build():
        runs.append(1)
        return spark.range(5)

    assert stage(spark, f"{out}/s", build).count() == 5
    assert stage(spark, f"{out}/s", build).count() == 5 and len(runs) == 1
    Path(f"{out}/s/_SUCCESS").unlink()  # as after a broken write
    assert not is_complete(spark, f"{out}/s")
    assert stage(spark, f"{out}/s", build).count() == 5 and len(runs) == 2


def test_shared_dir_follows_the_session(spark, out):
    assert out.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) != out


def test_ingest_and_clean_file(spark, out):
    path = raw_comments(f"{out}/raw")
    Path(f"{out}/raw/threads.json").write_text('{"id": "3t", "title": "T", "score": 9, "x": 1}\n')
    Path(f"{out}/raw/labels.csv").write_text("Input_id,labeldem,labelgop,labeldjt\nc1,1,0,1\n")
    comments, threads, labels = ingest(
        spark, path, f"{out}/raw/threads.json", f"{out}/raw/labels.csv", f"{out}/tables"
    )
    assert (comments.count(), labels.count()) == (2, 1)
    assert tuple(threads.first()) == ("3t", "T", 9)
    rows = clean_file(spark, path, f"{out}/clean").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("tab here ,  !", "tab here ", "tab_here here_", "tab_here_"), (None,) * 4], key=str
    )


def test_reports_and_tables_after_them(spark, out):
    rows = [
        ("c1", "t1", 1514700000, "Ohio", "A", 1, 0, 3, 10),
        ("c2", "t1", 1514700000, "Utah", "A", 0, 1, 3, 10),
        ("c3", "t2", 1514900000, "ohio", "B", 1, 1, 5, 20),
        ("c4", "t2", 1514900000, None, "B", 1, 1, None, 20),
    ]
    scored = spark.createDataFrame(
        rows,
        "comment_id string, submission_id string, timestamp long, state string, title string,"
        " pos int, neg int, comment_score long, submission_score long",
    )
    reports.write_reports(scored, out)
    names = sorted(p.name for p in Path(out).iterdir())
    assert names == sorted(
        f"{n}.csv"
        for n in (*reports.REPORTS, "top_pos_submissions", "top_neg_submissions")
    )
    days = postprocess.load_report(spark, out, "time_data")
    assert [tuple(r) for r in days.collect()] == [
        ("2017-12-31", 50.0, 50.0),
        ("2018-01-02", 100.0, 100.0),
    ]
    dense = postprocess.daily_series(days).collect()
    assert [(str(r.date), r.Positive) for r in dense] == [
        ("2017-12-31", 50.0), ("2018-01-01", None), ("2018-01-02", 100.0),
    ]
    assert postprocess.daily_series(days, ["2017-12-31"]).count() == 1
    states = postprocess.load_report(spark, out, "state_data")
    assert [r.state for r in states.collect()] == ["Ohio", "Utah"]
    dim = spark.createDataFrame(
        [("ohio",), ("utah",), ("guam",), ("District of Columbia",)], "state string"
    )
    mapped = {r.state: r for r in postprocess.region_map(states, dim).collect()}
    assert set(mapped) == {"ohio", "utah", "guam"}
    assert (mapped["ohio"].Difference, mapped["ohio"].PositiveShade) == (100.0, 0.0)
    assert mapped["guam"].Difference is None
    with pytest.raises(LookupError):
        postprocess.region_map(states, dim, strict=True)
    scores = postprocess.load_report(spark, out, "comment_score").collect()
    assert [r.comment_score for r in scores] == [None, 3, 5]
    top = spark.read.schema(schemas.TOP_THREADS).option("header", True).csv(
        f"{out}/top_neg_submissions.csv"
    )
    assert [r.submission_id for r in top.collect()] == ["t2", "t1"]


def test_columns_are_read_by_name(spark, out):
    Path(out).mkdir(parents=True)
    path = f"{out}/labels.csv"
    Path(path).write_text("labeldjt,more,Input_id,labelgop,labeldem\n1,x,a,0,-1\n")
    assert tuple(readers.read_labels(spark, path).first()) == ("a", "-1", "0", "1")
    Path(path).write_text("Input_id,labeldem,labeldjt\na,1,1\n")
    with pytest.raises(ValueError, match="labelgop"):
        readers.read_labels(spark, path)


def test_stages_know_what_they_were_made_with(spark, out):
    def build():
        return spark.range(3)

    assert stage(spark, f"{out}/s", build, made_with(seed=1)).count() == 3
    assert stage(spark, f"{out}/s", build, made_with(seed=1)).count() == 3
    with pytest.raises(ValueError, match="seed"):
        stage(spark, f"{out}/s", build, made_with(seed=2))
    spark.range(2).write.parquet(f"{out}/theirs")
    with pytest.raises(FileExistsError):
        stage(spark, f"{out}/theirs", build)
    assert spark.read.parquet(f"{out}/theirs").count() == 2


def test_clean_file_does_not_shuffle(spark, out):
    path = raw_comments(f"{out}/raw")
    clean_file(spark, path, f"{out}/clean")
    bodies = with_sanitized(spark.read.schema("body string").json(path), "body", "s")
    assert "Exchange" not in plan_text(bodies)


def test_malformed_json_is_an_error_or_kept(spark, out):
    Path(out).mkdir(parents=True)
    path = f"{out}/threads.json"
    Path(path).write_text('{"id": "a", "title": "T", "score": 1}\nnot json\n')
    for read in (readers.read_threads, readers.read_comments):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            read(spark, path).collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        clean_file(spark, path, f"{out}/clean")
    kept = readers.read_json(spark, path, "id string, _corrupt_record string", "PERMISSIVE")
    assert sorted(map(tuple, kept.collect()), key=str) == [("a", None), (None, "not json")]


def test_each_file_has_its_own_header(spark, out):
    Path(out).mkdir(parents=True)
    for name, text in (
        ("a b.csv", "Input_id,labeldem,labelgop,labeldjt\n1,dem,gop,djt\n"),
        ("b.csv", "Input_id,labeldjt,labelgop,labeldem\n2,djt,gop,dem\n3,djt,,dem\n"),
        ("c.csv", 'more,"labelgop",labeldem,labeldjt,Input_id\nx,gop,dem,djt,4\n'),
        ("d.csv", ""),
        ("e.csv", "Input_id,labeldem,labelgop,labeldjt\n"),
    ):
        Path(f"{out}/{name}").write_text(text)
    rows = sorted(map(tuple, readers.read_labels(spark, out).collect()))
    assert rows == [(str(i), "dem", None if i == 3 else "gop", "djt") for i in (1, 2, 3, 4)]
    assert len(readers.headers(spark, out)) == 3
    Path(f"{out}/f.csv").write_text("Input_id,labeldem\n5,dem\n")
    with pytest.raises(ValueError, match="f.csv has no column labelgop, labeldjt"):
        readers.read_labels(spark, out)


def test_labels_without_a_line(spark, out):
    Path(out).mkdir(parents=True)
    Path(f"{out}/empty.csv").write_text("")
    assert readers.read_labels(spark, f"{out}/empty.csv").collect() == []


def test_headers_of_one_large_file(spark, out, conf):
    conf("spark.sql.files.maxPartitionBytes", "1k")
    Path(out).mkdir(parents=True)
    lines = "".join(f"{i},1,0,-1\n" for i in range(2000))
    Path(f"{out}/l.csv").write_text("Input_id,labeldem,labelgop,labeldjt\n" + lines)
    assert [h for h, _ in readers.headers(spark, f"{out}/l.csv")] == ["Input_id,labeldem,labelgop,labeldjt"]
    assert readers.read_labels(spark, f"{out}/l.csv").count() == 2000


def test_malformed_report_numbers_raise(spark, out):
    Path(out).mkdir(parents=True)
    path = f"{out}/time_data.csv"
    Path(path).write_text("date,Negative,Positive\n2018-01-01,,12.5\n")
    assert tuple(postprocess.load_report(spark, out, "time_data").first()) == ("2018-01-01", 12.5, None)
    Path(path).write_text("date,Positive,Negative\n2018-01-01,12.5,1o\n")
    with pytest.raises(Exception, match="Negative is no double: 1o"):
        postprocess.load_report(spark, out, "time_data").collect()


def test_malformed_lines_go_to_quarantine(spark, out):
    path = raw_comments(f"{out}/raw")
    good = Path(path).read_text()
    Path(path).write_text(good + 'not json\n{"id": "c3", "score": "many"}\n')
    Path(f"{out}/raw/threads.json").write_text('{"id": "3t", "title": "T", "score": 9}\n')
    Path(f"{out}/raw/labels.csv").write_text("Input_id,labeldem,labelgop,labeldjt\nc1,1,0,1\n")
    raw = (path, f"{out}/raw/threads.json", f"{out}/raw/labels.csv")
    for _ in range(2):  # the second time from the finished stages
        comments, threads, _ = ingest(spark, *raw, f"{out}/tables")
        assert sorted(r.id for r in comments.collect()) == ["c1", "c2"]
        assert comments.columns == readers.read_comments(spark, path).columns
    lines = quarantined(spark, f"{out}/tables/comments")
    assert {r.line for r in lines.collect()} == {"not json", '{"id": "c3", "score": "many"}'}
    counts = quarantine_report(spark, f"{out}/tables").collect()
    assert {r.name: r.lines for r in counts} == {"comments": 2, "threads": 0}
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        ingest(spark, *raw, f"{out}/strict", malformed="fail")
    assert clean_file(spark, path, f"{out}/clean", malformed="quarantine").count() == 3
    assert quarantined(spark, f"{out}/clean.lines").count() == 1  # the score is not read there


def test_ingest_of_empty_files(spark, out):
    Path(f"{out}/raw").mkdir(parents=True)
    for name in ("comments.json", "threads.json"):
        Path(f"{out}/raw/{name}").write_text("")
    Path(f"{out}/raw/labels.csv").write_text("Input_id,labeldem,labelgop,labeldjt\n")
    raw = [f"{out}/raw/{n}" for n in ("comments.json", "threads.json", "labels.csv")]
    assert [t.count() for t in ingest(spark, *raw, f"{out}/tables")] == [0, 0, 0]
    assert [r.lines for r in quarantine_report(spark, f"{out}/tables").collect()] == [0, 0]


def test_changed_raw_files_are_not_reused(spark, out):
    path = raw_comments(f"{out}/raw")
    assert clean_file(spark, path, f"{out}/clean").count() == 2
    assert clean_file(spark, path, f"{out}/clean").count() == 2
    Path(path).write_text('{"body": "another"}\n')
    with pytest.raises(ValueError, match="files"):
        clean_file(spark, path, f"{out}/clean")


def test_fingerprints(spark, out):
    spark.range(10).write.parquet(f"{out}/a")
    spark.range(11).write.parquet(f"{out}/b")
    a, b = (spark.read.parquet(f"{out}/{x}") for x in "ab")
    assert of_table(a) == of_table(spark.read.parquet(f"{out}/a")) != of_table(b)
    assert of_table(a.where("id > 3")) == of_table(a.where("id > 3")) != of_table(a.where("id > 4"))
    assert of_table(a.repartition(3)) == of_table(a.repartition(5))
    assert of_table(a) != of_table(a.select((F.col("id") + 1).alias("id")))
    local = [spark.createDataFrame(rows, "x int, y string") for rows in ([(1, "a"), (2, None)], [(2, None), (1, "a")], [(1, "a")])]
    assert of_table(local[0]) == of_table(local[1]) != of_table(local[2])
    assert of_table(None) is None and of_files(spark, [f"{out}/nothing"]) is None
    first = of_files(spark, [f"{out}/a"])
    spark.range(1).write.mode("append").parquet(f"{out}/a")
    assert first != of_files(spark, [f"{out}/a"])


def test_reports_have_a_row_limit(spark, out):
    writers.write_report(spark.range(100).repartition(7), f"{out}/r.csv", ["id"], most=100)
    assert spark.read.option("header", True).csv(f"{out}/r.csv").count() == 100
    with pytest.raises(Exception, match="more than 99 rows"):
        writers.write_report(spark.range(100).repartition(7), f"{out}/r.csv", ["id"], most=99)


SCORED = (
    "comment_id string, submission_id string, timestamp long, state string, title string,"
    " pos int, neg int, comment_score long, submission_score long"
)


def test_reports_read_the_scored_table_once(spark, out):
    spark.createDataFrame([], SCORED).write.parquet(f"{out}/scored")
    plan = plan_text(reports.all_rollups(spark.read.parquet(f"{out}/scored")))
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Expand") == 1
    assert "title" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_reports_of_no_rows(spark, out):
    reports.write_reports(spark.createDataFrame([], SCORED), out)
    assert [tuple(r) for r in postprocess.load_report(spark, out, "raw_percentages").collect()] == [(None, None)]
    assert postprocess.load_report(spark, out, "time_data").count() == 0
