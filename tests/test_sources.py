from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from lexloom.operators.terms import fit_vocabulary
from lexloom.plans import topics
from lexloom.sources import (
    Staging,
    append_csv,
    append_json,
    read_csv,
    read_parquet,
    read_words,
    shared_dir,
    spread,
    stage,
    with_slice,
    write_parquet,
)
from lexloom.sources.staging import application_dir


def test_csv_without_a_schema_is_all_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('name,speech,n\nann,"say ""hi""\nthere",1\nbob,,\n')
    df = read_csv(spark, str(path))
    assert df.dtypes == [("name", "string"), ("speech", "string"), ("n", "string")]
    assert [tuple(r) for r in df.collect()] == [
        ("ann", 'say "hi"\nthere', "1"),
        ("bob", None, None),
    ]
    assert df.na.drop("any").count() == 1


def test_csv_one_line_per_row(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,y\n")
    df = read_csv(spark, str(path), "a int, b string", multi_line=False)
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, "y")]


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, ' a "b", c '), (2, "line\nbreak"), (3, None), (4, "back\\slash")]
    path = str(tmp_path / "out")
    append_csv(spark.createDataFrame([*rows, (5, "")], "id int, t string"), path)
    # An empty field is null, quoted or not.
    rows.append((5, None))
    assert sorted(tuple(r) for r in read_csv(spark, path, "id int, t string").collect()) == rows


def test_json_appends(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(3).withColumn("w", F.array(F.lit("a"), F.lit("b")))
    append_json(df, path)
    append_json(df, path)
    found = spark.read.schema("id long, w array<string>").json(path)
    assert sorted(r.id for r in found.collect()) == [0, 0, 1, 1, 2, 2]


def test_parquet_reads_only_named_columns_and_directories(spark, sf, tmp_path):
    df = read_parquet(spark, f"{sf}/documents.parquet", ["doc_id", "lang"])
    plan = df.filter("lang = 'en'")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    assert "EqualTo(lang,en)" in plan
    path = str(tmp_path / "out")
    write_parquet(df, path, by=["lang"])
    part = read_parquet(spark, path).filter("lang = 'en'")
    assert "PartitionFilters: [isnotnull(lang" in part._jdf.queryExecution().executedPlan().toString()
    assert part.count() == df.filter("lang = 'en'").count()


def test_slices_are_files(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.range(0, 30, 1, 3).write.parquet(path)
    sizes = with_slice(read_parquet(spark, path)).groupBy("slice").count().collect()
    assert sorted(r["count"] for r in sizes) == [10, 10, 10]


def test_spread_only_as_the_session_says(spark):
    df = spark.range(100).repartition(3)
    assert spread(df) is df
    spark.conf.set("spark.lexloom.scanPartitions", "5")
    try:
        assert spread(df).rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset("spark.lexloom.scanPartitions")


def test_words(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("the\n and \n\nthe\n")
    assert sorted(r.word for r in read_words(spark, str(path)).collect()) == ["and", "the", "the"]


def test_files_of_one_name_are_different_slices(spark, tmp_path):
    for folder in ("a", "b"):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / folder))
        part = next((tmp_path / folder).glob("part-*.parquet"))
        part.rename(tmp_path / folder / "same.parquet")
    paths = [str(tmp_path / folder / "same.parquet") for folder in ("a", "b")]
    found = with_slice(read_parquet(spark, paths)).groupBy("slice").count().collect()
    assert sorted(r["slice"].rsplit("/", 2)[1] for r in found) == ["a", "b"]


def test_staged_tables_lie_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    staged = stage(spark.range(5), "five")
    app = spark.sparkContext.applicationId
    assert all(f"{named}/lexloom/{app}/five-" in f for f in staged.inputFiles())
    assert staged.count() == 5


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return files.mkString("\n").count("shuffle_")


def test_a_staged_table_leaves_no_shuffle_files(spark, tmp_path):
    """They go when the table is written, also while something still refers to its plan."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    shuffled = spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(5, "k")
    there = _shuffle_files(spark)
    staged = stage(shuffled, "shuffled")
    append_csv(shuffled, str(tmp_path / "csv"))
    for _ in range(50):
        if _shuffle_files(spark) <= there:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= there and staged.count() == shuffled.count() == 1000
    assert spark.conf.get(key, None) == before


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self):
        self.conf = {"spark.sql.warehouse.dir": "file:/shared/warehouse/"}
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_without_a_folder_the_warehouse_is_used():
    assert shared_dir(_Session()) == "file:/shared/warehouse"


def _staged(spark) -> set[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(application_dir(spark))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.listStatus(path) if system.exists(path) else []
    return {s.getPath().getName() for s in found}


def test_plans_with_bounded_results_leave_no_tables(spark):
    before = _staged(spark)
    with Staging(spark) as staging:
        one, two = (staging.write(spark.range(n), "t") for n in (2, 3))
        assert len(_staged(spark) - before) == 2 and one.count() + two.count() == 5
        staging.drop(one)
        assert len(_staged(spark) - before) == 1
    assert _staged(spark) == before
    rows = [("x", ["a", "b"]), ("x", ["a", "c", "c"]), ("y", ["b", "c"]), ("y", ["b", "d"])]
    df = spark.createDataFrame(rows, "s string, tokens array<string>")
    assert fit_vocabulary(df, "tokens", 4, 9).terms
    assert _staged(spark) == before
    # The topics of any number of slices are a table themselves, the only one that stays.
    assert topics(df, "tokens", k=1, max_df=4).count() > 0
    assert topics(df, "tokens", k=1, max_df=4, slice="s").count() > 0
    assert {name.split("-")[0] for name in _staged(spark) - before} == {"svd"}
    assert len(_staged(spark) - before) == 2
