"""Splittable CSV with line breaks: equal to the reader that takes a file in one task."""

from __future__ import annotations

import csv
import random

import pytest

from strata.sources.csv_records import read_csv_records, records
from strata.sources.io import read_raw_csv


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows(rows)


def table(rng, n):
    parts = ["a", "é", ",", '"', '""', "\n", "\n\n", " ", "\\", "x" * 40, "line\nbreak", "\n\"\n"]
    return [[str(i), "".join(rng.choices(parts, k=rng.randint(0, 9))), rng.choice(["", "p\nq" * 150, "z"])] for i in range(n)]


def test_equals_the_unsplittable_reader(spark, tmp_path, small_splits):
    rng = random.Random(4)
    for k in range(3):
        write(tmp_path / f"f{k}.csv", [["id", "text", "other"], *table(rng, 80)])
    got = read_csv_records(spark, str(tmp_path), with_order=True)
    want = sorted(map(tuple, read_raw_csv(spark, str(tmp_path), multi_line=True).collect()), key=str)
    assert sorted(map(tuple, got.drop("_input_order").collect()), key=str) == want and len(want) == 240
    assert any(x and "\n" in x for _, x, _ in want)
    assert records(spark, str(tmp_path)).select("file", "block").distinct().count() > 30
    one = got.where("_input_order.file LIKE '%f1.csv'").orderBy("_input_order").collect()
    assert [int(r.id) for r in one] == list(range(80))


def test_carriage_returns_blank_lines_and_empty_files(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", [["id", "text"], ["1", "x"], ["2", 'say "hi"'], ["3", ""]], end="\r\n")
    assert [tuple(r) for r in read_csv_records(spark, str(tmp_path / "a.csv")).orderBy("id").collect()] == [("1", "x"), ("2", 'say "hi"'), ("3", None)]
    (tmp_path / "b.csv").write_text("id,text\n\n1,x\n\n\n2,y\n")
    assert [tuple(r) for r in read_csv_records(spark, str(tmp_path / "b.csv")).orderBy("id").collect()] == [("1", "x"), ("2", "y")]
    (tmp_path / "c.csv").write_text("id,text\n")
    assert read_csv_records(spark, str(tmp_path / "c.csv")).count() == 0


def test_another_header_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("id,word\n1,x\n")
    with pytest.raises(Exception, match="another header|does not conform|mismatch|FAILFAST"):
        read_csv_records(spark, str(tmp_path)).collect()


def test_ingest_of_line_breaks(spark, tmp_path, small_splits):
    from strata.sources.io import ingest_dir
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "notes.csv", [["Unnamed: 0", "id", "text"], ["0", "1", "a\nb"], ["1", "2", "c,d"]])
    landed = ingest_dir(spark, str(tmp_path / "in"), str(tmp_path / "out"), line_breaks=True)
    assert sorted(map(tuple, spark.read.parquet(landed["notes"]).collect())) == [("1", "a\nb"), ("2", "c,d")]
