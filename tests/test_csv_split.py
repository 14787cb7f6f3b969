"""Quoted CSV by byte ranges equals Spark's reader of whole files, wherever ranges end."""

import csv
import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from jobtide.sources import csv_split, io


def rows_of(df, order=None):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {n: spark.conf.get(n) for n in names}

    def set_to(size, cost=0):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], str(cost))

    yield set_to
    for n, v in kept.items():
        spark.conf.set(n, v)


def write(path, rows, header=("id", "title", "text"), **more):
    with open(path, "w", encoding=more.pop("encoding", "utf-8"), newline="") as out:
        w = csv.writer(out, **more)
        w.writerow(header)
        w.writerows(rows)


def made(n, seed=1):
    rng = random.Random(seed)
    parts = ["word", '"quoted"', "a,b", "line\nbreak", "\n\n", "ümlaut 日本", '""', "'", "", " ", "x" * 40, "\r\n", "end\n"]
    return [[str(i), rng.choice(parts), "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 6)))] for i in range(n)]


@pytest.mark.parametrize("size", [16, 33, 64, 500, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_whole_file_reader(spark, tmp_path, small_ranges, size, end):
    for k in range(2):
        write(tmp_path / f"part{k}.csv", made(60, k), lineterminator=end, quoting=csv.QUOTE_MINIMAL if k else csv.QUOTE_ALL)
    want = sorted(rows_of(io.read_csv(spark, str(tmp_path))), key=str)
    small_ranges(size)
    got = csv_split.read_csv_split(spark, str(tmp_path))
    assert got.columns == ["id", "title", "text"] and sorted(rows_of(got), key=str) == want
    small_ranges(size, cost=1 << 20)  # a range per task
    assert sorted(rows_of(csv_split.read_csv_split(spark, str(tmp_path))), key=str) == want


def test_order_is_that_of_the_file(spark, tmp_path, small_ranges):
    write(tmp_path / "a.csv", made(200))
    small_ranges(100)
    got = csv_split.read_csv_split(spark, str(tmp_path / "a.csv"), order="_ord")
    assert got.rdd.getNumPartitions() > 1
    assert [r.id for r in got.orderBy("_ord").collect()] == [str(i) for i in range(200)]


@pytest.mark.parametrize("size", [8, 1 << 20])
def test_loose_quotes_marks_and_odd_headers(spark, tmp_path, small_ranges, size):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbf"i\nd",name,name,\n1,5" pipe,"a ""b""\n, c",x\n\n2,"open, ""\n""",,\n3,"cut"off,last,"\n"')
    want = rows_of(io.read_csv(spark, str(tmp_path / "a.csv")))
    small_ranges(size)
    got = csv_split.read_csv_split(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["i\nd", "name1", "name2", "_c3"] and sorted(rows_of(got), key=str) == sorted(want, key=str)


def test_encodings_schemas_empty_and_unequal_files(spark, tmp_path, small_ranges):
    small_ranges(20)
    write(tmp_path / "l.csv", [["1", "é\nß", "a;b"]], encoding="latin-1", delimiter=";")
    assert rows_of(csv_split.read_csv_split(spark, str(tmp_path / "l.csv"), encoding="ISO-8859-1", sep=";")) == [("1", "é\nß", "a;b")]
    named = StructType([StructField(c, StringType()) for c in ("x", "y", "z")])
    assert csv_split.read_csv_split(spark, str(tmp_path / "l.csv"), encoding="ISO-8859-1", sep=";", schema=named).first().y == "é\nß"
    (tmp_path / "none").mkdir()
    (tmp_path / "none/a.csv").write_bytes(b"")
    assert csv_split.read_csv_split(spark, str(tmp_path / "none")).collect() == []
    write(tmp_path / "none/b.csv", [["1", "2", "3"]])
    write(tmp_path / "none/c.csv", [["1", "2", "3"]], header=("a", "b", "c"))
    with pytest.raises(ValueError, match="different headers"):
        csv_split.read_csv_split(spark, str(tmp_path / "none"))
