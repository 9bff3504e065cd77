"""CSV files read by many tasks each, against Python's csv module and Spark's reader of
whole files."""

import contextlib
import csv
import io
import random

import pytest

from deskline.sources.csv_ranges import left_open
from deskline.sources.shared import shared_folder
from deskline.sources.tables import _CSV_OPTIONS, read_csv

SCHEMA = "a string, b string, c string"


@contextlib.contextmanager
def ranges_of(spark, size):
    """Files are cut into ranges of about so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def save(spark, *texts):
    folder = shared_folder(spark, "csv-test")
    java = spark.sparkContext._jvm.java.io.File(folder)
    java.mkdirs()
    for i, text in enumerate(texts):
        with open(f"{folder}/part-{i}.csv", "w", newline="", encoding="utf-8") as file:
            file.write(text)
    return folder


def written(rows, quoting=csv.QUOTE_MINIMAL, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, quoting=quoting, lineterminator=end)
    writer.writerow(["a", "b", "c"])
    writer.writerows(rows)
    return out.getvalue()


def cell(rnd):
    pieces = ["x", "word ", '"', '""', ",", "\n", "\n\n", "\r\n", "é𝔘", " ", '",', '\n"', "é" * 30]
    return "".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 1, 2, 5, 12])))


def wanted(rows):
    return sorted([tuple(v or None for v in row) for row in rows], key=repr)


def got(spark, folder):
    return sorted([tuple(r) for r in read_csv(spark, folder, SCHEMA).collect()], key=repr)


@pytest.mark.parametrize("quoting, end, size", [(csv.QUOTE_MINIMAL, "\n", 40), (csv.QUOTE_ALL, "\r\n", 97), (csv.QUOTE_ALL, "\n", 7), (csv.QUOTE_MINIMAL, "\r\n", 1000)])
def test_rows_equal_those_of_the_csv_module(spark, quoting, end, size):
    rnd = random.Random(size)
    files = [[("id", cell(rnd), cell(rnd)) for _ in range(n)] for n in (60, 1, 0)]
    with ranges_of(spark, size):
        folder = save(spark, *[written(rows, quoting, end) for rows in files])
        assert spark.read.text(folder).rdd.getNumPartitions() > 3
        assert got(spark, folder) == wanted([row for rows in files for row in rows])


def test_a_cell_over_many_ranges(spark):
    long = ("line of a long cell, with commas\n" * 300) + '"quoted"\n' + "\n" * 50
    rows = [("1", "short", "x"), ("2", long, "y"), ("3", long, long), ("4", "", "end")]
    with ranges_of(spark, 100):
        assert got(spark, save(spark, written(rows))) == wanted(rows)


def test_quotes_that_open_no_cell(spark):
    text = 'a,b,c\n1,5" pipe,x\n2, "not quoted",y\n3,"a ""b"" c","d\ne"\n4,six"seven"eight,z\n5,,\n\n6,only two\n'
    folder = save(spark, text)
    whole = spark.read.options(**_CSV_OPTIONS, multiLine=True).schema(SCHEMA).csv(folder)
    expected = sorted([tuple(r) for r in whole.collect()], key=repr)
    assert len(expected) == 6
    for size in (5, 20, 10_000):
        with ranges_of(spark, size):
            assert got(spark, folder) == expected


def test_unclosed_quotes_and_empty_files(spark):
    with ranges_of(spark, 10):
        assert got(spark, save(spark, 'a,b,c\n1,2,3\n4,"open,5\n6,7,8\n')) == [("1", "2", "3"), ("4", "open,5\n6,7,8", None)]
        assert got(spark, save(spark, "", "a,b,c\n", "a,b,c")) == []


def test_types(spark):
    folder = save(spark, 'a,b,c\n1,2.5,"x\ny"\n,,\nno,1,z\n')
    found = read_csv(spark, folder, "a int, b double, c string").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, 2.5, "x\ny"), (None, None, None), (None, 1.0, "z")], key=repr)


def plain_left_open(line, inside):
    """By single characters: whether a quoted cell is open at the end."""
    at, start = 0, not inside
    while at < len(line):
        if inside:
            if line[at] == '"':
                if line[at + 1 : at + 2] == '"':
                    at += 1
                else:
                    inside = False
            start = False
        elif line[at] == ",":
            start = True
        else:
            inside = start and line[at] == '"'
            start = False
        at += 1
    return inside


def test_states_of_lines():
    rnd = random.Random(1)
    for _ in range(50_000):
        line = "".join(rnd.choice('",a ') for _ in range(rnd.randint(0, 12)))
        for inside in (False, True):
            assert left_open(line, inside) == plain_left_open(line, inside), (line, inside)


def test_one_large_file_is_read_by_many_tasks(spark):
    rows = [(str(i), f'text {i}, "with"\nlines\r\nand more ' + "w " * (i % 50), "z") for i in range(40_000)]
    with ranges_of(spark, 200_000):
        df = read_csv(spark, save(spark, written(rows)), SCHEMA)
        assert df.rdd.getNumPartitions() > 10
        assert sorted([tuple(r) for r in df.collect()]) == sorted(rows)
