"""CSV with quoted newlines in many tasks, against the reader that takes a file as a whole."""

import csv
import random
from collections import Counter

import pytest

from texloam.sources import readers, split_csv


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([("id", "text", "other"), *rows])


def some_rows(seed, n=400):
    rng = random.Random(seed)
    pieces = ["a", "é", "\n", '"', ",", "\n\n", "x y", "漢字", "long " * 20, "' ", "1"]
    return [(str(i), "t" + "".join(rng.choices(pieces, k=rng.randint(0, 12))) + "t", rng.choice(("", "o", "p\nq"))) for i in range(n)]


@pytest.mark.parametrize(("size", "end"), [(1000, "\n"), (700, "\r\n"), (10_000_000, "\n")])
def test_rows_equal_the_whole_file_reader(spark, tmp_path, small_ranges, size, end):
    for n in range(2):
        write(tmp_path / f"{n}.csv", some_rows(n), end)
    (tmp_path / "empty.csv").write_text("id,text,other\n")
    small_ranges(size)
    got = readers.read_csv(spark, str(tmp_path), split=True)
    whole = readers.read_csv(spark, str(tmp_path), "id string, text string, other string")
    assert got.columns == whole.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, whole.collect()))
    lines = split_csv._lines(spark, str(tmp_path))
    assert (lines.select("file", "start").distinct().count() > 20) == (size <= 1000)


def test_a_field_longer_than_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(["line"] * 3000)
    write(tmp_path / "a.csv", [("1", long, "x"), ("2", "short", "y"), ("3", '"' * 50 + "\n" * 50, "z")])
    small_ranges(256)
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), "id int, text string, other string", split=True).collect()
    assert sorted(map(tuple, got)) == [(1, long, "x"), (2, "short", "y"), (3, '"' * 50 + "\n" * 50, "z")]


def test_header_over_two_lines_and_no_final_newline(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('"first\nname",b\n1,"x\ny"\n\n2,z')
    small_ranges(4)
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), split=True)
    assert got.columns == ["first\nname", "b"] and sorted(map(tuple, got.collect())) == [("1", "x\ny"), ("2", "z")]


def test_only_utf8(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path), split=True, encoding="latin-1")
