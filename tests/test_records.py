"""Records of CSV files that many tasks share."""

import csv
import gzip
import io
import random

import pytest

from platterflow.sources import exports, records

SMALL = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few hundred bytes, smaller than some records."""
    keys = {SMALL: "400", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def odd_cell(r):
    return r.choice(["plain", "", "NA", 'say "hi"', "two\nlines", 'a "quoted"\n\n"break",', "é日本", "comma, here", " padded ", '"', '""',
                     "\n", "x" * r.randint(0, 200), "line\r\nfeed", "\n" * r.randint(1, 60)])


def written(path, header, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def cells(rows):
    """As the reader gives them: missing texts are null."""
    missing = {"", "NA", "nan"}
    return [tuple(None if c in missing else c for c in row) for row in rows]


def read(spark, paths, columns):
    lines = exports.read_exports(spark, paths)
    return lines, [tuple(r) for r in lines.orderBy("line_order").select(*columns).collect()]


@pytest.mark.parametrize("seed", range(2))
def test_random_cells_over_tiny_splits(spark, tmp_path, tiny_splits, seed):
    r = random.Random(seed)
    files = [[(f"{f}-{i}", odd_cell(r), odd_cell(r), str(i)) for i in range(r.randint(1, 100))] for f in range(3)]
    for f, rows in enumerate(files):
        written(tmp_path / f"{f}.csv", ["order_id", "a", "b", "n"], rows, "\r\n" if f == 1 else "\n")
    lines, got = read(spark, str(tmp_path / "*.csv"), ["order_id", "a", "b", "n"])
    assert got == cells([row for rows in files for row in rows])
    places = lines.select("line_order.file", "line_order.offset").distinct().collect()
    assert len({p.file for p in places}) == 3 and len(places) > 9  # many splits of one file hold records
    plan_tasks = lines.rdd.getNumPartitions()
    assert plan_tasks > 3


def test_a_record_over_many_splits(spark, tmp_path, tiny_splits):
    long = "\n".join(f"line {i}, \"{i}\"" for i in range(300))
    written(tmp_path / "1.csv", ["order_id", "text"], [("a", "x"), ("b", long), ("c", "y"), ("d", long)])
    lines, got = read(spark, str(tmp_path / "1.csv"), ["order_id", "text"])
    assert got == [("a", "x"), ("b", long), ("c", "y"), ("d", long)]


def test_stray_quotes_are_text(spark, tmp_path, tiny_splits):
    (tmp_path / "1.csv").write_text('order_id,size,n\n1,5" pipe,1\n2,"a ""b""",2\n3,6",3\n\n   \n4,"x\ny",4\n')
    _, got = read(spark, str(tmp_path / "1.csv"), ["order_id", "size", "n"])
    assert got == [("1", '5" pipe', "1"), ("2", 'a "b"', "2"), ("3", '6"', "3"), ("4", "x\ny", "4")]


def test_headers_of_all_kinds(spark, tmp_path, tiny_splits):
    written(tmp_path / "1.csv", ["order_id", "two\nlines"], [("1", "a")])
    (tmp_path / "2.csv").write_bytes("﻿order_id,b\r\n2,c\r\n".encode())
    (tmp_path / "3.csv.gz").write_bytes(gzip.compress(b'order_id,b\n3,"d\ne"\n'))
    written(tmp_path / "4.csv", ["order_id", "b"], [])
    lines, got = read(spark, str(tmp_path / "*.csv*"), ["order_id", "`two\nlines`", "b"])
    assert got == [("1", "a", None), ("2", None, "c"), ("3", None, "d\ne")]
    assert {tuple(r) for r in exports.source_files(lines).collect()} == {("1.csv", 1), ("2.csv", 1), ("3.csv.gz", 1)}


def test_files_without_a_header_are_named(spark, tmp_path):
    written(tmp_path / "1.csv", ["order_id"], [("1",)])
    (tmp_path / "3.csv").write_text("\n1\n")
    with pytest.raises(ValueError, match="3.csv"):
        exports.read_exports(spark, str(tmp_path / "*.csv"))


def test_without_line_breaks_the_reader_is_the_plain_one(spark, tmp_path, tiny_splits):
    rows = [(str(i), "a, b", 'say "x"') for i in range(200)]
    written(tmp_path / "1.csv", ["order_id", "a", "b"], rows)
    lines = exports.read_exports(spark, str(tmp_path / "1.csv"), line_breaks=False)
    assert [tuple(r)[:3] for r in lines.orderBy("line_order").collect()] == rows
    assert lines.rdd.getNumPartitions() > 5


def test_many_files_are_joined_by_a_shuffle(spark, tmp_path, tiny_splits, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_ROWS", 0)
    r = random.Random(9)
    rows = [(str(i), odd_cell(r)) for i in range(80)]
    written(tmp_path / "1.csv", ["order_id", "a"], rows[:40])
    written(tmp_path / "2.csv", ["order_id", "a"], rows[40:])
    _, got = read(spark, str(tmp_path / "*.csv"), ["order_id", "a"])
    assert got == cells(rows)


def test_state_of_a_line_against_the_csv_module():
    r = random.Random(3)
    for _ in range(300):
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerow([odd_cell(r).replace("\r", "") for _ in range(3)])
        inside, count = False, 0
        for line in out.getvalue()[:-1].split("\n"):
            assert count == 0 or inside  # one record, so only its last line ends outside
            inside, count = records.open_after(line, inside), count + 1
        assert not inside


def test_the_catalogue_counts_files_without_reading_them(spark, tmp_path):
    for name, text in (("b.csv", "x\n1\n"), ("a.csv", "x\n"), ("c.csv", "")):
        (tmp_path / name).write_text(text)
    listed = records.numbered_files(spark, str(tmp_path / "*.csv")).orderBy("file_no").collect()
    assert [(f.file.rsplit("/", 1)[-1], f.file_no, f.bytes) for f in listed] == [("a.csv", 1, 2), ("b.csv", 2, 4)]
