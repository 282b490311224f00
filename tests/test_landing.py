"""Lines parsed once per file, and sections published as a whole."""

import os

import pytest

from platterflow.functions import coerce
from platterflow.plans import publish
from platterflow.sources import dimensions, exports, landing, published


def write(path, *rows, header="order_id,quantity,note"):
    path.write_text("\n".join([header, *rows]) + "\n")


def content(lines):
    return [(r.order_id, r.quantity, r.note) for r in lines.orderBy("line_order").collect()]


def test_a_second_run_reads_no_csv(spark, tmp_path, monkeypatch):
    write(tmp_path / "1.csv", "a,1,x", 'b,bad,"two\nlines"')
    write(tmp_path / "2.csv", "c,2.5,", header="order_id,quantity,note")
    source, store = str(tmp_path / "*.csv"), str(tmp_path / "store")
    want = [("a", 1.0, "x"), ("b", None, "two\nlines"), ("c", 2.5, None)]
    assert content(landing.lines(spark, source, store)) == want
    parsed = []
    plain = exports.read_exports
    monkeypatch.setattr(exports, "read_exports", lambda spark, paths, *a: parsed.append(list(paths)) or plain(spark, paths, *a))
    again = landing.lines(spark, source, store)
    assert content(again) == want and parsed == []
    assert not any(name.endswith(".csv") for name in again.inputFiles())
    write(tmp_path / "1.csv", "a,7,changed")
    os.utime(tmp_path / "1.csv", (2_000_000_000, 2_000_000_000))
    write(tmp_path / "3.csv", "d,4,new,more", header="order_id,quantity,note,extra")
    assert content(landing.lines(spark, source, store)) == [("a", 7.0, "changed"), ("c", 2.5, None), ("d", 4.0, "new")]
    assert [[p.rsplit("/", 1)[-1] for p in paths] for paths in parsed] == [["1.csv", "3.csv"]]
    os.unlink(tmp_path / "2.csv")
    assert content(landing.lines(spark, source, store)) == [("a", 7.0, "changed"), ("d", 4.0, "new")] and len(parsed) == 1
    assert {tuple(r) for r in exports.source_files(landing.lines(spark, source, store)).collect()} == {("1.csv", 1), ("3.csv", 1)}
    assert landing.clean(spark, source, store) == 1
    assert content(landing.lines(spark, source, store)) == [("a", 7.0, "changed"), ("d", 4.0, "new")] and len(parsed) == 1


def test_lines_without_a_ledger_entry_are_not_read(spark, tmp_path, monkeypatch):
    """A run that dies between its lines and its ledger entry is as if it had not been."""
    write(tmp_path / "1.csv", "a,1,x")
    source, store = str(tmp_path / "*.csv"), str(tmp_path / "store")

    class Died(Exception):
        pass

    def die(*_):
        raise Died
    with monkeypatch.context() as m:
        m.setattr(landing.F, "lit", die)
        with pytest.raises(Died):
            landing.land(spark, source, store)
    assert content(landing.lines(spark, source, store)) == [("a", 1.0, "x")]


def test_landed_numbers_are_as_jobs_read_text(spark, tmp_path):
    cells = ["1", " 2 ", "1e3", "NaN", "abc", "", "5d", "-0.5"]
    write(tmp_path / "1.csv", *[f'a,{c},' for c in cells])
    lines = landing.lines(spark, str(tmp_path / "1.csv"), str(tmp_path / "store"))
    plain = exports.read_exports(spark, str(tmp_path / "1.csv"))
    got = [r[0] for r in lines.orderBy("line_order").select(coerce.number_or_zero(lines.quantity, "double")).collect()]
    assert got == [r[0] for r in plain.orderBy("line_order").select(coerce.number_or_zero(plain.quantity)).collect()]


def test_missing_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.lines(spark, str(tmp_path / "*.csv"), str(tmp_path / "store"))


def rows(frame):
    return sorted(r.v for r in frame.collect())


def test_a_run_that_dies_leaves_the_one_before(spark, tmp_path):
    output = str(tmp_path / "out")
    with publish.Publication(spark, output) as sections:
        sections.write(spark.range(3).withColumnRenamed("id", "v"), "a")
        sections.write(spark.range(2).withColumnRenamed("id", "v"), "b", format="csv")
    with pytest.raises(ValueError, match="NaN"):
        with publish.Publication(spark, output) as sections:
            sections.write(spark.range(9).withColumnRenamed("id", "v"), "a")
            sections.write(spark.sql("SELECT double('NaN') AS v"), "b")
    for _ in range(2):
        assert rows(published.read_section(spark, output, "a")) == [0, 1, 2]
        assert rows(published.read_section(spark, output, "b", "v bigint")) == [0, 1]
        # A process that is killed writes no more: its sections are there, its manifest is not.
        killed = publish.Publication(spark, output)
        killed.write(spark.range(5).withColumnRenamed("id", "v"), "a")
    assert rows(dimensions.read_payload(spark, f"{output}/a")) == [0, 1, 2]
    for n in (4, 5):
        with publish.Publication(spark, output) as sections:
            sections.write(spark.range(n).withColumnRenamed("id", "v"), "a")
    assert rows(published.read_section(spark, output, "a")) == [0, 1, 2, 3, 4]
    with pytest.raises(FileNotFoundError, match="section b"):
        published.read_section(spark, output, "b")
    assert len(os.listdir(tmp_path / "out/_versions")) == 2 and published.current(spark, output)["number"] == 3


def test_readers_of_the_version_before_can_go_on(spark, tmp_path):
    output = str(tmp_path / "out")
    with publish.Publication(spark, output) as sections:
        sections.write(spark.range(3).withColumnRenamed("id", "v"), "a")
    begun = published.read_section(spark, output, "a")
    with publish.Publication(spark, output) as sections:
        sections.write(spark.range(5).withColumnRenamed("id", "v"), "a")
    assert rows(begun) == [0, 1, 2] and rows(published.read_section(spark, output, "a")) == [0, 1, 2, 3, 4]


def test_two_runs_that_end_at_once(spark, tmp_path, monkeypatch):
    output = str(tmp_path / "out")
    first, second = publish.Publication(spark, output), publish.Publication(spark, output)
    for run, n in ((first, 1), (second, 2)):
        run.write(spark.range(n).withColumnRenamed("id", "v"), "a")
    first.commit()
    monkeypatch.setattr(publish, "current", lambda *_: None)
    with pytest.raises(RuntimeError, match="Another run"):
        second.commit()
    monkeypatch.undo()
    assert rows(published.read_section(spark, output, "a")) == [0]


def test_a_single_output_is_swapped_in(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "deep/er/out")
    publish.write_json(spark.range(2), path)
    with pytest.raises(ValueError):
        publish.write_json(spark.sql("SELECT double('NaN') AS v"), path)
    assert spark.read.json(path).count() == 2 and os.listdir(tmp_path / "deep/er") == ["out"]
    publish.write_csv(spark.range(7), path)
    assert spark.read.option("header", True).csv(path).count() == 7 and os.listdir(tmp_path / "deep/er") == ["out"]
