"""Loads into a growing table: each file once, whatever run ends where."""

import os
import pathlib

import pytest

from dustline import append_folder
from dustline.plans.append import LOAD, AppendTable, entries


@pytest.fixture
def target(spark, database, request):
    name = "append_" + request.node.name.split("[")[0]
    return AppendTable(spark, name, database)


def write(folder, name, rows, header="a,b"):
    path = pathlib.Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    return path


def content(target):
    if not target.exists():
        return []
    return sorted(tuple(r) for r in target.spark.table(target.name).drop(LOAD).collect())


def run(target, folder):
    found = append_folder(target.spark, str(folder), target.table, target.database).collect()
    return sorted(r["path"].rsplit("/", 1)[-1] for r in found)


def test_each_file_once(target, tmp_path):
    assert run(target, tmp_path) == [] and not target.exists()
    one = write(tmp_path, "one.csv", ["1,x", "2,NA"])
    write(tmp_path, "[odd] {1}*.csv", ["3,y"])
    write(tmp_path, "parts.csv/part-0.csv", ["4,z"])
    write(tmp_path, "other.txt", ["5,z"])
    assert run(target, tmp_path) == ["[odd] {1}*.csv", "one.csv", "part-0.csv"]
    assert content(target) == [("1", "x"), ("2", ""), ("3", "y"), ("4", "z")]
    assert run(target, tmp_path) == []
    os.utime(one, (1, 1))  # touched only
    assert run(target, tmp_path) == []
    write(tmp_path, "parts.csv/part-1.csv", ["5,five"])
    assert run(target, tmp_path) == ["part-1.csv"]
    write(tmp_path, "one.csv", ["1,x", "2,b!"])  # as long as before, with other content
    assert run(target, tmp_path) == ["one.csv"]
    assert content(target) == [("1", "x"), ("1", "x"), ("2", ""), ("2", "b!"), ("3", "y"), ("4", "z"), ("5", "five")]
    loads = {r["path"].rsplit("/", 1)[-1]: r["load"] for r in target.ledger().orderBy("load").collect()}
    assert loads == {"[odd] {1}*.csv": "00000001", "part-0.csv": "00000001", "part-1.csv": "00000002", "one.csv": "00000003"}
    by_load = target.spark.table(target.name).groupBy(LOAD).count()
    assert {tuple(r) for r in by_load.collect()} == {("00000001", 4), ("00000002", 1), ("00000003", 2)}


def test_runs_that_end_halfway(target, tmp_path):
    write(tmp_path, "1.csv", ["1,x"])
    lost = target.stage(str(tmp_path))  # written, and never committed
    assert lost.rows == 1 and content(target) == [] and target.ledger().count() == 0
    assert run(target, tmp_path) == ["1.csv"]
    write(tmp_path, "2.csv", ["2,x"])
    target.commit(target.stage(str(tmp_path)))  # committed, and never shown
    assert content(target) == [("1", "x")]
    write(tmp_path, "3.csv", ["3,x"])
    assert run(target, tmp_path) == ["3.csv"]
    assert content(target) == [("1", "x"), ("2", "x"), ("3", "x")]
    assert target.publish() == []


def test_a_manifest_without_its_end_counts_for_nothing(target, tmp_path):
    write(tmp_path, "1.csv", ["1,x"])
    load = target.stage(str(tmp_path))
    lines = target.manifests.lines(load.number, entries(load))
    for cut in (lines[0][:20], lines[0]):
        folder = pathlib.Path(target.manifests.folder.removeprefix("file:"))
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{load.number}.json").write_text(cut)
        assert target.ledger().count() == 0 and target.publish() == []
    assert run(target, tmp_path) == ["1.csv"]
    assert content(target) == [("1", "x")]
    assert [r["load"] for r in target.ledger().collect()] == ["00000002"]


def test_two_runs_at_a_time(target, tmp_path):
    write(tmp_path, "1.csv", ["1,x"])
    first, second = target.stage(str(tmp_path)), target.stage(str(tmp_path))
    target.commit(first)
    with pytest.raises(RuntimeError, match="another run"):
        target.commit(second)
    assert run(target, tmp_path) == [] and content(target) == [("1", "x")]


def test_a_faulty_file_fails_the_load(target, tmp_path):
    write(tmp_path, "1.csv", ["1,x"])
    write(tmp_path, "2.csv", ["2,x,more"])
    with pytest.raises(ValueError, match="1 records with more than 2"):
        run(target, tmp_path)
    assert not target.exists() and target.ledger().count() == 0
    write(tmp_path, "2.csv", ["2,x"], header="a,c")
    with pytest.raises(ValueError, match="has columns"):
        run(target, tmp_path)
    write(tmp_path, "2.csv", ["2,x"])
    assert run(target, tmp_path) == ["1.csv", "2.csv"]


def test_large_files_in_splits(target, tmp_path):
    lines = [f'{i},"line {i}\nand ""more"""' for i in range(3000)]
    write(tmp_path, "1.csv", lines)
    assert append_folder(target.spark, str(tmp_path), target.table, target.database, split_bytes=0).count() == 1
    assert content(target) == sorted((str(i), f'line {i}\nand "more"') for i in range(3000))
