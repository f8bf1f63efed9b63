"""Files that a stream notices and loads once, whatever run ends where."""

import pathlib

import pytest
from test_append import content, write

from dustline import append_arrivals, append_folder
from dustline.plans.append import AppendTable
from dustline.streaming.arrivals import Arrivals


@pytest.fixture
def arrivals(spark, database, request, tmp_path):
    name = "arrive_" + request.node.name.split("[")[0]
    return Arrivals(spark, str(tmp_path), name, database)


def run(arrivals, batch_files=10_000):
    target = arrivals.target
    found = append_arrivals(
        arrivals.spark, arrivals.folder, target.table, target.database, batch_files=batch_files
    ).collect()
    return sorted((r["path"].rsplit("/", 1)[-1], r["load"], r["error"]) for r in found)


def test_a_growing_folder(arrivals, tmp_path):
    """Several runs give what one load of all files gives; nothing comes twice."""
    assert run(arrivals) == [] and not arrivals.target.exists()
    write(tmp_path, "one.csv", ["1,x", "2,NA"])
    write(tmp_path, "[odd] {1}*.csv", ["3,y"])
    write(tmp_path, "other.txt", ["5,z"])
    write(tmp_path, "empty.csv", [], header="").write_text("")
    assert run(arrivals) == [("[odd] {1}*.csv", "00000001", None), ("one.csv", "00000001", None)]
    assert run(arrivals) == []
    write(tmp_path, "parts.csv/part-0.csv", ["4,z"])
    write(tmp_path, "quotes.csv", ['5,"a\nb"'])
    assert [f[:2] for f in run(arrivals)] == [("part-0.csv", "00000002"), ("quotes.csv", "00000002")]
    assert run(arrivals) == []
    again = AppendTable(arrivals.spark, arrivals.target.table + "_again", arrivals.target.database)
    append_folder(again.spark, str(tmp_path), again.table, again.database)
    assert content(arrivals.target) == content(again)
    assert content(again) == [("1", "x"), ("2", ""), ("3", "y"), ("4", "z"), ("5", "a\nb")]
    # The other way in shares the ledger.
    target = arrivals.target
    assert append_folder(target.spark, str(tmp_path), target.table, target.database).count() == 0


def test_small_batches(arrivals, tmp_path):
    for i in range(5):
        write(tmp_path, f"{i}.csv", [f"{i},x"])
    assert [f[1] for f in run(arrivals, 2)] == ["00000001"] * 2 + ["00000002"] * 2 + ["00000003"]
    assert len(content(arrivals.target)) == 5 and run(arrivals, 2) == []


def test_runs_that_end_halfway(arrivals, tmp_path):
    write(tmp_path, "1.csv", ["1,x"])
    arrivals.notice()  # ends before it loads
    assert content(arrivals.target) == [] and arrivals.noticed().count() == 1
    write(tmp_path, "2.csv", ["2,x"])
    assert [f[0] for f in run(arrivals)] == ["1.csv", "2.csv"]
    write(tmp_path, "3.csv", ["3,x"])
    arrivals.notice()
    target = arrivals.target
    rows = target.unloaded(arrivals.noticed())
    target.stage_files(target.changed(rows))  # ends before its commit
    write(tmp_path, "4.csv", ["4,x"])
    arrivals.notice()
    rows = target.unloaded(arrivals.noticed())
    target.commit(target.stage_files(target.changed(rows)))  # ends before the table shows it
    assert len(content(target)) == 2
    assert run(arrivals) == []
    assert content(target) == [(str(i), "x") for i in range(1, 5)]


def test_a_batch_that_the_checkpoint_does_not_have(arrivals, tmp_path):
    """The stream ends between its sink's commit and its own: the batch comes again and is logged once."""
    write(tmp_path, "1.csv", ["1,x"])
    arrivals.notice()
    commits = pathlib.Path(arrivals.checkpoint.removeprefix("file:"), "commits")
    for file in [commits / "0", commits / ".0.crc"]:
        file.unlink(missing_ok=True)
    write(tmp_path, "2.csv", ["2,x"])
    assert [f[0] for f in run(arrivals)] == ["1.csv", "2.csv"]
    assert arrivals.noticed().count() == 2 and content(arrivals.target) == [("1", "x"), ("2", "x")]


def test_files_at_fault_are_set_aside(arrivals, tmp_path):
    for i in range(6):
        write(tmp_path, f"{i}.csv", [f"{i},x"])
    write(tmp_path, "3.csv", ["3,x,more"])
    write(tmp_path, "4.csv", ["4,x"], header="a,c")
    gone = write(tmp_path, "5.csv", ["5,x"])
    arrivals.notice()
    gone.unlink()
    found = {name: error for name, _, error in run(arrivals)}
    assert found.keys() == {f"{i}.csv" for i in range(6)}
    assert [found[f"{i}.csv"] for i in range(3)] == [None] * 3
    assert "more than 2" in found["3.csv"] and "has columns" in found["4.csv"] and found["5.csv"]
    assert content(arrivals.target) == [("0", "x"), ("1", "x"), ("2", "x")]
    assert run(arrivals) == [] and arrivals.set_aside().count() == 3
    write(tmp_path, "3-mended.csv", ["3,x"])
    assert run(arrivals)[0][0] == "3-mended.csv"


def test_names_are_noticed_without_reading_files(arrivals, tmp_path):
    write(tmp_path, "1.csv", ["1,x"])
    most = "spark.sql.sources.binaryFile.maxLength"  # reading a longer file is an error
    before = arrivals.spark.conf.get(most)
    arrivals.spark.conf.set(most, "4")
    try:
        arrivals.notice()
    finally:
        arrivals.spark.conf.set(most, before)
    assert arrivals.noticed().first()["size"] == len("a,b\n1,x\n")
