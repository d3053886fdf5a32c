"""Staging only what is new in a landing folder."""

import os

import pytest
from pyspark.sql import functions as F

import feedlake.sinks.arrivals as arrivals
from feedlake.plans import run_landing
from feedlake.sinks import read_file_ledger, stage_arrivals
from feedlake.sources import landing_manifest
from feedlake.workspace import new_dir
from tests.test_landing import SCHEMA, feed, land, rows

D1, D2 = "2024-01-01", "2024-01-02"


class Folder:
    def __init__(self, spark):
        self.spark, (self.names, self.spec) = spark, feed(spark)
        self.src, self.at, self.ledger = (new_dir(spark, d) for d in ("landing", "staged", "files"))

    def stage(self, schema=SCHEMA, **k):
        return stage_arrivals(self.spark, self.src, self.names["pre"], self.names["bad"], self.at, self.ledger, schema, "|", "csv", **k)

    def good(self):
        return rows(self.spark, self.names["pre"], "id", "v", "batchdate")

    def bad(self):
        return rows(self.spark, self.names["bad"], "rejected_line", "batchdate")


def flat(path, name, lines):
    os.makedirs(path.removeprefix("file:"), exist_ok=True)
    with open(f"{path.removeprefix('file:')}/{name}", "w") as f:
        f.write("".join(line + "\n" for line in lines))


def parsed_files(monkeypatch):
    """The files handed to the parser, call by call."""
    seen, plain = [], arrivals.landing_rows
    monkeypatch.setattr(arrivals, "landing_rows", lambda spark, paths, *a: seen.append(sorted(p.rsplit("/", 1)[1] for p in paths)) or plain(spark, paths, *a))
    return seen


def test_only_new_and_changed_files_are_parsed(spark, monkeypatch):
    f, seen = Folder(spark), parsed_files(monkeypatch)
    land(f.src, {D1: ["1|a", "x"], D2: ["2|b"]}, "a.csv")
    assert f.stage() == {D1: {"good": 1, "bad": 1}, D2: {"good": 1, "bad": 0}}
    assert f.stage() == {} and len(seen) == 1
    land(f.src, {D1: ["3|c", "y|y|y"]}, "b.csv")  # a new file of a staged batch: the other file's rows are carried over
    assert f.stage() == {D1: {"good": 2, "bad": 2}}
    assert f.good() == [(1, "a", D1), (2, "b", D2), (3, "c", D1)] and f.bad() == [("x", D1), ("y|y|y", D1)]
    land(f.src, {D1: ["10|A", "11|A"]}, "a.csv")  # mended: its rows and its bad line are replaced
    assert f.stage() == {D1: {"good": 3, "bad": 1}}
    assert f.good() == [(10, "A", D1), (11, "A", D1), (2, "b", D2), (3, "c", D1)] and f.bad() == [("y|y|y", D1)]
    assert seen == [["a.csv", "a.csv"], ["b.csv"], ["a.csv"]]
    assert f.stage() == {} and read_file_ledger(spark, f.ledger).count() == 4


def test_files_that_are_gone_stay_staged_and_blank_files_lose_their_rows(spark):
    f = Folder(spark)
    land(f.src, {D1: ["1|a"]}, "a.csv")
    land(f.src, {D1: ["2|b", "x"], D2: ["3|c"]}, "b.csv")
    f.stage()
    os.remove(f"{f.src.removeprefix('file:')}/batchdate={D1}/a.csv")
    land(f.src, {D1: [], D2: []}, "b.csv")
    assert f.stage() == {}  # Spark lists no file of no bytes: it counts as gone
    land(f.src, {D1: [""], D2: [""]}, "b.csv")
    assert f.stage() == {D1: {"good": 1, "bad": 0}, D2: {"good": 0, "bad": 0}}
    assert f.good() == [(1, "a", D1)] and f.bad() == []


def test_names_are_taken_as_they_are(spark):
    f = Folder(spark)
    odd = ["a b.csv", "a+b.csv", "a%20b.csv", "x[1].csv", "{p,q}.csv", "ü.csv", "x1.csv"]
    for i, name in enumerate(odd):
        land(f.src, {D1: [f"{i}|old", "bad"]}, name)
    f.stage()
    for i, name in enumerate(odd[:-1]):
        land(f.src, {D1: [f"{i}|newer"]}, name)
    assert f.stage() == {D1: {"good": 7, "bad": 1}}
    assert f.good() == [(i, "newer", D1) for i in range(6)] + [(6, "old", D1)]


def test_a_stop_before_the_ledger_is_written_stages_the_same_files_again(spark, monkeypatch):
    f = Folder(spark)
    land(f.src, {D1: ["1|a", "x"]}, "a.csv")
    f.stage()
    land(f.src, {D1: ["2|b", "y"]}, "b.csv")
    with monkeypatch.context() as m:
        m.setattr(arrivals, "swap_in_staged", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped before the swap")))
        with pytest.raises(RuntimeError):
            f.stage()
    assert f.good() == [(1, "a", D1)]
    with monkeypatch.context() as m:
        plain = arrivals.swap_in_staged
        m.setattr(arrivals, "swap_in_staged", lambda *a: plain(*a) and (_ for _ in ()).throw(RuntimeError("stopped after the swap")))
        with pytest.raises(RuntimeError):
            f.stage()
    assert f.good() == [(1, "a", D1), (2, "b", D1)]
    assert f.stage() == {D1: {"good": 2, "bad": 2}}
    assert f.good() == [(1, "a", D1), (2, "b", D1)] and f.bad() == [("x", D1), ("y", D1)] and f.stage() == {}


def test_one_batch_of_the_folders_and_flat_folders(spark):
    f = Folder(spark)
    land(f.src, {D1: ["1|a"], D2: ["2|b"]})
    assert f.stage(batch_date=D2) == {D2: {"good": 1, "bad": 0}} and f.good() == [(2, "b", D2)]
    assert f.stage() == {D1: {"good": 1, "bad": 0}}
    g, schema = Folder(spark), SCHEMA[:2]
    flat(g.src, "a.csv", ["1|a"])
    assert g.stage(schema, batch_date=D1) == {D1: {"good": 1, "bad": 0}}
    flat(g.src, "b.csv", ["2|b"])  # what has come in since is the next batch
    assert g.stage(schema, batch_date=D2) == {D2: {"good": 1, "bad": 0}}
    assert g.good() == [(1, "a", D1), (2, "b", D2)]
    with pytest.raises(ValueError, match="batch date"):
        g.stage(schema)
    flat(f"{g.src}/in", "c.csv", ["3|c"])
    flat(f"{g.src}/out", "c.csv", ["4|c"])
    with pytest.raises(ValueError, match="one name"):
        g.stage(schema, batch_date=D2)


def test_an_empty_landing_folder_makes_empty_tables(spark):
    f = Folder(spark)
    os.makedirs(f.src.removeprefix("file:"))
    assert f.stage() == {} and f.good() == [] and f.bad() == []


def test_the_latest_entry_of_a_path_counts(spark):
    schema = "path string, length bigint, modification_time timestamp"
    ledger = spark.sql("select 'p' path, 1L length, timestamp'2024-01-01' modification_time, 'p' source_file, 'd' batchdate, timestamp'2024-02-01' staged_at"
                       " union all select 'p', 2L, timestamp'2024-01-02', 'p', 'd', timestamp'2024-02-02'")
    listing = spark.sql("select 'p' path, 1L length, timestamp'2024-01-01' modification_time union all select 'p', 2L, timestamp'2024-01-02'"
                        " union all select 'q', 1L, timestamp'2024-01-01'")
    assert listing.schema.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"
    assert sorted(map(tuple, arrivals.new_arrivals(listing, ledger).select("path", "length").collect())) == [("p", 1), ("q", 1)]


def test_landing_to_history_by_arrivals(spark, monkeypatch):
    f, seen = Folder(spark), parsed_files(monkeypatch)
    run = lambda day: run_landing(spark, f.spec, day, f.src, f.names["bad"], f.at, "|", file_ledger=f.ledger)
    land(f.src, {D1: ["1|a", "2|b", "bad"]}, "a.csv")
    got = run(D1)
    assert (got["good"], got["bad"], got["delta"]) == (2, 1, 2)
    land(f.src, {D2: ["2|B"]}, "a.csv")
    assert (run(D2)["unchanged"], rows(spark, f.names["raw"], "id", "v")) == (1, [(1, "a"), (2, "B")])
    got = run(D2)  # nothing new: the batch is loaded again from the tables
    assert (got["good"], got["delta"]) == (1, 1) and len(seen) == 2


def test_the_listing_names_files_as_staged_rows_do(spark):
    f = Folder(spark)
    land(f.src, {D1: ["1|a"]}, "a b+%.csv")
    f.stage()
    listed = landing_manifest(spark, f.src, "csv").select("source_file")
    assert listed.exceptAll(spark.table(f.names["pre"]).select("source_file")).isEmpty() and listed.count() == 1
    assert spark.table(f.names["pre"]).where(F.col("source_file").isNull()).isEmpty()
