import json
import os

import pytest
from pyspark.sql import functions as F

from newsloom.operators.converge import converge
from newsloom.streaming import worklists as W


def arrive(folder, k, keys):
    folder.mkdir(exist_ok=True)
    (folder / f"{k}.json").write_text("\n".join(json.dumps({"url": u}) for u in keys))
    os.utime(folder / f"{k}.json", (1_700_000_000 + 60 * k,) * 2)


def test_stop_and_restart_give_each_key_once(spark, tmp_path):
    worked, broken = [], {"on": True}

    def work(batch):
        keys = sorted(r.url for r in batch.collect())
        worked.append(keys)
        if "c" in keys and broken["on"]:
            raise RuntimeError("stopped in the middle")
        return batch.select("url", F.length("url").alias("n"))

    def run():
        targets = spark.readStream.schema("url string").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
        W.work_through(targets, "url", work, f"{tmp_path}/out", f"{tmp_path}/state", "list")

    arrive(tmp_path / "in", 0, ["a", "b", "a"])
    arrive(tmp_path / "in", 1, ["b", "c", None])
    arrive(tmp_path / "in", 2, ["d", "a"])
    with pytest.raises(Exception, match="stopped in the middle"):
        run()
    broken["on"] = False
    run()
    arrive(tmp_path / "in", 3, ["e", "c"])
    run()
    run()
    got = [r.url for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == ["a", "b", "c", "d", "e"]
    assert [k for k in worked if k] == [["a", "b"], ["c"], ["c"], ["d"], ["e"]]


def test_a_slice_with_failures_is_tried_again(spark, tmp_path):
    tries = {"n": 0}

    def work(batch):
        tries["n"] += 1
        return batch.select("url", F.lit(tries["n"]).alias("turn"), ((F.col("url") == "b") & F.lit(tries["n"] == 1)).alias("failed"))

    arrive(tmp_path / "in", 0, ["a", "b"])
    run = lambda: W.work_through(spark.readStream.schema("url string").json(f"{tmp_path}/in"), "url", work, f"{tmp_path}/out", f"{tmp_path}/state", "strict", failed="failed")
    with pytest.raises(Exception, match="1 rows of slice 0 failed"):
        run()
    run()
    assert sorted((r.url, r.failed) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", False), ("b", False)]


def test_predicates(spark):
    rows = spark.createDataFrame([(None,), ('["사카"]',), ('["사카 A"]',), ("[]",), ('["Ann"]',)], "a string")
    assert [r.x for r in rows.select(W.lacks_latin_authors(F.col("a")).alias("x")).collect()] == [True, True, False, False, False]
    lists = spark.createDataFrame([([],), (["a"],), (["a"] * 6,), (["a"] * 7,)], "a array<string>")
    assert [r.x for r in lists.select(W.refetch_outcome(F.col("a")).alias("x")).collect()] == ["none", "found", "found", "list"]
    names = spark.createDataFrame([("a",), ("a",), ("",), (None,)], "n string")
    assert [tuple(r) for r in W.keyword_rows(names, "n").collect()] == [("a", "title")]


def test_passes_end_when_all_is_in_order(spark):
    seen = []

    def halve(rows, n):
        seen.append((n, rows.count()))
        return rows.withColumn("x", F.floor(F.col("x") / 2))

    rows = spark.createDataFrame([(1, 1), (2, 4), (3, 9), (4, 1000), (5, None)], "id int, x long")
    got = {r.id: (r.x, r.passes, r.settled) for r in converge(rows, F.col("x") > 1, halve, 4).collect()}
    assert got == {1: (1, 0, True), 2: (1, 2, True), 3: (1, 3, True), 4: (62, 4, False), 5: (None, 0, True)}
    assert seen == [(0, 3), (1, 3), (2, 2), (3, 1)]
    seen.clear()
    assert converge(rows.where("id < 3"), F.col("x") > 1, halve, 9).where("settled").count() == 2 and len(seen) == 2
