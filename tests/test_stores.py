import os
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import state as S
from newsloom.streaming import stores as T

ROW = "url string, hash string, seq long, title_ko string, stage string"


def merge(old, new):
    return S.upsert(old, new, "url", "hash", ["seq"], ["title_ko"], ["stage"])


def sink(path, name="s"):
    return T.upsert_sink(str(path), ["url"], merge, F.col("seq"), name, 8)


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) if "/_" not in d for f in names if f.endswith(".parquet")}


def batches(rng, n=5):
    return [[(f"u{rng.randrange(40)}", f"h{rng.randrange(3)}", 100 * b + i, rng.choice([None, "ko"]), rng.choice("xyz")) for i in range(25)] for b in range(n)]


def content(spark, path):
    return sorted(map(str, T.read_store(spark, str(path)).select("url", "hash", "seq", "title_ko", "stage").collect()))


def test_batches_equal_a_fold_of_upserts(spark, tmp_path):
    want = {}
    for b, rows in enumerate(batches(random.Random(1))):
        sink(tmp_path)(spark.createDataFrame([*rows, (None, "h", 0, None, None)], ROW), b)
        last = {}
        for r in rows:
            last[r[0]] = max(last.get(r[0], r), r, key=lambda x: x[2])
        for url, new in last.items():
            old = want.get(url)
            want[url] = (url, new[1], new[2], old[3] if old[1] == new[1] else None, old[4]) if old else (url, new[1], new[2], None, new[4])
    got = sorted(tuple(r[c] for c in ("url", "hash", "seq", "title_ko", "stage")) for r in T.read_store(spark, str(tmp_path)).collect())
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in sorted(want.values())]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = batches(random.Random(2), 2)
    for b in (0, 1):
        sink(tmp_path)(spark.createDataFrame(rows[b], ROW), b)
    before, names = content(spark, tmp_path), files(tmp_path)
    for b in (1, 0):
        sink(tmp_path)(spark.createDataFrame(rows[b], ROW), b)
    assert content(spark, tmp_path) == before and files(tmp_path) == names


def test_untouched_files_keep_their_names(spark, tmp_path):
    first = [(f"u{i}", "h", i, None, "x") for i in range(200)]
    sink(tmp_path)(spark.createDataFrame(first, ROW), 0)
    before = files(tmp_path)
    sink(tmp_path)(spark.createDataFrame([("u7", "g", 999, None, "y")], ROW), 1)
    left = before & files(tmp_path)
    assert len({f.split(T.BUCKET)[1].split("/")[0] for f in before - left}) == 1 and len(left) >= 7
    got = {r.url: (r.hash, r.seq, r.stage) for r in T.read_store(spark, str(tmp_path)).collect()}
    assert len(got) == 200 and got["u7"] == ("g", 999, "x") and got["u8"] == ("h", 8, "x")
    sink(tmp_path)(spark.createDataFrame([], ROW), 2)
    assert before & files(tmp_path) == left


@pytest.mark.parametrize("half", [False, True])
def test_batch_that_broke_off_is_finished_from_its_journal(spark, tmp_path, monkeypatch, half):
    rows = batches(random.Random(3), 2)
    for path in ("good", "broken"):
        sink(tmp_path / path)(spark.createDataFrame(rows[0], ROW), 0)
    sink(tmp_path / "good")(spark.createDataFrame(rows[1], ROW), 1)
    real = T._note

    def stop(spark, path, what, name, batch):
        real(spark, path, what, name, batch)
        if what == "journaled":
            raise RuntimeError("the driver is lost")

    monkeypatch.setattr(T, "_note", stop)
    with pytest.raises(RuntimeError):
        sink(tmp_path / "broken")(spark.createDataFrame(rows[1], ROW), 1)
    monkeypatch.setattr(T, "_note", real)
    if half:  # buckets that the overwrite had removed and not yet put back
        for f in sorted(files(tmp_path / "broken"))[:2]:
            os.remove(f)
    sink(tmp_path / "broken")(spark.createDataFrame([], ROW), 1)
    journaled = {r.url for r in spark.read.parquet(f"{tmp_path}/broken/_journal").collect()}
    assert {x for x in content(spark, tmp_path / "good") if x.split("'")[1] in journaled} <= set(content(spark, tmp_path / "broken"))
    if not half:
        assert content(spark, tmp_path / "broken") == content(spark, tmp_path / "good")


def test_records_count_once(spark, tmp_path):
    write = T.records_sink(str(tmp_path), "freshness")
    for b in (0, 1, 1, 2):
        write(spark.createDataFrame([("a", b), ("b", b)], "source_id string, age int").where("age < 2"), b)
    got = spark.read.parquet(str(tmp_path)).select("source_id", "age", "stream", "batch").collect()
    assert sorted(map(tuple, got)) == [("a", 0, "freshness", 0), ("a", 1, "freshness", 1), ("b", 0, "freshness", 0), ("b", 1, "freshness", 1)]


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    rows = batches(random.Random(4), 4)
    (tmp_path / "in").mkdir()

    def arrive(k):
        spark.createDataFrame(rows[k], ROW).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        q = spark.readStream.schema(ROW).json(f"{tmp_path}/in").writeStream.foreachBatch(sink(tmp_path / "store")).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()

    for k in range(4):
        arrive(k)
        sink(tmp_path / "direct")(spark.createDataFrame(rows[k], ROW), k)
    assert content(spark, tmp_path / "store") == content(spark, tmp_path / "direct")
