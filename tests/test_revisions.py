import json
import os
import random

import pytest

from newsloom.operators import state as S
from newsloom.streaming import revisions as V

ITEM = "url string, seq long, content_hash string, source_id string, body_level int, fetched_at timestamp"
STORED = "url string, content_hash string, revision int, source_id string, body_level int, fetched_at timestamp"


@pytest.fixture
def rocksdb(spark):
    key, value = next(iter(V.ROCKSDB.items()))
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    yield spark
    spark.conf.set(key, before) if before else spark.conf.unset(key)


def run(spark, folder, batches, stored, **options):
    """Rows of each batch, a file each, through the stream."""
    (folder / "in").mkdir()
    names = [f.split(" ")[0] for f in ITEM.split(", ")]
    for k, rows in enumerate(batches):
        file = folder / "in" / f"{k}.json"
        file.write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in rows))
        os.utime(file, (1_700_000_000 + 60 * k,) * 2)
    items = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    seen = spark.createDataFrame(stored, STORED.replace("fetched_at timestamp", "fetched_at string")) if stored else None
    name = f"decided_{folder.name}"
    q = V.revisions_from(items, seen, **options).writeStream.format("memory").queryName(name).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted(map(tuple, spark.table(name).collect()), key=lambda r: r[1])


def day(n):
    return f"2024-{1 + n // 28:02d}-{1 + n % 28:02d} 00:00:00"


def test_stream_over_stored_state_is_the_batch_fold(rocksdb, tmp_path):
    rng = random.Random(2)
    rows = [(f"u{rng.randrange(12)}", i, f"h{rng.randrange(4)}", rng.choice("ab"), rng.randrange(3), day(0)) for i in range(200)]
    stored = [(f"u{i}", "h1", 4, "a", 1, day(0)) for i in range(0, 12, 2)]
    got = run(rocksdb, tmp_path, [rows[:70], rows[70:75], rows[75:]], stored)
    arrivals = rocksdb.createDataFrame([r[:5] for r in rows], ITEM.rsplit(", ", 1)[0])
    seen = rocksdb.createDataFrame([r[:5] for r in stored], STORED.rsplit(", ", 1)[0])
    assert got == sorted(map(tuple, S.revision_fold(arrivals, 2, seen=seen).collect()), key=lambda r: r[1])


def test_last_sources_of_a_batch_come_last(rocksdb, tmp_path):
    rows = [("u", 0, "h1", "late", 0, day(0)), ("u", 1, "h2", "b", 0, day(0))]
    assert run(rocksdb, tmp_path, [rows], [], last_sources=["late"]) == [("u", 0, "blocked", 1), ("u", 1, "new", 1)]


@pytest.mark.parametrize("idle", [None, 30])
def test_idle_urls_are_forgotten(rocksdb, tmp_path, idle):
    stored = [("kept", "h1", 7, "a", 0, day(0)), ("busy", "h1", 3, "a", 0, day(0))]
    batches = [
        [("seen", 0, "h1", "a", 0, day(0)), ("busy", 1, "h1", "a", 0, day(25))],
        [("busy", 2, "h2", "a", 0, day(50))],
        [("clock", 3, "h", "a", 0, day(60))],
        [("clock", 4, "h", "a", 0, day(61))],
        [("seen", 5, "h1", "a", 0, day(62)), ("kept", 6, "h1", "a", 0, day(62)), ("busy", 7, "h2", "a", 0, day(62)), (None, 8, "h2", "a", 0, day(62))],
    ]
    got = {(u, s): (d, r) for u, s, d, r in run(rocksdb, tmp_path, batches, stored, idle_days=idle)}
    assert [got["busy", k] for k in (1, 2, 7)] == [("duplicate", 3), ("changed", 4), ("duplicate", 4)]  # its timer moves on
    assert got["seen", 0] == ("new", 1)
    assert got["seen", 5] == (("new", 1) if idle else ("duplicate", 1))
    assert got["kept", 6] == (("new", 1) if idle else ("duplicate", 7))
    assert (None, 8) not in got


def test_a_url_costs_one_read_and_one_write_of_its_state():
    from pyspark.sql import Row

    calls, kept = [], {}
    names = "deleteTimer registerTimer exists get update".split()
    record = {n: lambda *a, n=n: (calls.append(n), kept.update(v=a[0]) if n == "update" else None, kept.get("v") if n == "get" else None)[2] for n in names}
    state = type("State", (), {k: staticmethod(f) for k, f in record.items()})
    machine = V.Revisions(1000)
    machine.handle, machine.state = state, state
    machine.handleInitialState(("u",), Row(content_hash="a", revision=5, source_id="s", body_level=1, seen_ms=10), None)
    assert calls == ["registerTimer", "update"] and kept["v"] == ("a", 5, "s", 1, 1010)
    rows = [Row(turn=1, seq=s, content_hash=h, source_id="s", body_level=1, seen_ms=20) for s, h in ((2, "b"), (1, "a"))]
    assert [(r.seq, r.decision, r.revision) for r in machine.handleInputRows(("u",), iter(rows), None)] == [(1, "duplicate", 5), (2, "changed", 6)]
    assert calls[2:] == ["get", "deleteTimer", "registerTimer", "update"] and kept["v"] == ("b", 6, "s", 1, 1020)
