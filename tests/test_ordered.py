import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import ordered as O


@pytest.mark.parametrize("n,block", [(400, 50), (400, 7), (3, 50), (0, 50)])
def test_neighbours_equal_lists(spark, n, block):
    rng = random.Random(n + block)
    rows = [(i, rng.choice(["hot", "hot", "hot", "cold", None, f"g{i}"]), rng.randrange(50)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, g string, t int").repartition(5).withColumns({"place": F.lit("own"), "group": F.lit("own"), "block": F.lit("own")})
    groups = {}
    for i, g, t in rows:
        groups.setdefault(g, []).append((t, i))
    want, places = {}, {}
    for members in groups.values():
        ids = [i for _, i in sorted(members)]
        for k, i in enumerate(ids):
            first = max(0, min(k - 2, len(ids) - 5))
            want[i] = [x for x in ids[first : first + 5] if x != i]
            places[i] = (k, len(ids))
    order = [F.col("t"), F.col("id")]
    assert {r.row.id: [o.id for o in r.others] for r in O.neighbours(df, "g", order, block=block).collect()} == want
    told = O.numbered(df, "g", order).collect()
    assert {r.row.id: (r.place, r.size) for r in told} == places and sorted(r.overall for r in told) == list(range(n))


def test_no_task_holds_a_large_group(spark):
    rows = spark.range(40_000).select("id", F.lit("one").alias("g"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        near = O.neighbours(rows, "g", [F.col("id")], block=1000)
        dealt = near.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in dealt) == 40_000
        assert near.where("size(others) = 4").count() == 40_000
        sizes = O.numbered(rows, "g", [F.col("id")]).agg(F.max("size"), F.max("place")).first()
        assert tuple(sizes) == (40_000, 39_999)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
