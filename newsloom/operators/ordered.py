"""Places of rows in the order of their group, and their neighbours, without a window over a group.

Rows are dealt by sampled ranges of (group, order), so a large group spreads over partitions. A
row's place is the place in its partition plus what the partitions before hold of its group,
which a sum of one row a partition and group tells. Neighbours meet in blocks of equally many
rows, and each block is lent the rows at its edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.lineage import checkpointed

#: Rows of a block, in which a task looks for neighbours.
BLOCK = 20_000


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """row (struct of the columns), group, place (from 0) and size of its group, overall (place among all).

    order: values that rise; they must tell all rows of a group apart, or equal ones come in any order. A null group is a
    group of its own.
    """
    given = rows.select(F.struct("*").alias("row"), F.col(group).alias("group"), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("order"))
    dealt = given.repartitionByRange(F.col("group"), F.col("order")).sortWithinPartitions("group", "order")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = checkpointed(dealt.select("row", "group", F.spark_partition_id().alias("part"), within.alias("at")))  # sampled ranges differ from run to run

    counts = dealt.groupBy("part", "group").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    counts = checkpointed(counts)  # a row a partition and group
    ahead = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    whole = Window.partitionBy("group")
    base = counts.select("part", "group", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size"))
    parts, start = [], 0
    for r in counts.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row a partition
        parts.append((r["part"], start))
        start += r["n"]
    starts = rows.sparkSession.createDataFrame(parts, "p int, start long")
    b, d = base.alias("b"), dealt.alias("d")
    joined = d.join(b, (F.col("d.part") == F.col("b.part")) & F.col("d.group").eqNullSafe(F.col("b.group"))).join(F.broadcast(starts), F.col("d.part") == F.col("p"))
    return joined.select("d.row", "d.group", (F.col("d.at") - F.col("first") + F.col("before")).alias("place"), "size", (F.col("start") + F.col("d.at")).alias("overall"))


def window_around(place: Column, size: Column, width: int) -> tuple[Column, Column]:
    """(first place, place behind the last) of the `width` rows around a place, held within the ends."""
    first = F.greatest(F.lit(0), F.least(place - width // 2, size - width))
    return first, F.least(size, first + width)


def neighbours(rows: DataFrame, group: str, order: list[Column], width: int = 5, block: int = BLOCK) -> DataFrame:
    """row, and others: the rows of the window of `width` around it in its group, itself left out, in order."""
    told = numbered(rows, group, order)
    own = F.floor(F.col("overall") / block).cast("long")
    reach = width - 1  # at a group's end the window lies on one side
    edges = F.array_distinct(F.array(own, F.floor((F.col("overall") - reach) / block).cast("long"), F.floor((F.col("overall") + reach) / block).cast("long")))
    lent = told.withColumn("own", own).select("*", F.explode(edges).alias("block")).where("block >= 0")
    near = Window.partitionBy("block").orderBy("overall").rowsBetween(-reach, reach)
    seen = lent.withColumn("near", F.collect_list(F.struct("group", "place", "row")).over(near)).where("block = own")
    first, after = window_around(F.col("place"), F.col("size"), width)
    kept = F.filter("near", lambda x: x["group"].eqNullSafe(F.col("group")) & (x["place"] >= F.col("first")) & (x["place"] < F.col("after")) & (x["place"] != F.col("place")))
    return seen.withColumns({"first": first, "after": after}).select("row", F.transform(kept, lambda x: x["row"]).alias("others"))
