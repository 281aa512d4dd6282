"""Keyed state without MERGE: insert-ignore, the revision fold, upserts and patches.

Everything is keyed joins, windows or a fold over sorted partitions, so keys spread over the
cluster and reruns give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select(F.struct("*").alias("row"), rank.alias("rank")).where("rank = 1").select("row.*")


def insert_ignore(store: DataFrame, incoming: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of incoming to append: first of each key, keys of the store and NULL keys left out."""
    fresh = first_by(incoming.where(F.col(key).isNotNull()), [key], order)
    return fresh.join(store.select(key).distinct(), key, "left_anti")


DECISIONS = ("new", "duplicate", "changed", "upgrade", "blocked")


def classify(last: tuple | None, content: str, source: str, level: int) -> tuple[str, tuple]:
    """(decision, state) of one arrival; state: hash, revision, source, level."""
    if last is None:
        return "new", (content, 1, source, level)
    old, revision, owner, had = last
    if owner == source:
        if old == content:
            return "duplicate", last
        return "changed", (content, revision + 1, source, level)
    if level > had:
        return "upgrade", (content, revision + 1, source, level)
    return "blocked", last


def revision_fold(arrivals: DataFrame, partitions: int | None = None, seen: DataFrame | None = None, last_sources: list[str] = ()) -> DataFrame:
    """url, seq, decision and revision of every arrival, in order of seq, those of last_sources after all others.

    arrivals: url, seq, content_hash, source_id, body_level. seen: the stored state that the fold
    goes on from, a row a url: url, content_hash, revision, source_id, body_level. A partition is
    sorted by (url, turn, seq) and folded as it streams by, so a url's history is never held,
    however long it is.
    """
    turn = F.when(F.col("source_id").isin(list(last_sources)), 2).otherwise(1)
    rows = arrivals.select("url", "seq", "content_hash", "source_id", "body_level", turn.alias("turn"), F.lit(None).cast("int").alias("revision"))
    if seen is not None:
        none = F.lit(None).cast(arrivals.schema["seq"].dataType)
        rows = rows.unionByName(seen.select("url", none.alias("seq"), "content_hash", "source_id", "body_level", F.lit(0).alias("turn"), F.col("revision").cast("int").alias("revision")))
    dealt = rows.repartition(partitions, "url") if partitions else rows.repartition("url")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("url", "content_hash", "source_id", "body_level", "turn", "revision"))
            decisions, revisions, arrived = [], [], []
            for i, (u, h, s, n, t, r) in enumerate(zip(*columns, strict=True)):
                if u != at:
                    at, state = u, None
                if t == 0:
                    state = (h, r, s, n)
                    continue
                decision, state = classify(state, h, s, n)
                decisions.append(decision)
                revisions.append(state[1])
                arrived.append(i)
            which = pa.array(arrived, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("url").take(which), b.column("seq").take(which), pa.array(decisions, pa.string()), pa.array(revisions, pa.int32())], names=["url", "seq", "decision", "revision"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return dealt.sortWithinPartitions("url", "turn", "seq").mapInArrow(fold, f"url {kinds['url']}, seq {kinds['seq']}, decision string, revision int")


def newest_links(old: DataFrame, new: DataFrame, keys: list[str], at: str) -> DataFrame:
    """An upsert on a composite key: of old and new rows with one key the newest stays, new before old."""
    side = lambda rows, n: rows.select(F.struct(*old.columns).alias("row"), F.lit(n).alias("new"))
    best = F.row_number().over(Window.partitionBy(*[F.col(f"row.{k}") for k in keys]).orderBy(F.desc("new"), F.desc(f"row.{at}")))
    return side(old, 0).unionByName(side(new, 1)).withColumn("rank", best).where("rank = 1").select("row.*")


def upsert(old: DataFrame, new: DataFrame, key: str, hash_col: str, taken: list[str], reset: list[str], kept: list[str]) -> DataFrame:
    """old with new's rows: `taken` columns overwrite, `reset` columns fall to NULL where the hash changed, `kept` stay."""
    o, n = old.alias("o"), new.alias("n")
    there, given = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    same = F.col(f"o.{hash_col}") == F.col(f"n.{hash_col}")
    cols = [F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key)]
    cols += [F.when(given, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in [hash_col, *taken]]
    cols += [F.when(~given | same, F.col(f"o.{c}")).alias(c) for c in reset]
    cols += [F.when(there, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in kept]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*cols)


def patch(old: DataFrame, change: DataFrame, key: str, overwrite: list[str] = (), coalesce: list[str] = ()) -> DataFrame:
    """Keyed update: `overwrite` columns take the change even where it is NULL, `coalesce` only where it isn't."""
    joined = old.select(F.struct("*").alias("old")).join(change.select(F.struct(key, *overwrite, *coalesce).alias("new")), F.col(f"old.{key}") == F.col(f"new.{key}"), "left")
    there = F.col(f"new.{key}").isNotNull()
    value = {x: F.when(there, F.col(f"new.{x}")).otherwise(F.col(f"old.{x}")) for x in overwrite}
    value |= {x: F.coalesce(f"new.{x}", f"old.{x}") for x in coalesce}
    return joined.select(*[value.get(x, F.col(f"old.{x}")).alias(x) for x in old.columns])


def cleared(rows: DataFrame, listed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows with `columns` set to null where the key is listed."""
    mark = listed.select(F.col(key).alias("marked")).distinct()
    joined = rows.select(F.struct("*").alias("row")).join(mark, F.col(f"row.{key}") == F.col("marked"), "left")
    own = lambda c: F.col(f"row.{c}")
    return joined.select(*[(F.when(F.col("marked").isNull(), own(c)) if c in columns else own(c)).alias(c) for c in rows.columns])


def without_prefixes(rows: DataFrame, key: str, prefixes: list[str], least: int = 8) -> DataFrame:
    """rows whose key starts with none of the prefixes, a short list; shorter ones than `least` are an error."""
    for p in prefixes:
        if len(p) < least:
            raise ValueError(f"prefix of less than {least} letters: {p!r}")
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(F.col(key), F.lit(p))
    return rows.where(~out)


def match_by_title(targets: DataFrame, found: DataFrame) -> DataFrame:
    """targets with `found`, the url of the last row (by seq) of found that has exactly their title, blanks at the ends aside."""
    last = found.groupBy(F.trim("title").alias("said")).agg(F.max_by("url", "seq").alias("found"))
    joined = targets.select(F.struct("*").alias("row")).join(last, F.trim("row.title") == F.col("said"))
    return joined.select("row.*", "found")
