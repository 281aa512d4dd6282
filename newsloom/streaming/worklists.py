"""Work lists that go on where they stopped: the stream's checkpoint remembers what is done.

Targets arrive as landed files and are worked in slices of some files. A key is worked once, in
whatever slice and run it comes first, since the checkpoint holds the keys. A slice whose work
fails is not passed: the next run begins with it, and its output takes its own place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.streaming.stores import records_sink


def lacks_latin_authors(authors: Column) -> Column:
    """No stored authors, or names in the translation's script alone: a fetch of the page may tell."""
    return authors.isNull() | (authors.rlike("[가-힣]") & ~authors.rlike("[A-Za-z]"))


def refetch_outcome(authors: Column, most: int = 6) -> Column:
    """What a page's authors are good for: found, none, or a list of contributors that is no byline."""
    return F.when(F.size(authors) > most, "list").when(F.size(authors) > 0, "found").otherwise("none")


def keyword_rows(names: DataFrame, name: str) -> DataFrame:
    """Searches for each name in titles."""
    return names.where(F.col(name) != "").select(F.col(name).alias("keyword"), F.lit("title").alias("target")).distinct()


def work_through(targets: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, name: str, failed: str | None = None) -> None:
    """Work on all targets that have arrived and not been worked; returns when there are none.

    targets: a stream with key; its options say how many files a slice has. work: from a slice's
    rows, a row a new key, to the rows to append under out. failed: a boolean column of work's rows; a
    slice with one that is true fails as a whole, to be tried again. Null keys are no targets.
    """
    write = records_sink(out, name)

    def slice_(batch: DataFrame, batch_id: int) -> None:
        done = work(batch)
        write(done, batch_id)
        if failed is not None:
            n = batch.sparkSession.read.parquet(out).where((F.col("stream") == name) & (F.col("batch") == batch_id) & F.col(failed)).count()
            if n:
                raise RuntimeError(f"{n} rows of slice {batch_id} failed")

    new = targets.where(F.col(key).isNotNull()).dropDuplicates([key])
    new.writeStream.foreachBatch(slice_).option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True).start().awaitTermination()
