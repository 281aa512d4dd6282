"""Authors and publish times of pages: JSON-LD of any shape, then meta tags, then the time tag.

An Arrow pass reads the few tags from the HTML. JSON-LD is walked as VARIANT in Spark: each round
turns all nested nodes into their children, until none is left, so the shape and depth of a
page's data don't matter, and a node keeps its path, by which the values come in the order of a
walk from the top: an object's own value before those within it.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import items as I
from newsloom.functions import jsonld as J
from newsloom.operators.lineage import checkpointed

LD_TYPE = "application/ld+json"


class _Marks(HTMLParser):
    """JSON-LD scripts, the first author and publish-time meta tags, and the first time tag with a time."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.scripts: list[str] = []
        self.found: dict[str, str | None] = {}
        self._script: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(reversed(attrs))
        if tag == "script" and a.get("type") == LD_TYPE:
            self._script = []
        elif tag == "meta":
            for attr, name, as_ in (("name", "author", "author"), ("property", "article:published_time", "published")):
                if a.get(attr) == name:
                    self.found.setdefault(as_, a.get("content"))
        elif tag == "time" and "datetime" in a:
            self.found.setdefault("time", a["datetime"])

    def handle_endtag(self, tag: str) -> None:
        if tag == "script" and self._script is not None:
            self.scripts.append("".join(self._script))
            self._script = None

    def handle_data(self, data: str) -> None:
        if self._script is not None:
            self._script.append(data)


def page_marks(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """page (all columns but the HTML, in a struct), scripts (JSON-LD texts), author and published (meta), time (tag) of each page."""
    rest = F.struct(*[c for c in pages.columns if c != html_col])
    given = pages.select(rest.alias("page"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([given.schema["page"], T.StructField("scripts", T.ArrayType(T.StringType())), *[T.StructField(c, T.StringType()) for c in ("author", "published", "time")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = []
            for text in b.column(1).to_pylist():
                m = _Marks()
                m.feed(text or "")
                m.close()
                marks.append(m)
            found = [pa.array([m.found.get(c) for m in marks], pa.string()) for c in ("author", "published", "time")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.scripts for m in marks], pa.list_(pa.string())), *found], names=schema.names)

    return given.mapInArrow(run, schema)


def _own_authors(object_entries: Column) -> Column:
    """Names that an object gives as its author: texts, and names of objects, one or a list."""
    said = F.filter(F.array(J.value_of(object_entries, "author")), lambda v: v.isNotNull())
    each = F.flatten(F.transform(said, lambda v: F.coalesce(J.elements(v), F.array(v))))
    return F.array_compact(F.transform(each, lambda v: F.coalesce(J.plain_string(J.value_of(J.entries(v), "name")), J.plain_string(v))))


def walk(scripts: DataFrame) -> DataFrame:
    """key, path, authors and date (datePublished) of every object in the JSON-LD that has either. scripts: key (long), scripts.

    Each round is a narrow pass over the nested nodes of one depth and a checkpoint of their children.
    """
    roots = scripts.select("key", F.posexplode("scripts").alias("at", "json"))
    level = roots.select("key", F.array("at").alias("path"), J.ordered_variant(F.col("json")).alias("node")).where("node IS NOT NULL")
    out = scripts.sparkSession.createDataFrame([], "key long, path array<int>, authors array<string>, date string")
    while True:
        level = level.select("key", "path", J.entries(F.col("node")).alias("object"), J.elements(F.col("node")).alias("list"))
        level = checkpointed(level.where("object IS NOT NULL OR list IS NOT NULL"))
        if level.isEmpty():
            return out
        own = level.where("object IS NOT NULL").select("key", F.concat("path", F.array(F.lit(-1))).alias("path"), _own_authors(F.col("object")).alias("authors"), J.plain_string(J.value_of(F.col("object"), "datePublished")).alias("date"))
        out = out.unionByName(own.where("size(authors) > 0 OR date IS NOT NULL"))
        children = F.coalesce(F.transform("object", lambda e: e["value"]), F.col("list"))
        level = level.select("key", "path", F.posexplode(children).alias("at", "node")).select("key", F.concat("path", F.array("at")).alias("path"), "node")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _unescaped(names: pd.Series) -> pd.Series:
    """HTML entities of names turned into their characters."""
    return names.map(lambda ns: [html.unescape(n) for n in ns])


def normal_authors(names: Column) -> Column:
    """Single names in order, each once: entities undone, lists of names split, empty ones and addresses left out."""
    trimmed = lambda n: F.regexp_replace(n, r"(?U)^\s+|\s+$", "")
    plain = _unescaped(F.transform(F.filter(names, lambda n: n.isNotNull()), trimmed))
    parts = F.flatten(F.transform(plain, lambda n: F.transform(F.split(n, r"(?U)\s*[,&]\s*|\s+and\s+"), trimmed)))
    return F.array_distinct(F.filter(parts, lambda p: (p != "") & ~F.lower(p).rlike("^https?://")))


def page_bylines(pages: DataFrame, html_col: str = "html", fetched: str | None = None) -> DataFrame:
    """The pages' other columns with authors, published_at (UTC) and precision ('time' or 'day').

    Authors: those of the JSON-LD, else of the author meta tag. Time: the first date of the
    JSON-LD that can be read; without any date there, that of the meta tag, then of the time tag.
    fetched: a column of pages; a time more than an hour past it is a misreading and left out.
    Pages without HTML have no authors and no time; repeated rows and null keys are pages of their own.
    """
    marks = checkpointed(page_marks(pages, html_col).withColumn("key", F.monotonically_increasing_id()))
    found = walk(marks.where("size(scripts) > 0").select("key", "scripts"))
    per_page = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("path", "authors", "date"))).alias("ld"))
    none = F.array().cast("array<string>")
    said = F.coalesce(F.flatten(F.transform("ld", lambda x: x["authors"])), none)
    dates = F.coalesce(F.filter(F.transform("ld", lambda x: x["date"]), lambda d: d.isNotNull()), none)
    dates = F.when(F.size(dates) > 0, dates).otherwise(F.array_compact(F.array(F.coalesce(F.nullif("published", F.lit("")), F.col("time")))))
    first = F.try_element_at(F.filter(F.transform(dates, I.parsed_date), lambda p: p.isNotNull()), F.lit(1))
    rows = marks.join(per_page, "key", "left").select("page", normal_authors(said).alias("ld_authors"), normal_authors(F.array_compact(F.array("author"))).alias("meta_authors"), first.alias("at"))
    late = F.lit(False) if fetched is None else F.coalesce(F.col("at.at") > F.timestamp_add("HOUR", F.lit(1), F.col(f"page.{fetched}")), F.lit(False))
    authors = F.when(F.size("ld_authors") > 0, F.col("ld_authors")).otherwise(F.col("meta_authors"))
    return rows.select("page.*", authors.alias("authors"), *[F.when(~late, F.col(f"at.{c}")).alias(n) for c, n in (("at", "published_at"), ("precision", "precision"))])
