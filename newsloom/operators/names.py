"""Names of a dictionary of any size in texts: an index of character grams, joined and verified in place.

The dictionary is a table, so the plan is the same for ten names or a million. A name is indexed
by one of its grams, the one that fewest names of the dictionary have, with its place in the
name. An index of bounded size goes to the texts, and no text's grams leave their task; for a larger
one a text gives the grams at all of its places to a shuffle, with the characters around each that
the longest name may need. What the join finds is compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.lineage import checkpointed

#: Lengths of grams; a name is indexed by the longest that it has.
GRAMS = (1, 2, 4, 8)
#: Largest index that goes to the texts: names, and characters of all names.
SENT_NAMES, SENT_CHARS = 1_000_000, 32_000_000


def _grams(text: Column, size: int) -> Column:
    """(at, gram) of every gram of a text, from 1."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.substr(text, i, F.lit(size)).alias("gram")))


def gram_index(names: DataFrame) -> DataFrame:
    """name, size, gram, offset: of each name its rarest gram in the dictionary, and where it stands in it (from 0). names: name."""
    given = checkpointed(names.select("name").where("name <> ''").distinct())
    size, grams = F.lit(GRAMS[0]), _grams(F.col("name"), GRAMS[0])
    for g in GRAMS[1:]:
        size = F.when(F.length("name") >= g, g).otherwise(size)
        grams = F.when(F.length("name") >= g, _grams(F.col("name"), g)).otherwise(grams)
    every = given.select("name", size.cast("int").alias("size"), F.explode(grams).alias("g"))
    every = every.select("name", "size", "g.gram", (F.col("g.at") - 1).alias("offset"))
    common = every.groupBy("size", "gram").agg(F.count_distinct("name").alias("n"))
    rare = F.min(F.struct("n", "offset", "gram"))
    return every.join(common, ["size", "gram"]).groupBy("name", "size").agg(rare.alias("r")).select("name", "size", "r.gram", "r.offset")


def name_places(texts: DataFrame, names: DataFrame, key: str, text: str, sent_names: int = SENT_NAMES) -> DataFrame:
    """key, name, at (from 1): every place of every name in the texts, also within each other.

    texts: key, text. names: name. Null and empty texts and names are nowhere; repeated names count
    once, repeated texts each for itself. An index of more than sent_names names is shuffled.
    """
    index = checkpointed(gram_index(names))
    bounds = index.agg(F.max("offset").alias("offset"), F.max(F.length("name")).alias("length"), F.collect_set("size").alias("sizes"), F.count("*").alias("n"), F.sum(F.length("name")).alias("chars")).first()  # one row, four sizes at most
    given = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text <> ''")
    if not bounds["sizes"]:
        return given.select(F.col("key").alias(key), F.lit("").alias("name"), F.lit(1).alias("at")).where("false")
    if bounds["n"] <= sent_names and bounds["chars"] <= SENT_CHARS:
        found = _beside_texts(given, index, sorted(bounds["sizes"]))
    else:
        found = _beside_index(given, index, sorted(bounds["sizes"]), bounds["offset"], bounds["length"])
    return found.select(F.col("key").alias(key), "name", "at")


def _beside_texts(given: DataFrame, index: DataFrame, sizes: list[int]) -> DataFrame:
    """key, name, at, with the index sent to each task; its keys are hashes of grams, names are compared in full."""
    hashed = lambda size, gram: F.xxhash64(F.lit(size) if isinstance(size, int) else size, gram)
    sent = F.broadcast(index.select(hashed(F.col("size"), F.col("gram")).alias("hash"), "name", "offset"))
    last = F.length("text") - sizes[0] + 1
    places = given.select("key", "text", F.explode(F.when(last > 0, F.sequence(F.lit(1), last))).alias("at"))
    longest = places.withColumn("gram", F.substr("text", F.col("at"), F.lit(sizes[-1])))
    grams = longest.select("key", "text", "at", F.explode(F.array(*[hashed(size, F.substr("gram", F.lit(1), F.lit(size))) for size in sizes])).alias("hash"))
    start = F.col("at") - F.col("offset")
    same = (start >= 1) & (F.substr("text", start, F.length("name")) == F.col("name"))
    return grams.join(sent, "hash").where(same).select("key", "name", start.alias("at"))


def _beside_index(given: DataFrame, index: DataFrame, sizes: list[int], before: int, after: int) -> DataFrame:
    """The same with the texts' grams shuffled to the index. before, after: characters that a name may have before and from its gram."""
    around = lambda t, at: F.substr(t, F.greatest(F.lit(1), at - before), F.lit(before + after))
    parts = None
    for size in sizes:
        grams = given.select("key", F.explode(F.transform(_grams(F.col("text"), size), lambda g: F.struct(g["at"].alias("at"), g["gram"].alias("gram"), around(F.col("text"), g["at"]).alias("around")))).alias("g"))
        part = grams.select("key", F.lit(size).alias("size"), "g.*")
        parts = part if parts is None else parts.unionByName(part)
    found = parts.join(index, ["size", "gram"])
    start = F.col("at") - F.col("offset")  # of the name in the text
    within = start - F.greatest(F.lit(1), F.col("at") - before) + 1  # and in what was kept around the gram
    same = (start >= 1) & (F.substr("around", within, F.length("name")) == F.col("name"))
    return found.where(same).select("key", "name", start.alias("at"))


def longest_names(texts: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    """key, name: the longest name in each text that has any; of equals the least."""
    best = F.min(F.struct((-F.length("name")).alias("n"), "name"))
    return name_places(texts, names, key, text).groupBy(key).agg(best.alias("b")).select(key, "b.name")


def protagonists(texts: DataFrame, names: DataFrame, turns: DataFrame, key: str, text: str) -> DataFrame:
    """key, name: the name that first stands after the first word of `turns` in the text, else the first name; at one place the least.

    names and turns: name. Only a name's first place counts. Texts without a name are left out.
    """
    turn = name_places(texts, turns, key, text).groupBy(F.col(key).alias("turn_key")).agg(F.min("at").alias("turn"))
    first = name_places(texts, names, key, text).groupBy(key, "name").agg(F.min("at").alias("at"))
    found = first.join(turn, F.col(key) == F.col("turn_key"), "left")
    behind = F.coalesce(F.col("at") > F.col("turn"), F.lit(False))
    best = F.min(F.struct((~behind).alias("before"), "at", "name"))
    return found.groupBy(key).agg(best.alias("b")).select(key, "b.name")
