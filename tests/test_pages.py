import html as entities
import json
import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from newsloom.functions import items as I
from newsloom.operators import pages as P

LD = "<script type=\"application/ld+json\">%s</script>"


def authors_of(node):
    """An object's own author before all that stands within it."""
    out = []
    if isinstance(node, dict):
        said = node.get("author")
        for a in said if isinstance(said, list) else [said]:
            name = a.get("name") if isinstance(a, dict) else a
            out += [name] if isinstance(name, str) else []
    for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else []:
        out += authors_of(child)
    return out


def singles(names):
    parts = [p.strip() for n in names for p in re.split(r"\s*[,&]\s*|\s+and\s+", entities.unescape(n.strip()))]
    return list(dict.fromkeys(p for p in parts if p and not re.match("(?i)https?://", p)))


def tree(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice(["x", 1, None, True, 2.5, "Al Bo", "q\"uo\\te {a: [", "{\"author\":\"not me\"}", "é ñ"])
    if rng.random() < 0.3:
        return [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    keys = rng.sample(["z", "a", "@graph", "name", "author", "k\"ey", "m"], rng.randint(0, 4))
    node = {k: tree(rng, depth - 1) for k in keys}
    if rng.random() < 0.5:
        person = lambda: rng.choice([{"name": rng.choice("ABCD") + " " + rng.choice("wxyz")}, "P " + rng.choice("abc"), "A & B, C and Dan", "O&#39;N", {"name": 3}, 7, None, "", " https://x.test"])
        node["author"] = rng.choice([person(), [person() for _ in range(rng.randint(0, 3))]])
    return node


def test_walk_is_that_of_a_json_reader(spark):
    rng = random.Random(5)
    pages = []
    for i in range(150):
        nodes = [tree(rng, rng.randint(1, 7)) for _ in range(rng.randint(0, 3))]
        texts = [json.dumps(n, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])) for n in nodes]
        broken = rng.random() < 0.3
        pages.append((i, "<html><head>" + "".join(LD % t for t in texts) + LD % "{broken" * broken + "<meta name=author content='Meta One &amp; Two'></head></html>", [a for n in nodes for a in authors_of(n)]))
    got = {r.k: r.authors for r in P.page_bylines(spark.createDataFrame([p[:2] for p in pages], "k int, html string")).collect()}
    for i, _, names in pages:
        assert got[i] == (singles(names) or ["Meta One", "Two"]), i


CASES = [
    (LD % '{"@graph":[{"@type":"WebPage"},{"author":{"name":"Raf T"}}]}', ["Raf T"]),
    (LD % '{"author":"One","author":"Two"}', ["Two"]),
    (LD % '{"b":1,"author":"Line\x1fbreak","a":NaN,"c":-Infinity}', ["Line\x1fbreak"]),
    (LD % '{"author":"Alexander Land and Bo"}', ["Alexander Land", "Bo"]),
    (LD % '{"author":"A"} "' + LD % '{"author":"B"}, 1' + LD % '{"author":"C"}],[2', []),
    (LD % "" + LD % "[]" + LD % "3" + LD % '"author"', []),
    ('<script>var x = {"author":"No"}</script><meta name="author" content="">', []),
    ('<meta name="author" content="First"><meta name="author" content="Second">', ["First"]),
    (f"<!-- {LD % '{}'} -->", []),
    (LD % ("[" * 20 + '{"author":"Deep"}' + "]" * 20), ["Deep"]),
    (LD % json.dumps({f"k{i}": {"author": f"N{i}"} for i in range(300)}), [f"N{i}" for i in range(300)]),
    (LD % json.dumps({"text": "a\\\"" * 50_000, "author": "Long"}), ["Long"]),
    (None, []),
]


def test_authors(spark):
    pages = spark.createDataFrame([(i, html) for i, (html, _) in enumerate(CASES)], "k int, html string")
    got = {r.k: r.authors for r in P.page_bylines(pages).collect()}
    assert [got[i] for i in range(len(CASES))] == [authors for _, authors in CASES]


def test_times(spark):
    rows = [
        (LD % '{"datePublished":"2026-07-19T14:30:00+01:00"}', datetime(2026, 7, 19, 13, 30), "time"),
        (LD % '{"a":{"datePublished":"soon"},"datePublished":7,"b":[{"datePublished":"2026-07-19"}]}', datetime(2026, 7, 19), "day"),
        (LD % "{broken json" + '<meta property="article:published_time" content="2026-07-19T07:40:00+00:00">', datetime(2026, 7, 19, 7, 40), "time"),
        ('<meta property="article:published_time" content=""><time datetime="2026-07-18T22:00:00Z">x</time>', datetime(2026, 7, 18, 22), "time"),
        (LD % '{"datePublished":"soon"}' + '<time datetime="2026-07-18T22:00:00Z">x</time>', None, None),
        (LD % '{"datePublished":"20260719T143000Z"}', datetime(2026, 7, 19, 14, 30), "time"),
        (LD % '{"datePublished":"2026-07-20T02:00:00Z"}', None, None),  # past the fetch
]
    pages = spark.createDataFrame([(i, r[0], datetime(2026, 7, 19, 23)) for i, r in enumerate(rows)], "k int, html string, at timestamp_ntz")
    got = {r.k: (r.published_at, r.precision) for r in P.page_bylines(pages, fetched="at").collect()}
    assert [got[i] for i in range(len(rows))] == [r[1:] for r in rows]


def test_date_shapes(spark):
    shapes = {"2026-07-19T14:30:00.123Z": "2026-07-19 14:30:00.123", "2026-07-19 14:30": "2026-07-19 14:30:00", "2026-07-19T14:30:00+0100": "2026-07-19 13:30:00", "Sun, 19 Jul 2026 14:30:00 +0000": "2026-07-19 14:30:00", "July 19, 2026": "2026-07-19 00:00:00", "2026/07/19": "2026-07-19 00:00:00", "x": None}
    got = spark.createDataFrame([(s,) for s in shapes], "s string").select("s", I.parsed_date(F.col("s")).alias("p")).select("s", F.col("p.at").cast("string").alias("at")).collect()
    assert {r.s: r.at for r in got} == shapes


def test_clashing_columns_and_repeated_rows(spark):
    row = (None, LD % '{"author":"Ann"}', "s", "a", "p", "t", "k")
    pages = spark.createDataFrame([row, row], "page_id int, html string, scripts string, author string, published string, time string, key string")
    got = P.page_bylines(pages).collect()
    assert [(r.page_id, r.authors, r.author, r.key) for r in got] == [(None, ["Ann"], "a", "k")] * 2
    assert P.page_bylines(pages.where("false")).count() == 0
