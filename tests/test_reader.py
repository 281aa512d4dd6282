import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newsloom.functions import vocab as V
from newsloom.operators import facets as A
from newsloom.operators import reader as R

SOURCES = "source_id string, outlet string, display_name string, label string, is_x boolean, tier double"
DIRECTORY = "key string, name string, outlet string, place int"
ROWS = "article_id long, position long, source_id string, outlet string, journalist string, authors array<string>, team string, tier double, stage string, direction string, badge boolean"
fold = lambda s: "".join(s.split()).lower()


class Sidebar:
    """The sidebar by loops over articles, from the rules as the docstrings state them."""

    def __init__(self, sources, directory, outlets, people_tiers, outlet_tiers):
        self.sources = {s[0]: dict(zip(("outlet", "display", "label", "x", "tier"), s[1:], strict=True)) for s in sources}
        self.people = {k: (n, o, True) for k, n, o, _ in directory}
        self.order = list({n: (n, o, True) for _, n, o, _ in sorted(directory, key=lambda d: d[3])}.values())
        self.outlets, self.people_tiers, self.outlet_tiers = dict(outlets), dict(people_tiers), dict(outlet_tiers)

    def spelt(self, rows):
        count = Counter(n for r in rows for n in {r["journalist"] or "", *(r["authors"] or [])} if n and fold(n) not in self.people)
        groups = defaultdict(list)
        for n in count:
            groups[fold(n)].append(n)
        return {k: (min(ns, key=lambda n: (-count[n], n.isupper(), n)), None, False) for k, ns in groups.items() if len(ns) > 1}

    def shown(self, r, s):
        if r["outlet"]:
            return self.outlets.get(fold(r["outlet"]), r["outlet"])
        j = (r["journalist"] or "").strip()
        if s.get("x"):
            if fold(j) in self.people and self.people[fold(j)][1]:
                return self.people[fold(j)][1]
            if fold(j.lstrip("@")) in self.outlets:
                return self.outlets[fold(j.lstrip("@"))]
        return s.get("outlet") or s.get("display") or r["source_id"] or ""

    def view(self, n, r, s, known):
        own = self.shown(r, s) if r["outlet"] else None
        entry = known.get(fold(n))
        if entry is None:
            hits = [(m.start(), k, e) for k, e in enumerate(self.order) if (m := re.search(rf"(?<!\w){re.escape(e[0].lower())}(?!\w)", n.lower()))]
            entry = min(hits)[2] if hits else None
        if entry and entry[2]:
            outlet = self.outlets.get(fold(entry[1]), entry[1]) if entry[1] else own
            name = entry[0]
        else:
            name, outlet = entry[0] if entry else n, own or s.get("outlet")
            if outlet and name.lower().startswith(outlet.lower() + "."):
                name = outlet
        if n == s.get("label") or name == outlet or name.endswith(")") or name.lower() == (s.get("display") or "").lower():
            outlet = None
        return name, outlet or None, bool(entry and entry[2])

    def views(self, r, known):
        s, authors, j = self.sources.get(r["source_id"], {}), [a for a in r["authors"] or [] if a], (r["journalist"] or "").strip()
        if not j or (j != s.get("label") and authors and j not in authors):
            j = next((a for a in authors if fold(a) in known), authors[0] if authors else "")
        out = {}
        for n in [j] * bool(j) + (authors if j and j != s.get("label") else []):
            v = self.view(n, r, s, known)
            out.setdefault(v[0], v)
        return list(out.values())

    def facets(self, rows):
        known = self.spelt(rows) | self.people
        n, tier, solo, at = Counter(), {}, set(), defaultdict(Counter)
        for r in sorted(rows, key=lambda r: r["position"]):
            s = self.sources.get(r["source_id"], {})
            staged = r["stage"] in V.DISPLAYABLE
            if staged and (r["stage"] == "collapsed" or r["direction"] in ("in", "out")):
                n["stage", r["stage"]] += 1
            if not staged and not r["badge"]:
                n["other", "other"] += 1
            n["total", ""] += 1
            n["team", r["team"] or "arsenal"] += 1
            if r["tier"] in V.TIERS:
                n["tier", f"{r['tier']:g}"] += 1
            shown = self.shown(r, s)
            n["outlet", shown] += 1
            tier["outlet", shown] = self.outlet_tiers.get(fold(shown), s.get("tier"))
            views = self.views(r, known)
            for i, (name, outlet, registered) in enumerate(views):
                n["journalist", name] += 1
                at[name][outlet] += 1
                if len(views) == 1:
                    solo.add(name)
                if i == 0:
                    known_tier = self.people_tiers.get(fold(r["journalist"] or ""), self.people_tiers.get(fold(name))) if registered else None
                    tier["journalist", name] = r["tier"] if known_tier is None else known_tier
        out = []
        for axis, value in [("tier", f"{t:g}") for t in V.TIERS] + [("stage", s) for s in V.DISPLAYABLE] + [("other", "other"), ("total", "")] + [k for k in n if k[0] == "team"]:
            out.append((axis, value, value, n[axis, value], "", None))
        out += [("stage_group", ",".join(g), ",".join(g), sum(n["stage", s] for s in g), "", None) for g in R.SHOWN_GROUPS]
        for axis, value in [k for k in n if k[0] in ("outlet", "journalist")]:
            person, t, c = axis == "journalist", tier.get((axis, value)), n[axis, value]
            named = {o: k for o, k in at[value].items() if o} if person else {}
            outlet = min(named, key=lambda o: (-named[o], o)) if named else None
            if outlet in R.NOT_LISTED:
                continue
            if t in V.TIERS and t <= 1.5 and c >= (2 if person else 1):
                place = "first"
            elif person and value not in solo:
                place = "joint"
            elif person and c == 1:
                place = "single"
            else:
                place = "tier" if t in V.TIERS else "unlisted"
            out.append((axis, value, f"{value} ({outlet})" if outlet else value, c, "" if t is None else f"{t:g}", place))
        return sorted(out, key=str)


SOURCE_ROWS = [("a", "BBC", "BBC Sport", None, False, 1.5), ("b", None, "Fan Site", "Fan Desk", False, 4.0), ("x", None, "Posts", None, True, None), ("g", "Goal.com", "Goal", None, False, 2.0), ("odd", "", "", None, False, 2.5)]
PEOPLE = [("annlee", "Ann Lee", "The Post", 0), ("@ann", "Ann Lee", "The Post", 1), ("bora", "Bo Ra", None, 2), ("cyd(espn)", "Cy D (ESPN)", "ESPN", 3), ("éva", "Éva", "Mail", 4)]
OUTLETS = [("thepost", "Post"), ("post", "Post"), ("bbc", "BBC"), ("espn", "ESPN")]
TIERS = [("annlee", 1.0), ("@ann", 1.0), ("bora", 3.0), ("cyd(espn)", 0.0)]
OUTLET_TIERS = [("post", 1.0), ("bbc", 1.5), ("mail", 3.0)]
NAMES = ["Ann Lee", "@ann", "BO RA", "Bo Ra", "Cy D (ESPN)", "Zoe Q", "ZOE Q", "zoe q", "Ann Lee and Zoe Q", "Bo Ra & Ann Lee", "Joann Lee", "ESPN.com.br", "Fan Desk", "BBC Sport", "BBC", "Max One", "Éva with Max One", "Goal Writer"]


def articles(rng, n):
    out = []
    for i in range(n):
        authors = rng.choice([None, [], rng.sample(NAMES, rng.randint(1, 3)), [*rng.sample(NAMES[:2], 2), "Guest Pen"]])
        out.append((i, n - i, rng.choice(["a", "b", "x", "g", "odd", "gone"]), rng.choice([None, "", "The Post", "ESPN", "Mail", "Tiny"]), rng.choice([None, "", *NAMES, *(authors or [])]), authors, rng.choice([None, "arsenal", "city"]), rng.choice([None, 0.0, 1.0, 1.5, 2.0, 4.0, 9.0]), rng.choice([None, *V.STAGES]), rng.choice(V.DIRECTIONS), rng.choice([None, True, False])))
    return out


def dims(spark):
    tiers = "key string, tier double"
    return R.Dimensions(spark.createDataFrame(SOURCE_ROWS, SOURCES), spark.createDataFrame(PEOPLE, DIRECTORY), spark.createDataFrame(OUTLETS, "key string, name string"), spark.createDataFrame(TIERS, tiers), spark.createDataFrame(OUTLET_TIERS, tiers))


@pytest.mark.parametrize("seed,n", [(0, 120), (1, 25), (2, 0)])
def test_sidebar_equals_loops(spark, seed, n):
    rows = articles(random.Random(seed), n)
    got = sorted(map(tuple, R.sidebar(spark.createDataFrame(rows, ROWS), dims(spark)).collect()), key=str)
    names = [c.split(" ")[0] for c in ROWS.split(", ")]
    want = Sidebar(SOURCE_ROWS, PEOPLE, OUTLETS, TIERS, OUTLET_TIERS).facets([dict(zip(names, r, strict=True)) for r in rows])
    assert got == want
    if n == 120:
        assert {r[5] for r in got} == {None, "first", "joint", "single", "tier", "unlisted"}


def test_views(spark):
    rows = [
        (0, 0, "a", None, "Ann Lee and Zoe Q", ["Zoe Q", "Ann Lee"]),  # joined names: the first known author
        (1, 1, "b", None, "Fan Desk", ["Zoe Q"]),  # a label stands alone
        (2, 2, "a", "ESPN", "ESPN.com.br", None),  # a branch of the outlet
        (3, 3, "a", None, "Bo Ra & Ann Lee", None),  # who stands first in a byline
        (4, 4, "x", None, "@ann", None),  # a post's outlet is its journalist's
        (5, 5, "a", "The Post", "", ["Joann Lee"]),  # no whole words
        (6, 6, None, None, None, None),
    ]
    shape = ROWS.rsplit(", ", 5)[0]
    got = {r.article_id: r for r in R.author_views(spark.createDataFrame(rows, shape), dims(spark)).collect()}
    labels = [[v.label for v in got[i].views] for i in range(7)]
    assert labels == [["Ann Lee (Post)", "Zoe Q (BBC)"], ["Fan Desk"], ["ESPN"], ["Bo Ra"], ["Ann Lee (Post)"], ["Joann Lee (Post)"], []]
    assert got[4].shown == "The Post" and got[5].shown == "Post" and got[6].shown == ""


def test_badge_opens_other_items(spark):
    rows = spark.createDataFrame([("other", True), ("other", False), (None, None), ("done", False)], "stage string, badge boolean").withColumns({"outlet": F.lit("o"), "direction": F.lit("in")})
    match = lambda **k: [tuple(r) for r in rows.where(A.reader_match(badge="badge", **k)).select("stage", "badge").collect()]
    assert match() == [("other", True), ("done", False)]
    assert match(other=True) == [tuple(r) for r in rows.select("stage", "badge").collect()]
    assert match(stages=["done"]) == [("done", False)]
