import hashlib
import re

from newsloom.llm import exact_dedup as E


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for key, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for k, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), k == 0, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, E.exact_dedup(df).collect()), key=str) == brute(rows)


def test_odd_rows(odd):
    check(odd)


def test_empty_table(empty):
    assert E.exact_dedup(empty).count() == 0


def test_table(small):
    check(small)


def test_hot_text_is_salted(spark):
    rows = [(i, "hot text " + " " * (i % 7)) for i in range(500)] + [(1000 + i, f"text {i % 50}") for i in range(100)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))


def test_plan_has_no_python(small):
    plan = E.exact_dedup(small)._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "Python" not in plan and "Arrow" not in plan
