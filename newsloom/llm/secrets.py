"""Secret scans by assignment-aware lexing.

Lines with an assignment are lexed into (name, expression) pairs in source (`a = "x" + b`,
`a := x`, `'a' => 'x'`, `a: str = "x"`, `a["b"] = "x"`) and configuration syntax (`a: x`,
`"a": "x"`, `a: |` with a block of lines). An expression is a chain of literals and names,
joined by + or side by side, and goes on over lines in brackets or after a backslash; names
that stand for literals assigned earlier in the same document are replaced by them (constants
propagate). A literal's score is the weight of the most sensitive word in the name of any
target that it reaches, times how secret-like it or all that it is joined to looks; spans of kind `literal` with a score of at least `threshold` are reported at the
place where the literal is written. Base patterns are reported beside them.

Scanning is narrow: one Arrow pass over whole texts, no shuffle. Places are code points.

Defined cases: null text is empty: counts 0, no spans. Repeated rows are scanned alike.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import documents, small_batches, text_or_empty

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Words of names and how sensitive they are.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "key": 0.7, "auth": 0.7, "bearer": 0.8, "private": 0.7, "signature": 0.6}
THRESHOLD = 0.5

_TYPE = r"""[A-Za-z_$][\w.$]*(?:[ \t]*[\[<][\w.$ \t,|\[\]<>]*[\]>])?"""
_TARGET = re.compile(
    r"""(?<![\w.$-])(?:(?P<name>[A-Za-z_$][\w.$-]*)|"(?P<dq>[^"\n]+)"|'(?P<sq>[^'\n]+)')(?:[ \t]*\])?[ \t]*"""
    rf"""(?:\??:[ \t]*(?P<type>(?>{_TYPE})(?:[ \t]*\|[ \t]*(?>{_TYPE}))*+)[ \t]*(?==(?![=>])))?(?::=|=>|[=:])(?![=>])[ \t]*"""  # a type is read one way only, else unions take 2^n
)
_QUOTED = re.compile(r"""[rbuf]?(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)""")
_BARE = re.compile(r"""[^\s,;#"'`(){}\[\]+&][^\s,;"'`(){}\[\]&]*""")
_NESTED = re.compile(r"""[A-Za-z_$][\w.$-]*[ \t]*=(?![=>])[ \t]*["'`\w]""")  # an argument's name
_CHAINED = re.compile(r"""[A-Za-z_$][\w.$-]*[ \t]*=(?![=>])[ \t]*["'`]""")  # a = b = "x"
_BLANK = re.compile(r"(?:[ \t]|\\\r?\n)*")
_INSIDE = re.compile(r"(?:\s|\\\r?\n|#[^\n]*|//[^\n]*)*")  # in brackets, lines go on
_BLOCK = re.compile(r"[|>][+-]?\d?[+-]?[ \t]*(?:#[^\n]*)?\r?\n")
_LINE = re.compile(r"([ \t]*)([^\r\n]*)(\r?\n|$)")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def name_weight(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)


def value_weight(value: str) -> float:
    """0 for short, spaced or placeholder values; 1 from 48 bits of character entropy on."""
    if len(value) < 8 or re.search(r"\s|\$\{|<|example|changeme|xxxx|\*\*\*", value, re.I):
        return 0.0
    n = len(value)
    bits = -sum(c * math.log2(c / n) for c in Counter(value).values())
    return min(1.0, bits / 48) if re.search(r"\d", value) else min(1.0, bits / 96)


def block_lines(text: str, at: int, indent: int) -> list[tuple[int, int, str]]:
    """Lines of a block scalar from `at` on: those indented deeper than its name, without their blanks."""
    out = []
    while at < len(text) and (m := _LINE.match(text, at)):
        value = m[2].rstrip()
        if value and len(m[1]) <= indent:
            break
        if value:
            out.append((m.start(2), m.start(2) + len(value), value))
        at = m.end()
    return out


def expression(text: str, at: int, known: dict[str, int]) -> tuple[list[tuple[int, int, str, str]], set[int], int]:
    """(literals, references, end) of the value that starts at `at`.

    A value is a chain of literals and names, joined by + or, if quoted, side by side; inside
    round or square brackets it goes on over lines, comments and commas. A literal is (first
    place, place after, itself, all that it is joined to). A name that is a target itself ends it.
    """
    literals: list[tuple[int, int, str, str]] = []
    refs: set[int] = set()
    chain: list[tuple[int, int, str]] = []
    depth, open_, beside = 0, True, False  # a term may follow; the last one was quoted

    def close() -> None:
        whole = "".join(v for _, _, v in chain)
        literals.extend((a, z, v, whole) for a, z, v in chain)
        chain.clear()

    while True:
        here = (_INSIDE if depth else _BLANK).match(text, at).end()
        sign = text[here : here + 1]
        if open_ and sign in ("(", "["):
            depth, at = depth + 1, here + 1
        elif depth and sign in (")", "]"):
            depth, at, open_, beside = depth - 1, here + 1, False, False
            if not depth:
                close()
        elif sign == "+" and not open_:
            at, open_ = here + 1, True
        elif depth and sign == "," and not open_:
            close()
            at, open_ = here + 1, True
        elif (open_ or beside) and (m := _QUOTED.match(text, here)):
            k = next(k for k in (1, 2, 3) if m[k] is not None)
            chain.append((*m.span(k), m[k]))
            at, open_, beside = m.end(), False, True
        elif open_ and (_NESTED if depth else _CHAINED).match(text, here):
            close()
            return literals, refs, here
        elif open_ and (m := _BARE.match(text, here)):
            word = m[0].rstrip("+")
            parts = word.split("+")
            if any(p in known for p in parts):
                place = here
                for p in parts:
                    if p in known:
                        refs.add(known[p])
                    elif p:
                        chain.append((place, place + len(p), p))
                    place += len(p) + 1
            else:
                chain.append((here, here + len(word), word))
            at, open_, beside = here + len(word), False, False
        else:
            close()
            return literals, refs, at


def assignments(text: str) -> Iterator[tuple[float, list[tuple[int, int, str, str]]]]:
    """(weight, literals with their places) of each assignment, last first.

    The weight is that of the most sensitive target that the assignment's value reaches. An
    assignment refers to the earlier ones whose names it holds and hands its weight on to
    them, so each reference is followed once and no literal is copied.
    """
    known: dict[str, int] = {}
    found: list[tuple[list[tuple[int, int, str, str]], set[int]]] = []
    weights: list[float] = []
    at = 0
    while m := _TARGET.search(text, at):
        name = m["name"] or m["dq"] or m["sq"]
        if m["type"]:  # a type, or the value of `name: value = ...`
            found.append(([(*m.span("type"), m["type"], m["type"])], set()))
            weights.append(name_weight(name))
        at = m.end()
        if block := _BLOCK.match(text, at):
            line = text.rfind("\n", 0, m.start()) + 1
            indent = len(text[line : m.start()]) - len(text[line : m.start()].lstrip(" \t-"))
            literals, refs, at = [(*x, x[2]) for x in block_lines(text, block.end(), indent)], set(), block.end()
        else:
            literals, refs, at = expression(text, at, known)
        if literals or refs:
            known[name] = len(found)
            found.append((literals, refs))
            weights.append(name_weight(name))
    for i in range(len(found) - 1, -1, -1):
        literals, refs = found[i]
        for j in refs:
            weights[j] = max(weights[j], weights[i])
        yield weights[i], literals


def scan(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, int, float]]:
    """(start, number of the kind, end, score) of every span, in order."""
    low = text.lower()
    out: dict[tuple[int, int, int], float] = {}
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        out |= {(m.start(), 0, m.end()): 1.0 for m in ASSIGN.finditer(text) if len(m[2]) >= 12}
    if "AKIA" in text:
        out |= {(m.start(), 1, m.end()): 1.0 for m in ACCESS.finditer(text)}
    out |= {(m.start(), 2, m.end()): 1.0 for m in HEX.finditer(text)}
    if ("=" in text or ":" in text) and any(w in low for w in SENSITIVE):
        joined: dict[str, float] = {}  # of chains, scored once each
        for weight, literals in assignments(text):
            for start, end, value, whole in literals if weight else ():
                if whole not in joined:
                    joined[whole] = value_weight(whole)
                score = weight * max(value_weight(value), joined[whole])
                if score >= threshold:
                    place = (start, 3, end)
                    out[place] = max(score, out.get(place, 0.0))
    return [(*k, s) for k, s in sorted(out.items())]


def secret_spans(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document with spans: array of (kind, start, end, score), by start and kind."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(span))])
    arrow_spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "score": v} for s, k, e, v in scan(t, threshold)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, arrow_spans)], names=schema.names)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(documents(spark, sf_dir))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
