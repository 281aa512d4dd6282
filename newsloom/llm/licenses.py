"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line. Its words form a set; it matches a template when it contains at least
`threshold` of the template's distinct words. Words are ordered by how many blocks of the
whole corpus hold them, rarest first. Of a template with n words that needs `least` in
common, only the first n - least + 1 (the prefix) are indexed: a block without any of them
cannot match. A candidate then passes the length filter (block has at least `least` words
of the template vocabulary) and the positional filter (what follows the first shared
prefix word on both sides can still reach `least`) before the overlap is counted.

A notice that is wrapped over lines is found by windows, too: as many consecutive words of
the whole text as the template has, across line breaks and comment marks. A template that
passes the same filters on the text's whole set is slid over the places of its words. Each
run of windows that hold `least` distinct words of it gives a match (block: the line of the
best window's first template word), unless a line that the run touches holds as many.
Templates are single sentences and whole license texts.

Base phrases are places of consecutive words anywhere in the text, across lines.

The vocabulary's counts are the only thing that comes to the driver: one number for each
word of the templates. Both passes are narrow, so nothing is shuffled but those counts.

Defined cases: null text is empty: no words, null places, empty labels, score 0.0. Repeated
rows are scanned alike. Empty tables give no rows. Other columns are ignored.
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

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Well-known license sentences, lower case, by label.
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mit-release", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
#: Whole license texts, lower case, without marks.
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
TEMPLATES += [
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software " + _AS_IS),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("zlib-text", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed or altered from any source distribution"),
    ("apache-header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program"),
]
THRESHOLD = 0.8
_W = rb"0-9a-z\x80-\xff"
_WORD = re.compile(rb"[%s]+" % _W)


def _base_patterns(phrases: dict[str, str]) -> list[tuple[bytes, re.Pattern, str]]:
    out = []
    for phrase, label in phrases.items():
        words = phrase.encode().split()
        out.append((words[0], re.compile(rb"(?<![%s])" % _W + (rb"[^%s]+" % _W).join(words) + rb"(?![%s])" % _W), label))
    return out


def word_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """In how many blocks of all documents each word of the vocabulary stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                for line in text.encode().lower().split(b"\n"):
                    n.update(vocabulary.intersection(_WORD.findall(line)))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    small_batches(docs.sparkSession)
    counted = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    found = {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def license_matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: words, base places and labels, and every (block, template) match.

    matches is an array of (block, label, containment); blocks count from 0.
    """
    sets = [(label, frozenset(words.encode().split())) for label, words in templates]
    vocabulary = frozenset().union(*(s for _, s in sets))
    counts = word_counts(docs, vocabulary, text_col)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}
    index: dict[int, list[tuple[int, int]]] = {}  # word to (template, place in it)
    ordered, need = [], []
    for t, (_, words) in enumerate(sets):
        ordered.append(frozenset(rank[w] for w in words))
        need.append(math.ceil(threshold * len(words) - 1e-9))
        for place, w in enumerate(sorted(ordered[t])[: len(words) - need[t] + 1]):
            index.setdefault(w, []).append((t, place))
    labels = [label for label, _ in sets]
    lengths = [len(words.split()) for _, words in templates]
    bases = _base_patterns(phrases)

    def block_matches(words: list[int]) -> list[tuple[int, float]]:
        out, seen = [], set()
        for at, w in enumerate(words):
            for t, place in index.get(w, ()):
                if t in seen:
                    continue
                seen.add(t)
                if len(words) < need[t] or 1 + min(len(words) - at, len(ordered[t]) - place) - 1 < need[t]:
                    continue
                common = len(ordered[t].intersection(words))
                if common >= need[t]:
                    out.append((t, common / len(ordered[t])))
        return out

    def window_matches(hits: list[tuple[int, int, int]], by_line: list[dict]) -> list[dict]:
        """hits: (place, rank, line) of the vocabulary's words in the whole text, in order."""
        out = []
        for t, _ in block_matches(sorted({w for _, w, _ in hits})):
            own = [h for h in hits if h[1] in ordered[t]]
            taken = {m["block"]: m["containment"] for m in by_line if m["label"] == labels[t]}
            more = lambda run, size=len(ordered[t]), taken=taken: all(taken.get(k, 0.0) < run[0] / size for k in range(run[2], run[3] + 1))
            inside: Counter = Counter()
            low, run = 0, None  # run: (most words, line of the best window, first line, last line)
            for at, w, line in own:
                inside[w] += 1
                while at - own[low][0] >= lengths[t]:
                    inside[own[low][1]] -= 1
                    inside += Counter()
                    low += 1
                n, first = len(inside), own[low][2]
                if run and (n < need[t] or first > run[3]):
                    out += [(t, run)] if more(run) else []
                    run = None
                if n >= need[t]:
                    best = max(run[:2], (n, first), key=lambda x: x[0]) if run else (n, first)
                    run = (*best, run[2] if run else first, line)
            out += [(t, run)] if run and more(run) else []
        return [{"block": run[1], "label": labels[t], "containment": run[0] / len(ordered[t])} for t, run in out]

    match = T.ArrayType(T.StructType([T.StructField("block", T.LongType()), T.StructField("label", T.StringType()), T.StructField("containment", T.DoubleType())]))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")], T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("matches", match)])
    arrow_match = pa.list_(pa.struct([("block", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_base, first, last, base, matches = [], [], [], [], [], []
            for text in b.column(1).to_pylist():
                raw = text.encode().lower()
                n, found, hits = 0, [], []
                for k, line in enumerate(raw.split(b"\n")):
                    words = _WORD.findall(line)
                    shared = vocabulary.intersection(words)
                    if shared:
                        hits += [(n + at, rank[w], k) for at, w in enumerate(words) if w in shared]
                        found += [{"block": k, "label": labels[t], "containment": c} for t, c in block_matches(sorted(rank[w] for w in shared))]
                    n += len(words)
                if hits and hits[0][2] != hits[-1][2]:
                    found = sorted(found + window_matches(hits, found), key=lambda m: m["block"])
                places = [(m.start(), label) for head, pattern, label in bases if head in raw for m in pattern.finditer(raw)]
                n_words.append(n)
                n_base.append(len(places))
                starts = [len(_WORD.findall(raw, 0, p)) for p in (min(places)[0], max(places)[0])] if places else [None, None]
                first.append(starts[0])
                last.append(starts[1])
                base.append(sorted({label for _, label in places}))
                matches.append(found)
            ints = [pa.array(x, pa.int64()) for x in (n_words, n_base, first, last)]
            yield pa.RecordBatch.from_arrays([b.column(0), *ints, pa.array(base, pa.list_(pa.string())), pa.array(matches, arrow_match)], names=schema.names)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = license_matches(documents(spark, sf_dir))
    labels = F.array_sort(F.array_union("base_labels", "matches.label"))
    best = F.coalesce(F.array_max("matches.containment"), F.lit(0.0))
    return m.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"))


def op4_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    template = ", ".join(f"('{label}', {sorted(set(t.split()))}, {len(t.split())})" for label, t in TEMPLATES)
    place = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_filter(range(len(words)), lambda i: {' AND '.join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))})) AS place_at, '{label}' AS label FROM d"
        for phrase, label in PHRASES.items()
    )
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
d AS (SELECT doc_id, regexp_extract_all(low, '{word}') AS words FROM t),
place AS ({place}),
base AS (SELECT doc_id, count(*) AS n, min(place_at) AS a, max(place_at) AS z, list(DISTINCT label) AS labels FROM place GROUP BY doc_id),
block AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{word}')) AS words FROM (SELECT doc_id, unnest(string_split(low, chr(10))) AS line FROM t)),
template(label, words, size) AS (VALUES {template}),
need AS (SELECT *, CAST(ceil({THRESHOLD} * len(words) - 1e-9) AS BIGINT) AS least FROM template),
line_hit AS (SELECT doc_id, label, len(list_intersect(block.words, need.words)) / len(need.words) AS c FROM block, need
             WHERE len(block.words) >= least AND len(list_intersect(block.words, need.words)) >= least),
whole AS (SELECT doc_id, d.words AS said, need.* FROM d, need WHERE len(d.words) >= least AND len(list_intersect(list_distinct(d.words), need.words)) >= least),
word_hit AS (SELECT * FROM (SELECT doc_id, label, words, size, least, unnest(said) AS word, unnest(range(len(said))) AS at FROM whole) WHERE list_contains(words, word)),
window_hit AS (SELECT a.doc_id, a.label, count(DISTINCT b.word) / any_value(len(a.words)) AS c FROM word_hit a JOIN word_hit b ON b.doc_id = a.doc_id AND b.label = a.label AND b.at <= a.at AND b.at > a.at - a.size
               GROUP BY a.doc_id, a.label, a.at HAVING count(DISTINCT b.word) >= any_value(a.least)),
hit AS (SELECT * FROM line_hit UNION ALL SELECT * FROM window_hit),
own AS (SELECT doc_id, max(c) AS c, list(DISTINCT label) AS labels FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, base.a AS first_word, base.z AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(own.c, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""
