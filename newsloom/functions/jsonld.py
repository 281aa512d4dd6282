"""JSON of unknown shape as VARIANT, in the order in which it is written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings, marks and words of a JSON text; a quote that nothing closes stays a token, so that the text stays broken.
_TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]:,]|[^ \t\n\r"{}\[\]:,]++|"'
_CONTROLS = "".join(map(chr, range(1, 32)))
_STAND_INS = "".join(chr(0xE000 + c) for c in range(1, 32))
_DIGITS, _END = 9, "end of text"


def ordered_variant(json: Column) -> Column:
    """A JSON text as VARIANT whose keys begin with their place, since VARIANT sorts an object's keys.

    Raw control characters within strings are kept (by stand-ins, see plain_string), NaN and the
    infinities count as null. Broken JSON gives null.
    """
    tokens = F.regexp_extract_all(json, F.lit(_TOKEN), F.lit(0))

    def token(t: Column, i: Column, all_tokens: Column) -> Column:
        text = F.translate(t, _CONTROLS, _STAND_INS)
        key = F.get(all_tokens, i + 1).eqNullSafe(":")
        placed = F.concat(F.lit('"'), F.lpad(i.cast("string"), _DIGITS, "0"), F.substr(text, F.lit(2)))
        number = t.isin("NaN", "Infinity", "-Infinity")
        return F.when(F.startswith(t, F.lit('"')), F.when(key, placed).otherwise(text)).when(number, "null").otherwise(t)

    renamed = F.transform(F.array(tokens), lambda all_tokens: F.array_join(F.transform(all_tokens, lambda t, i: token(t, i, all_tokens)), " "))
    closed = F.try_parse_json(F.concat(F.lit("["), renamed[0], F.lit(f',"{_END}"]')))  # a reader of JSON would stop behind the first value
    parts = F.transform(F.array(closed), elements)[0]
    return F.when((F.size(parts) == 2) & (plain_string(F.get(parts, F.lit(1))) == _END), F.get(parts, F.lit(0)))


def plain_string(node: Column) -> Column:
    """The node's text if it is a string, else null."""
    text = F.translate(F.try_variant_get(node, "$", "string"), _STAND_INS, _CONTROLS)
    return F.when(F.schema_of_variant(node) == "STRING", text)


def entries(node: Column) -> Column:
    """(key, value) of an ordered object in order; of a key that stands twice the last value, at the first place. Null for others."""
    found = F.map_entries(F.try_variant_get(node, "$", "map<string,variant>"))
    named = F.transform(found, lambda e: F.struct(F.substr(e["key"], F.lit(_DIGITS + 1)).alias("key"), e["value"].alias("value")))

    def without_repeats(pair: Column) -> Column:
        all_entries, names = pair["entries"], pair["names"]
        first = F.filter(all_entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
        last = lambda e: F.get(all_entries, (F.size(names) - F.array_position(F.reverse(names), e["key"])).cast("int"))["value"]
        single = F.size(F.array_distinct(names)) == F.size(names)
        return F.when(single, all_entries).otherwise(F.transform(first, lambda e: F.struct(e["key"].alias("key"), last(e).alias("value"))))

    pairs = F.transform(F.array(named), lambda es: F.struct(es.alias("entries"), F.transform(es, lambda e: e["key"]).alias("names")))
    return F.transform(pairs, without_repeats)[0]


def elements(node: Column) -> Column:
    """Elements of an array; null for others."""
    return F.try_variant_get(node, "$", "array<variant>")


def value_of(object_entries: Column, key: str) -> Column:
    """The value under a key of an object's entries."""
    return F.try_element_at(F.filter(object_entries, lambda e: e["key"] == key), F.lit(1))["value"]
