"""Strict JSON: text is accepted only if all of it is one JSON value.

The variant parser ignores whatever follows the first complete value. Parsing
``[<text>,<sentinel>]`` instead shows any such rest: the sentinel is then not the
second element. Text that contains the sentinel's digits could imitate it
and is decided with two plain wrappers, so the answer is exact for every text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SENTINEL = "271828182845904523"

# JSON white space.
BLANKS = " \t\r\n"


def wrap(text: Column) -> Column:
    """Variant array of the parsed text and the sentinel; NULL if unparsable."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f",{SENTINEL}]")))


def is_strict(text: Column, wrapped: Column) -> Column:
    """Whether ``text`` is one JSON value, given ``wrapped = wrap(text)``. Never NULL.

    As a number the last element is read at a fraction of the price of its JSON. Without the
    sentinel's digits in the text no number is equal to it, and a string only by escapes. So what
    is equal is the sentinel itself and the last element; to look for one behind it, a path that
    leads nowhere, would cost more than the parse.
    """
    as_json = F.to_json(F.try_variant_get(wrapped, "$[1]", "variant")) == SENTINEL
    as_number = F.try_variant_get(wrapped, "$[1]", "bigint") == F.lit(int(SENTINEL))
    last = F.when(text.contains("\\u"), as_json).otherwise(as_number)
    decided = F.when(text.contains(SENTINEL), is_strict_text(text)).otherwise(last)
    return F.coalesce(decided, F.lit(False))


def is_strict_text(text: Column) -> Column:
    """The same in one expression, at the price of two parses. Never NULL.

    The object wrapper misses text that starts by closing it, the array wrapper
    misses text that starts by closing that; no text passes both.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"w":'), text, F.lit("}")))
    one_element = (
        F.try_variant_get(in_list, "$[0]", "variant").isNotNull()
        & F.try_variant_get(in_list, "$[1]", "variant").isNull()
    )
    return F.coalesce(in_object.isNotNull() & one_element, F.lit(False))


def root_kind(text: Column) -> Column:
    """object, list or other, read off the first character of valid JSON text."""
    first = F.substring(F.ltrim(text, F.lit(BLANKS)), 1, 1)
    return F.when(first == "{", "object").when(first == "[", "list").otherwise("other")
