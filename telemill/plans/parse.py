"""Parsers by name: raw messages to outcomes, as DataFrame transforms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from telemill.operators import delimited
from telemill.operators.decode import decode, judge
from telemill.operators.outcomes import outcomes
from telemill.options import Options

Parser = Callable[[DataFrame, Options], DataFrame]

DEFAULT_PARSER = "telemetry"


def parse_telemetry(raw: DataFrame, options: Options) -> DataFrame:
    return outcomes(judge(decode(raw)), options)


def delimited_parser(separator: str = ",") -> Parser:
    """A parser of lines whose first names the columns (see ``operators.delimited``)."""
    return lambda raw, options: outcomes(delimited.judged(raw, separator), options)


_parsers: dict[str, Parser] = {DEFAULT_PARSER: parse_telemetry, "delimited": delimited_parser()}


def register_parser(name: str, parser: Parser) -> None:
    """Makes ``parser(raw, options) -> outcomes`` available under a name, in any case."""
    _parsers[name.lower()] = parser


def parse(raw: DataFrame, options: Options | None = None, parser: str = DEFAULT_PARSER) -> DataFrame:
    try:
        chosen = _parsers[parser.lower()]
    except KeyError:
        raise ValueError(f"no parser named {parser!r}; known: {sorted(_parsers)}") from None
    return chosen(raw, options or Options())
