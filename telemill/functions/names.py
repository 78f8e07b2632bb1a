"""Names of tables and columns, and topic filters."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, functions as F

# A letter of any script or an underscore, then also digits.
IDENTIFIER = r"^[\p{L}_][\p{L}\p{M}\p{N}_]*$"
# What no text of identifiers has: another character, or one that none begins with behind a comma.
NO_WORD = r"[^\p{L}\p{M}\p{N}_]"
NO_BEGINNING = r"(?:^|,)(?![\p{L}_])"


# What the session catalog takes for databases and tables.
CATALOG_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"


def is_identifier(name: Column) -> Column:
    return name.rlike(IDENTIFIER)


def is_catalog_name(name: str) -> bool:
    return re.match(CATALOG_NAME, name) is not None


def quoted(*parts: str) -> str:
    """Back-quoted dotted name."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def route_id(schema: str, table: str) -> str:
    """A short name of a table for use in paths; the names themselves may fill a path's part."""
    return "r" + hashlib.sha256(f"{schema}.{table}".encode()).hexdigest()[:20]


def route_id_of(schema: Column, table: Column) -> Column:
    """The same, computed from columns; NULL without a table."""
    digest = F.sha2(F.concat(schema, F.lit("."), table), 256)
    return F.concat(F.lit("r"), F.substring(digest, 1, 20))


#: Bytes that a table's names may have to stand for it in a path.
READABLE_BYTES = 120


def route_scope(schema: str, table: str) -> str:
    """The table's names where they are short, else its short name."""
    names = f"{schema}.{table}"
    return names if len(names.encode()) <= READABLE_BYTES else route_id(schema, table)


def topic_regex(topic_filter: str) -> str:
    """Regular expression for an MQTT topic filter.

    ``+`` stands for one level, a trailing ``#`` for the parent level and everything
    below it. A leading wildcard does not match topics that begin with ``$``.
    """
    levels = topic_filter.split("/")
    if "#" in levels[:-1] or any(
        len(level) > 1 and ("+" in level or "#" in level) for level in levels
    ):
        raise ValueError(f"not a topic filter: {topic_filter!r}")
    guard = "(?!\\$)" if levels[0] in ("+", "#") else ""
    rest = ""
    if levels[-1] == "#":
        levels = levels[:-1]
        rest = "(/.*)?" if levels else ".*"
    return "(?s)^" + guard + "/".join("[^/]*" if x == "+" else re.escape(x) for x in levels) + rest + "$"


def topic_matches(topic: Column, topic_filter: str) -> Column:
    return topic.rlike(topic_regex(topic_filter))
