"""Escaping rules of line protocol as column expressions.

Escaping is a chain of byte-level `replace` calls: the characters added (backslashes) are
never among those a later call looks for, and a call that finds nothing returns its input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that take a backslash, in the order they are replaced.
MEASUREMENT_SPECIALS = (",", " ")
KEY_SPECIALS = (",", "=", " ")
QUOTED_SPECIALS = ("\\", '"')


def _escape(c: Column, specials: tuple[str, ...]) -> Column:
    for char in specials:
        c = F.replace(c, F.lit(char), F.lit("\\" + char))
    return c


def _unescape(c: Column, specials: tuple[str, ...]) -> Column:
    for char in specials:
        c = F.replace(c, F.lit("\\" + char), F.lit(char))
    return c


def escape_measurement(c: Column) -> Column:
    """Measurement name: comma and space."""
    return _escape(c, MEASUREMENT_SPECIALS)


def escape_key(c: Column) -> Column:
    """Tag key, tag value or field key: comma, equals sign and space."""
    return _escape(c, KEY_SPECIALS)


def escape_quoted(c: Column) -> Column:
    """Inside of a string field: backslash and double quote."""
    return _escape(c, QUOTED_SPECIALS)


def quoted(c: Column) -> Column:
    """String field literal."""
    return F.concat(F.lit('"'), escape_quoted(c), F.lit('"'))


def _sql_escape(v: str, specials: tuple[str, ...]) -> str:
    for char in specials:
        v = f"replace({v}, r'{char}', r'\\{char}')"
    return v


# The same rules as SQL expression text, for expressions built as text.
def sql_escape_key(v: str) -> str:
    return _sql_escape(v, KEY_SPECIALS)


def sql_quoted(v: str) -> str:
    return f"concat('\"', {_sql_escape(v, QUOTED_SPECIALS)}, '\"')"


def sql_name(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _escape_name(name: str, specials: tuple[str, ...]) -> str:
    for char in specials:
        name = name.replace(char, "\\" + char)
    return name


# The same rules for names known when the plan is built, so no row pays for them.
def measurement_name(name: str) -> str:
    return _escape_name(name, MEASUREMENT_SPECIALS)


def key_name(name: str) -> str:
    return _escape_name(name, KEY_SPECIALS)


def unescape_measurement(c: Column) -> Column:
    return _unescape(c, MEASUREMENT_SPECIALS)


def unescape_key(c: Column) -> Column:
    return _unescape(c, KEY_SPECIALS)


def unescape_quoted(c: Column) -> Column:
    # one pass, because an escaped backslash may stand before a quote
    return F.when(
        F.contains(c, F.lit("\\")), F.regexp_replace(c, r'\\(["\\])', "$1")
    ).otherwise(c)
