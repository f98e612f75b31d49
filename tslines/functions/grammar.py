"""One line at a time by the patterns of the grammar: what the structural index leaves open.

Gives what the expressions of `operators.decode` give for the same line.
"""

from __future__ import annotations

import re
from decimal import Decimal

# Accepted spellings of booleans.
TRUE_TEXT = ("t", "T", "true", "True", "TRUE")
FALSE_TEXT = ("f", "F", "false", "False", "FALSE")
U64_MAX = 2**64 - 1

# Grammar of one line, built from pieces. Unrolled and possessive: Java's matcher recurses once
# per repetition of a plain alternation.
KEY = r"[^,= \\]*+(?:\\.[^,= \\]*+)*+"
NAME = rf"(?=[^,= ]){KEY}"
MEASUREMENT = r"(?=[^, ])[^, \\]*+(?:\\.[^, \\]*+)*+"
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
VALUE = rf'(?:{STRING}|[^,= "]++)'
FIELD = rf"{NAME}={VALUE}"
TAG_PAIR = rf"(?s){NAME}={KEY}"
FIELD_PAIR = rf"(?s){NAME}={VALUE}"
LEADING_NAME = rf"(?s)^({NAME})="
_LINE = rf"(?s)^({MEASUREMENT})((?:,{NAME}={KEY})*+) ({FIELD}(?:,{FIELD})*+)(?: (-?[0-9]+))?"
#: For Java. The end is that of the text, also behind a line break.
LINE = rf"{_LINE}\z"


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern.encode())


_WHOLE_LINE, _TAG_PAIR, _FIELD_PAIR, _LEADING_NAME = map(_compiled, (rf"{_LINE}\Z", TAG_PAIR, FIELD_PAIR, LEADING_NAME))
# what a cast to a number reads: white space and control characters around it are passed over
_INTEGER = re.compile(rb"[\x00-\x20\x7f]*([+-]?[0-9]+)[\x00-\x20\x7f]*")
_FLOAT = re.compile(rb"[\x00-\x20]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_QUOTED = re.compile(rb'\\(["\\])')
_TRUE = frozenset(t.encode() for t in TRUE_TEXT)
_FALSE = frozenset(t.encode() for t in FALSE_TEXT)

Parsed = dict | None


def _unescaped(name: bytes, specials: bytes) -> str:
    for char in specials:
        name = name.replace(b"\\%c" % char, b"%c" % char)
    return name.decode()


def _pair(raw: bytes) -> tuple[str, bytes]:
    name = _LEADING_NAME.match(raw)[1]
    return _unescaped(name, b",= "), raw[len(name) + 1 :]


def _long(text: bytes) -> int | None:
    found = _INTEGER.fullmatch(text)
    value = int(found[1]) if found and len(found[1]) < 4000 else None
    return value if value is not None and -(2**63) <= value < 2**63 else None


def value(raw: bytes) -> tuple[str, object]:
    """Member of the union and value of a field; the value is None when it is not of that type."""
    if raw.endswith(b"i"):
        return "i", None if raw.startswith(b"+") else _long(raw[:-1])
    if raw.startswith(b'"'):
        return "s", _QUOTED.sub(rb"\1", raw[1:-1]).decode()
    if raw.endswith(b"u"):
        head = raw[:-1].lstrip(b"0") or raw[:-1][:1]
        fit = raw[:-1].isdigit() and len(head) <= 20 and int(head) <= U64_MAX
        return "u", Decimal(int(head)) if fit else None
    if raw in _TRUE or raw in _FALSE:
        return "b", raw in _TRUE
    fit = raw[-1:] in b"0123456789." and _FLOAT.fullmatch(raw)
    return "f", float(raw.strip(bytes(range(33)))) if fit else None


def parse_line(lp: bytes | None) -> dict:
    """Measurement, tags, fields, time in its own unit, and what is wrong with the line."""
    found = _WHOLE_LINE.match(lp) if lp else None
    if not found:
        return {"reject": "cannot be parsed"}
    measurement, tag_text, field_text, time = found.groups()
    tags = [_pair(p) for p in _TAG_PAIR.findall(tag_text)]
    names = {k for k, _ in tags}
    if len(names) < len(tags):
        return {"reject": "tag given twice"}
    fields: dict[str, dict] = {}
    bad = None
    for key, raw in map(_pair, _FIELD_PAIR.findall(field_text)):
        member, given = value(raw)
        if given is None and bad is None:
            bad = key
        fields[key] = {member: given}
    if not names.isdisjoint(fields):
        return {"reject": "name is both tag and field"}
    if bad is not None:
        return {"reject": f"invalid value of field {bad}"}
    at = _long(time) if time else None
    if time and at is None:
        return {"reject": "time out of range"}
    return {
        "measurement": _unescaped(measurement, b", "),
        "tags": [(k, _unescaped(v, b",= ")) for k, v in tags],
        "fields": [{"key": k, "value": v} for k, v in fields.items()],
        "time": at,
    }
