"""A structural index over many lines at once.

The special characters of all lines of an Arrow batch are found in one pass over their
bytes. What follows works on their positions: runs of backslashes give the escaped ones,
quotes that are left give string parity by a running count, and what then remains outside of
strings are the spaces, commas and equals signs that part a line. Names and values are cut
by offsets, without a pattern per line.

A line counts as parsed only when its marks stand exactly as the grammar wants them and every
value has the plain form of its type. All other lines, wrong ones among them, are left to the
patterns of `grammar`, which alone decide what is turned down and why.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tslines.functions.grammar import FALSE_TEXT, TRUE_TEXT, parse_line

COMMA, EQUALS, SPACE, QUOTE, BACKSLASH = b',= "\\'

_SPECIAL = np.zeros(256, bool)
_SPECIAL[[COMMA, EQUALS, SPACE, QUOTE, BACKSLASH]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

_TRUE = pa.array([t.encode() for t in TRUE_TEXT], pa.binary())
_BOOLEAN = pa.array([t.encode() for t in TRUE_TEXT + FALSE_TEXT], pa.binary())
_EXPONENT = re.compile(rb"-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+")

VALUE = pa.struct([("f", pa.float64()), ("i", pa.int64()), ("u", pa.decimal128(20, 0)), ("s", pa.string()), ("b", pa.bool_())])
FIELD = pa.struct([("key", pa.string()), ("value", VALUE)])
PARSED = pa.struct([("measurement", pa.string()), ("tags", pa.map_(pa.string(), pa.string())), ("fields", pa.list_(FIELD)), ("time", pa.int64()), ("reject", pa.string())])
#: Names of a line up to which they are compared by distance.
NEAR = 48
#: Bytes of lines whose marks are looked for at once; the working arrays take about 40 times as much.
CHUNK = 1 << 20


def _slices(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Stretches of the buffer as an Arrow array."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    at = np.repeat(start - offsets[:-1], length)
    at += np.arange(offsets[-1])
    large = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}[kind]
    if offsets[-1] >= 1 << 31:
        return pa.Array.from_buffers(large, len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])]).cast(kind)
    return pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])])


def _unescaped(names: pa.Array, specials: bytes) -> pa.Array:
    for char in specials:
        names = pc.replace_substring(names, "\\" + chr(char), chr(char))
    return names


def _per_line(line: np.ndarray, count: int, pick: np.ndarray) -> np.ndarray:
    return np.bincount(line[pick], minlength=count)


def _runs(counts: np.ndarray) -> np.ndarray:
    """Offsets of lists from their lengths."""
    out = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=out[1:])
    return out


class Marks:
    """Positions, kinds and lines of the marks that part lines, and which lines are still good.

    `start` and `end` bound each line in `data`; `head` is the space after measurement and
    tags, `tail` the space before the time, or the end of the line.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end = data, start, end
        count = len(start)
        at = np.flatnonzero(_SPECIAL[data])
        kind = data[at]
        first = np.searchsorted(at, start)
        line = np.repeat(np.arange(count), np.diff(np.append(first, len(at))))
        self.good = np.ones(count, bool)
        self.back = at[kind == BACKSLASH]
        free = kind != BACKSLASH
        wrong = np.zeros(0, np.int64)
        if len(self.back):
            escaped, wrong = self._escaped(at, kind, line)
            free &= ~escaped
        # the first space outside of escapes ends the head; quotes count after it
        at, kind, line = at[free], kind[free], line[free]
        spaces = np.flatnonzero(kind == SPACE)
        spaces = spaces[np.diff(line[spaces], prepend=-1) != 0]
        self.good[:] = False
        self.good[line[spaces]] = True
        self.good[wrong] = False
        self.head = end.copy()
        self.head[line[spaces]] = at[spaces]
        in_head = at <= self.head[line]
        quote = (kind == QUOTE) & ~in_head
        self.quotes = at[quote]
        if len(self.quotes):
            counted = np.cumsum(quote)
            before = np.zeros(count, np.int64)
            opens = np.flatnonzero(np.diff(line, prepend=-1))
            before[line[opens]] = counted[opens] - quote[opens]
            inside = (counted - before[line]) % 2 == 1
            odd = _per_line(line, count, quote) % 2 == 1
            self.good &= ~odd
            keep = ~inside & (kind != QUOTE)
        else:
            keep = kind != QUOTE
        self.quote_line = line[quote]
        at, kind, line, in_head = at[keep], kind[keep], line[keep], in_head[keep]
        after = (kind == SPACE) & ~in_head
        n_after = _per_line(line, count, after)
        self.good &= n_after <= 1
        self.tail = end.copy()
        self.tail[line[after]] = at[after]
        part = kind != SPACE
        # commas and equals signs behind the tail are wrong in a time
        self.good[line[part & (at > self.tail[line])]] = False
        self.at, self.kind, self.line, self.in_head = at[part], kind[part], line[part], in_head[part]

    def _escaped(self, at: np.ndarray, kind: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which special characters follow an escaping backslash, and the lines that end in one.
        In a run of backslashes every other one escapes, from its first on."""
        where = np.flatnonzero(kind == BACKSLASH)
        place = at[where]
        opens = np.flatnonzero(np.diff(place, prepend=-2) != 1)
        opens = np.union1d(opens, np.flatnonzero(place == self.start[line[where]]))
        run = np.zeros(len(place), np.int64)
        run[opens] = place[opens]
        run = np.maximum.accumulate(run)
        escapes = (place - run) % 2 == 0
        dangling = escapes & (place + 1 == self.end[line[where]])
        target = where[escapes] + 1
        target = target[target < len(at)]
        hit = at[target] == at[target - 1] + 1
        hit &= line[target] == line[target - 1]
        escaped = np.zeros(len(at), bool)
        escaped[target[hit]] = True
        return escaped, line[where[dangling]]


def _alternate(marks: Marks, pick: np.ndarray, opening: int) -> None:
    """Lines are good only if their picked marks take turns, beginning with `opening`."""
    line, kind = marks.line[pick], marks.kind[pick]
    if not len(line):
        return
    begins = np.diff(line, prepend=-1) != 0
    place = np.arange(len(line))
    place -= np.maximum.accumulate(np.where(begins, place, 0))
    other = COMMA if opening == EQUALS else EQUALS
    marks.good[line[kind != np.where(place % 2 == 0, opening, other)]] = False


def _whole(marks: Marks, digits: np.ndarray, start: np.ndarray, end: np.ndarray, which: np.ndarray, line: np.ndarray, signed: bool = True) -> np.ndarray:
    """The chosen stretches as 64-bit whole numbers, zero elsewhere. One that is no whole number of
    up to 19 digits, or does not fit, makes its line not good."""
    data, out = marks.data, np.zeros(len(start), np.int64)
    pick = np.flatnonzero(which)
    a, b = start[pick], end[pick]
    minus = ((data[np.minimum(a, len(data) - 1)] == 45) & (a < b)).astype(np.int64) if signed else np.zeros(len(a), np.int64)
    n = digits[b] - digits[a]
    fit = (n >= 1) & (n <= 19) & (n + minus == b - a)
    size = _slices(data, (a + minus)[fit], b[fit], pa.string()).cast(pa.uint64()).to_numpy(zero_copy_only=False)
    small = size <= np.uint64(2**63 - 1)
    fit[np.flatnonzero(fit)[~small]] = False
    marks.good[line[pick[~fit]]] = False
    number = size[small].astype(np.int64)
    out[pick[fit]] = np.where(minus[fit] == 1, -number, number)
    return out


def _values(marks: Marks, digits: np.ndarray, line: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Field values as the union of all types. A value not in the plain form of its type makes
    its line not good."""
    data, good = marks.data, marks.good
    last, first = data[end - 1], data[start]
    text = first == QUOTE
    whole, unsigned = ~text & (last == ord("i")), ~text & (last == ord("u"))
    rest = ~(text | whole | unsigned)
    n = len(start)

    number = _whole(marks, digits, start, end - 1, whole, line)
    natural = _whole(marks, digits, start, end - 1, unsigned, line, signed=False)

    letter = rest & ((first | 32 == ord("t")) | (first | 32 == ord("f")))
    truth = np.zeros(n, bool)
    if letter.any():
        named = _slices(data, start[letter], end[letter], pa.binary())
        known = np.asarray(pc.is_in(named, _BOOLEAN))
        truth[letter] = np.asarray(pc.is_in(named, _TRUE))
        good[line[letter][~known]] = False
    real = rest & ~letter
    decimal = np.zeros(n, np.float64)
    dots = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == ord("."), out=dots[1:])
    n_dots = dots[end] - dots[start]
    minus = (first == 45).astype(np.int32)
    n_digits = digits[end] - digits[start]
    simple = real & (n_dots <= 1) & (n_digits + n_dots + minus == end - start) & (n_digits <= 300)
    simple &= _DIGIT[last] & _DIGIT[data[np.minimum(start + minus, len(data) - 1)]]
    decimal[simple] = _slices(data, start[simple], end[simple], pa.string()).cast(pa.float64()).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(real & ~simple):
        token = data[start[i] : end[i]].tobytes()
        if _EXPONENT.fullmatch(token):
            decimal[i] = float(token)
        else:
            good[line[i]] = False

    # a string ends where its value ends, and no other quotes are in the field set
    s_start, s_end = np.where(text, start + 1, 0), np.where(text, end - 1, 0)
    place = np.minimum(np.searchsorted(marks.quotes, end - 1), max(0, len(marks.quotes) - 1))
    closed = ~text | ((end - start >= 2) & (marks.quotes[place] == end - 1)) if len(marks.quotes) else ~text
    good[line[~closed]] = False
    s_end = np.maximum(s_start, s_end)
    count = len(good)
    good &= np.bincount(marks.quote_line, minlength=count) == 2 * np.bincount(line[text], minlength=count)
    inside = _slices(data, s_start, s_end, pa.string())
    if len(marks.back):
        inside = pc.if_else(pc.match_substring(inside, "\\"), pc.replace_substring_regex(inside, r'\\(["\\])', r"\1"), inside)
        # outside of strings a backslash is no escape in a value
        seen = np.zeros(len(data) + 1, np.int32)
        seen[marks.back + 1] = 1
        np.cumsum(seen, out=seen)
        good[line[~text & (seen[end] > seen[start])]] = False

    def only(values: np.ndarray, which: np.ndarray) -> pa.Array:
        return pa.array(values, mask=~which)

    strings = pc.if_else(pa.array(text), inside, pa.scalar(None, pa.string()))
    return pa.StructArray.from_arrays(
        [only(decimal, real), only(number, whole), only(natural, unsigned).cast(pa.decimal128(20, 0)), strings, only(truth, letter)], fields=list(VALUE)
    )


def _repeated(names: pa.Array, line: np.ndarray, count: int) -> np.ndarray:
    """Lines that hold a name twice."""
    out = np.zeros(count, bool)
    if not len(names):
        return out
    code = names.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(line, kind="stable")
    line, code = line[order], code[order]
    longest = int(np.bincount(line).max())
    if longest <= NEAR:
        for step in range(1, longest):
            same = (code[step:] == code[:-step]) & (line[step:] == line[:-step])
            out[line[step:][same]] = True
        return out
    both = line * (code.max() + 1) + code
    both.sort()
    out[both[1:][both[1:] == both[:-1]] // (code.max() + 1)] = True
    return out


def parse(lines: pa.Array) -> pa.Array:
    """Lines as measurement, tags, fields, time in its own unit, and why a line is refused."""
    return parse_stretches(lines, CHUNK)


def parse_stretches(lines: pa.Array, chunk: int) -> pa.Array:
    """`parse` by stretches of at most `chunk` bytes, or one line."""
    if isinstance(lines, pa.ChunkedArray):
        lines = lines.combine_chunks()
    lines = lines.cast(pa.large_binary())
    cuts = _stretches(lines, chunk)
    if len(cuts) <= 2:
        return _parse(lines)
    return pa.concat_arrays([_parse(lines.slice(a, b - a)) for a, b in itertools.pairwise(cuts)])


def _stretches(lines: pa.LargeBinaryArray, chunk: int) -> list[int]:
    """Where to cut lines so that no stretch of several is longer than `chunk` bytes."""
    if not len(lines):
        return [0, 0]
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    cuts = [0]
    while cuts[-1] < len(lines):
        fit = int(np.searchsorted(ends, ends[cuts[-1]] + chunk, "right")) - 1
        cuts.append(max(fit, cuts[-1] + 1))
    return cuts


def _parse(lines: pa.LargeBinaryArray) -> pa.Array:
    found = by_index(lines)
    if not found.null_count:
        return found
    left = np.flatnonzero(np.asarray(found.is_null()))
    others = pa.array([parse_line(lp) for lp in lines.take(pa.array(left)).to_pylist()], PARSED)
    place = np.arange(len(found))
    place[left] = len(found) + np.arange(len(left))
    return pa.concat_arrays([found, others]).take(pa.array(place))


def by_index(lines: pa.LargeBinaryArray) -> pa.Array:
    """The lines that the marks alone explain; null for others."""
    count = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + count + 1]
    if not count or offsets[-1] == offsets[0]:
        return pa.nulls(count, PARSED)
    data = np.frombuffer(lines.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    marks = Marks(data, start, end)
    good = marks.good
    good &= np.asarray(lines.is_valid()) & (end > start)

    _alternate(marks, marks.in_head, COMMA)
    _alternate(marks, ~marks.in_head, EQUALS)
    good &= _per_line(marks.line, count, marks.in_head) % 2 == 0
    good &= _per_line(marks.line, count, ~marks.in_head) % 2 == 1

    digits = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_DIGIT[data], out=digits[1:])
    timed = marks.tail < end
    t_start = np.where(timed, marks.tail + 1, end)
    times = _whole(marks, digits, t_start, end, timed & good, np.arange(count))

    # from here on only marks of lines whose marks are in order, so that they pair up
    keep = good[marks.line]
    at, line, in_head = marks.at[keep], marks.line[keep], marks.in_head[keep]
    equal = marks.kind[keep] == EQUALS
    tag_begin, tag_equals = at[in_head & ~equal], at[in_head & equal]
    tag_line = line[in_head & equal]
    commas, equals = at[~in_head & ~equal], at[~in_head & equal]
    field_line = line[~in_head & equal]
    field_begin = marks.head[field_line]
    field_begin[np.flatnonzero(field_line[1:] == field_line[:-1]) + 1] = commas

    def until(begin: np.ndarray, of: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where each pair ends: at the next pair of its line, or at the line's stop."""
        out = stop[of]
        follows = np.flatnonzero(of[1:] == of[:-1])
        out[follows] = begin[follows + 1]
        return out

    m_end = marks.head.copy()
    opens = np.flatnonzero(np.diff(tag_line, prepend=-1))
    m_end[tag_line[opens]] = tag_begin[opens]
    good &= m_end > start
    tag_name, tag_end = tag_begin + 1, until(tag_begin, tag_line, marks.head)
    good[tag_line[tag_equals <= tag_name]] = False
    field_name, field_end = field_begin + 1, until(field_begin, field_line, marks.tail)
    good[field_line[(equals <= field_name) | (equals + 1 >= field_end)]] = False

    # drop lines found wrong meanwhile, then read the values of the others
    t, f = good[tag_line], good[field_line]
    tag_line, tag_name, tag_equals, tag_end = (x[t] for x in (tag_line, tag_name, tag_equals, tag_end))
    field_line, field_name, equals, field_end = (x[f] for x in (field_line, field_name, equals, field_end))
    tag_keys = _slices(data, tag_name, tag_equals, pa.string())
    tag_values = _slices(data, tag_equals + 1, tag_end, pa.string())
    keys = _slices(data, field_name, equals, pa.string())
    names = _slices(data, np.where(good, start, 0), np.where(good, m_end, 0), pa.string())
    if len(marks.back):
        names = _unescaped(names, b", ")
        tag_keys, tag_values, keys = (_unescaped(x, b",= ") for x in (tag_keys, tag_values, keys))
    values = _values(marks, digits, field_line, equals + 1, field_end)
    good &= ~_repeated(pa.concat_arrays([tag_keys, keys]), np.concatenate([tag_line, field_line]), count)

    tags = pa.MapArray.from_arrays(_runs(np.bincount(tag_line, minlength=count)), tag_keys, tag_values)
    fields = pa.ListArray.from_arrays(_runs(np.bincount(field_line, minlength=count)), pa.StructArray.from_arrays([keys, values], fields=list(FIELD)))
    return pa.StructArray.from_arrays([names, tags, fields, pa.array(times, mask=~timed), pa.nulls(count, pa.string())], fields=list(PARSED), mask=pa.array(~good))

