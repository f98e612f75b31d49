"""Text of numbers and booleans, as SQL expression text.

The functions here take and return SQL text: a float expression has over a hundred nodes,
which the parser builds at once and a chain of Column calls builds one call at a time.
`F.expr` makes a column of it.

Floats print the shortest digits that read back to the same value: plain notation inside
a fixed range, `d.ddde-x` outside. Spark's own cast already prints that text between 1e-3
and 1e7, so almost every cell takes one cast. The other branches re-lay the digits of the
cast: inside the plain range through a wide enough DECIMAL (made from the text, so no
digit changes), outside by a regular expression on the exponent.

Java before 19 prints too many digits for some large or small values. `_digits` repairs
that by trying 15 to 17 digits when 17 or more were printed.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@dataclass(frozen=True)
class _Layout:
    spark_type: str
    plain_from: float  # smallest absolute value in plain notation
    plain_below: float
    whole_below: float  # whole numbers below it are all distinct values
    big_decimal: str  # holds every digit of 1e7 <= v < plain_below
    small_decimal: str  # holds every digit of plain_from <= v < 1e-3
    long_text: int  # length of the cast text from which digits may be too many
    shorter: tuple[str, ...]

    def limit(self, v: float) -> str:
        # in the width of the column: 0.001 as FLOAT is not 0.001 as DOUBLE
        return f"cast({v!r}D as {self.spark_type})"

    def between(self, a: str, low: float, high: float) -> str:
        return f"({a} >= {self.limit(low)} AND {a} < {self.limit(high)})"


# The notation ranges of the two float widths.
_F64 = _Layout(
    "double", 1e-5, 1e16, 9e15, "decimal(27,10)", "decimal(30,24)", 20, ("%.14e", "%.15e", "%.16e")
)
_F32 = _Layout("float", 1e-6, 1e13, 1e7, "decimal(24,10)", "decimal(24,20)", 11, ("%.6e", "%.7e"))


def _digits(a: str, w: _Layout) -> str:
    """Shortest scientific text of a non-negative value."""
    text = f"cast({a} as string)"
    tries = " ".join(
        f"WHEN cast(format_string('{f}', {a}) as {w.spark_type}) = {a} "
        f"THEN format_string('{f}', {a})"
        for f in w.shorter
    )
    return f"CASE WHEN length({text}) < {w.long_text} THEN {text} {tries} ELSE {text} END"


def _plain(a: str, w: _Layout, decimal: str) -> str:
    # keep one digit after the point, drop the zeros that the decimal scale added
    text = f"cast(cast({_digits(a, w)} as {decimal}) as string)"
    return rf"regexp_replace({text}, r'(\.\d+?)0*$', '$1')"


def _scientific(a: str, w: _Layout) -> str:
    text = f"replace({_digits(a, w)}, 'E', 'e')"
    return rf"regexp_replace({text}, r'\.?0*e\+?(-?)0*(\d)', 'e$1$2')"


def _bound(v: str, body: str) -> str:
    """`body` over `x`, the value of `v`.

    As a lambda the body is compiled apart from the row loop, which stays small enough for
    the JIT even with many float columns.
    """
    return f"get(transform(array({v}), x -> {body}), 0)"


def _rare(w: _Layout) -> str:
    """Text of any float `x`; used where the cast alone is not the text."""
    a, sign = "abs(x)", "CASE WHEN x < 0 THEN '-' ELSE '' END"
    return (
        f"CASE WHEN isnan(x) THEN 'NaN' WHEN {a} = double('inf') THEN concat({sign}, 'inf') "
        f"WHEN {w.between(a, w.plain_from, 1e-3)} "
        f"THEN concat({sign}, {_plain(a, w, w.small_decimal)}) "
        f"WHEN {w.between(a, 1e7, w.plain_below)} "
        f"THEN concat({sign}, {_plain(a, w, w.big_decimal)}) "
        f"ELSE concat({sign}, {_scientific(a, w)}) END"
    )


def _float_text(v: str, w: _Layout) -> str:
    # Whole numbers print as integers, several times faster than as floats.
    whole = f"abs({v}) < {w.limit(w.whole_below)} AND {v} <> 0 AND {v} = cast({v} as bigint)"
    usual = f"{w.between(f'abs({v})', 1e-3, 1e7)} OR {v} = 0"
    branches = (
        f"WHEN {whole} THEN concat(cast(cast({v} as bigint) as string), '.0') "
        f"WHEN {usual} THEN cast({v} as string) "
    )
    if w is _F64:
        # In these ranges digits need no repair, and the value is not whole.
        for low, high, decimal in (
            (1e7, w.whole_below, w.big_decimal),
            (w.plain_from, 1e-3, w.small_decimal),
        ):
            branches += (
                f"WHEN {w.between(f'abs({v})', low, high)} "
                f"THEN rtrim('0', cast(cast({v} as {decimal}) as string)) "
            )
    return f"CASE {branches}WHEN {v} IS NOT NULL THEN {_bound(v, _rare(w))} END"


def f64_text(v: str) -> str:
    return _float_text(v, _F64)


def f32_text(v: str) -> str:
    """Own shortest text of a FLOAT; it is not widened first, so 0.1 stays 0.1."""
    return _float_text(v, _F32)


def int_text(v: str) -> str:
    return f"concat(cast({v} as string), 'i')"


def uint_text(v: str) -> str:
    return f"concat(cast({v} as string), 'u')"


def bool_text(v: str) -> str:
    return f"cast({v} as string)"


def float_display(v: str, width: str = "double") -> str:
    """Display text of a float: never an exponent, and 1.0 shows as 1."""
    w = _F64 if width == "double" else _F32
    sign = "CASE WHEN x < 0 OR cast(x as string) = '-0.0' THEN '-' ELSE '' END"
    text = _scientific("abs(x)", w)
    digits = f"replace(substring_index({text}, 'e', 1), '.', '')"
    exponent = f"cast(substring_index({text}, 'e', -1) as int)"
    inner = (
        f"CASE WHEN isnan(x) THEN 'NaN' WHEN abs(x) = double('inf') THEN concat({sign}, 'inf') "
        f"WHEN x = 0 OR {w.between('abs(x)', w.plain_from, w.plain_below)} "
        rf"THEN concat({sign}, regexp_replace({_float_text('abs(x)', w)}, r'\.0$', '')) "
        f"WHEN abs(x) > 1 THEN concat({sign}, rpad({digits}, {exponent} + 1, '0')) "
        f"ELSE concat({sign}, '0.', repeat('0', -{exponent} - 1), {digits}) END"
    )
    return f"CASE WHEN {v} IS NOT NULL THEN {_bound(v, inner)} END"


@F.arrow_udf(StringType())
def exact_f64_text(values: pa.Array) -> pa.Array:
    """The exact shortest digits on every Java version, at the price of a Python worker.

    Only needed for values near the ends of the double range under Java before 19, where
    the expression above may print another digit string that still reads back equal.
    """
    return pa.array([None if v is None else _layout_one(v) for v in values.to_pylist()])


def _layout_one(v: float) -> str:
    if v != v or abs(v) == float("inf"):
        return "NaN" if v != v else repr(v)
    if v == 0:
        return repr(v)
    number = Decimal(repr(v)).normalize()
    if _F64.plain_from <= abs(v) < _F64.plain_below:
        text = format(number, "f")
        return text if "." in text else text + ".0"
    mantissa, _, exponent = f"{number:e}".partition("e")
    return f"{mantissa}e{int(exponent)}"
