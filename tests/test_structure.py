"""The structural index against the patterns, which hold the grammar."""

import random

import pyarrow as pa
import pytest

from tslines.functions import structure
from tslines.operators.decode import parse_by_pattern, parse_lines

NAMES = ["a", "bc", "é", "\\,", "\\ ", "\\=", "\\\\", '"', "x1", "\\q"]
VALUES = [
    "1i", "-7i", "12.5", "1e7", "-1.5E-3", "t", "False", "8u", '"a b"', '"q\\"z,="', '"\\\\"', '""', '"a\nb"', "NaN", "1d", ".5", "5.", "+1", "007", "99999999999999999999i",
    "9223372036854775807i", "9223372036854775808i", "-9223372036854775808i", "18446744073709551615u", "18446744073709551616u", "x", " ", '"open', "-", "-i", "1_0", "tru", "i",
    "u", "1.2.3", "--1", '"a"b', 'a"b', '"x\\', "1\\", "9" * 400, "\t1", "\t1i", "é", '""\\"', "-0", "1e999", "٣i",
]
TIMES = ["", " 5", " -17", " 1x", " 99999999999999999999", " 1234567890123456789", " ", " 5 6", " +5", " 9223372036854775808", "\n"]


def line(dice):
    def name():
        return "".join(dice.choice(NAMES) for _ in range(dice.randint(1, 3)))

    tags = "".join(f",{name()}={dice.choice(['', 'v', name(), chr(34)])}" for _ in range(dice.randint(0, 3)))
    fields = ",".join(f"{name()}={dice.choice(VALUES)}" for _ in range(dice.randint(1, 3)))
    return f"{name()}{tags} {fields}{dice.choice(TIMES)}"


def wild(dice):
    parts = [*NAMES, *VALUES, ",", "=", " ", "\\", "\0", "#", ",k=v", " f=1", " 17"]
    return "".join(dice.choice(parts) for _ in range(dice.randint(0, 9)))


@pytest.mark.parametrize("precision", ["ns", "ms"])
def test_index_agrees_with_the_patterns(spark, precision):
    dice = random.Random(precision)
    lines = [line(dice) for _ in range(6000)] + ["m v=" + v for v in VALUES] + [wild(dice) for _ in range(3000)]
    lines += [None, "", " ", ",", "m", "m=x,a=1 v=1i", 'm,t=q"x v=2i 2', 'm a"b=1i', "m v=1i\n"]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, lp string").repartition(3)

    def rows(parsed):
        return {r.n: (r.measurement, r.tags, str(r.fields), r.time_ns, r.reject) for r in parsed.collect()}

    got, want = rows(parse_lines(df, precision)), rows(parse_by_pattern(df, precision))
    assert {n: (lines[n], got.get(n), w) for n, w in want.items() if got.get(n) != w} == {}
    assert sum(r[4] is None for r in want.values()) > 200


def plain(lines):
    return structure.by_index(pa.array(lines, pa.large_binary())).to_pylist()


def test_regular_lines_need_no_pattern():
    lines = [
        b"m,a=1,b=x\\ y f=1.5,i=-7i,u=7u,s=\"q\\\"\\\\ ,=\",t=true,e=1e-7 1704067211172425000",
        b"m\\,1 v=F", b'm v=""', b"m,k= v=t -9223372036854775807", "mé,é=ß v=\"中\n文\"".encode(),
    ]
    rows = plain(lines)
    assert None not in rows
    first = rows[0]
    assert first["measurement"] == "m" and first["time"] == 1704067211172425000
    assert dict(first["tags"]) == {"a": "1", "b": "x y"}
    assert [next(v for v in f["value"].values() if v is not None) for f in first["fields"]] == [1.5, -7, 7, 'q"\\ ,=', True, 1e-7]
    assert rows[1]["measurement"] == "m,1" and rows[3]["time"] == -9223372036854775807 and rows[2]["time"] is None


def test_lines_do_not_leak_into_each_other():
    # backslashes and quotes at the end of one line and the start of the next
    lines = [b"m\\", b"\\,m v=1i", b'm v="open', b'" v=1i', b"m v=1i", b"\\\\", b"\\ x v=2i", b"", b"m v=3i"]
    rows = plain(lines)
    assert [r and r["fields"][0]["value"]["i"] for r in rows] == [None, 1, None, 1, 1, None, 2, None, 3]
    assert rows[1]["measurement"] == ",m" and rows[6]["measurement"] == " x"
    one_by_one = [plain([x])[0] for x in lines]
    assert one_by_one == rows


def test_slices_of_a_batch():
    whole = pa.array([f"m v={i}i {i}" for i in range(50)])
    assert structure.parse(whole.slice(7, 20)).to_pylist() == structure.parse(whole).to_pylist()[7:27]
    assert structure.parse(pa.chunked_array([whole.slice(0, 3), whole.slice(3)])).to_pylist() == structure.parse(whole).to_pylist()
    assert structure.parse(pa.array([], pa.string())).to_pylist() == []


def test_repeated_names_in_short_and_wide_lines():
    wide = ",".join(f"f{i}={i}i" for i in range(400))
    rows = plain([f"m {wide}".encode(), f"m {wide},f7=1i".encode(), b"m a=1i,a=2i", b"m,a=1 a=2i", b"m,a=1,a=2 b=2i", b"n a=1i"])
    assert [r is None for r in rows] == [False, True, True, True, True, False]
    assert len(rows[0]["fields"]) == 400


def test_long_batches_are_parsed_by_stretches(monkeypatch):
    dice = random.Random(4)
    lines = [line(dice) for _ in range(300)] + [wild(dice) for _ in range(100)] + [None, "", "m v=1i", 'm s="' + "x" * 5000 + '"']
    dice.shuffle(lines)
    array = pa.array(lines, pa.large_string())
    want = structure._parse(array.cast(pa.large_binary()))
    for chunk in (1, 100, 4000):
        assert structure.parse_stretches(array, chunk).equals(want)
        assert structure.parse_stretches(array.slice(50, 200), chunk).equals(want.slice(50, 200))
    sizes, parse = [], structure.by_index
    monkeypatch.setattr(structure, "by_index", lambda x: sizes.append(sum(len(v.as_py()) for v in x)) or parse(x))
    structure.parse(pa.array(['m s="' + "x" * 990 + '"'] * 5000))
    assert sum(sizes) == 5000 * 996 and max(sizes) <= 1 << 20
