"""Lines with breaks inside of strings, read in blocks, against whole bodies."""

import random

import numpy as np
import pytest

from tslines.operators.decode import explode_lines, has_point
from tslines.sources.files import read_lp
from tslines.sources.logical import _states, read_logical_lines

PIECES = [
    "\n", "\n", "\r\n", '"', '"', "\\", '\\"', "\\\\", " ", ",", "=", 'm v="', "m v=1i", 'm,k=q"x v="a', '",w="', '",w=2i', '" 5', "x", "é", "# c", 'v="', "m\\ n f=", '=""', "m a=1,b=\"",
]


def body(dice, n):
    return "".join(dice.choice(PIECES) for _ in range(n))


@pytest.fixture
def blocks(spark):
    """Files read in blocks of a few bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "60", "spark.sql.files.openCostInBytes": "0"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k in names:
        spark.conf.unset(k)


def test_blocks_agree_with_whole_bodies(spark, blocks, tmp_path):
    dice = random.Random(1)
    bodies = [body(dice, dice.randint(20, 90)) for _ in range(14)]
    bodies += ['m v="never closed\nm v=1i\nm \\"x\nm v=2i', 'm v="a\nb",w="c\n\nm v=1i', "", "\n\n", '"\n"\n', 'm v="\\\n" 1\nm v=1i\n', "m v=1i\r\nm v=2i\r"]
    for i, text in enumerate(bodies):
        (tmp_path / f"{i:03}.lp").write_bytes(text.encode())
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies) if b], "batch_id long, body string")
    want = {(r.batch_id, r.line): r.lp for r in explode_lines(df, multiline=True).collect()}
    read = read_logical_lines(spark, str(tmp_path))
    assert read.where("file like '%000.lp'").rdd.getNumPartitions() > 1
    got = {(int(r.file.split("/")[-1][:3]), r.line): r.lp for r in read.where(has_point(read["lp"])).collect()}
    wrong = {k[0] for k in want.keys() | got.keys() if want.get(k) != got.get(k)}
    assert {i: bodies[i] for i in wrong} == {}
    assert sum("\n" in lp for lp in want.values()) > 5


def test_whole_files_in_one_task_agree_too(spark, tmp_path):
    dice = random.Random(2)
    bodies = [body(dice, dice.randint(0, 200)) for _ in range(150)]
    for i, text in enumerate(bodies):
        (tmp_path / f"{i:03}.lp").write_bytes(text.encode())
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies) if b], "batch_id long, body string")
    want = {(r.batch_id, r.line): r.lp for r in explode_lines(df, multiline=True).collect()}
    read = read_logical_lines(spark, str(tmp_path))
    got = {(int(r.file.split("/")[-1][:3]), r.line): r.lp for r in read.where(has_point(read["lp"])).collect()}
    wrong = {k[0] for k in want.keys() | got.keys() if want.get(k) != got.get(k)}
    assert {i: bodies[i] for i in wrong} == {}
    assert sum("\n" in lp for lp in want.values()) > 20


def test_states_follow_blocks_over_batches():
    dice = random.Random(3)
    block = np.repeat(np.arange(9), [dice.randint(1, 12) for _ in range(9)])
    out, ins = (np.array([dice.random() < 0.5 for _ in block]) for _ in range(2))
    want = []
    for i, b in enumerate(block):
        if not i or block[i - 1] != b:
            states, lines, place = [False, True], [0, 0], 0
        begin = list(states)
        states = [bool((ins if s else out)[i]) for s in states]
        lines = [n + (not s) for n, s in zip(lines, begin, strict=True)]
        want.append((place, *begin, *states, *lines))
        place += 1
    for size in (1, 3, 7, 100):
        carry = {"block": None, "place": 0, "state": [False, True], "lines": [0, 0]}
        parts = [_states(block[a : a + size], out[a : a + size], ins[a : a + size], carry) for a in range(0, len(block), size)]
        got = [np.concatenate(c).tolist() for c in zip(*parts, strict=True)]
        assert list(zip(*got, strict=True)) == want


def test_read_lp_keeps_breaks_in_files_of_any_size(spark, blocks, tmp_path):
    lines = [f'm,k={i} s="line {i}\n\nmore, \\"text\\" = {i}\n",v={i}i {i}' for i in range(12)]
    (tmp_path / "a.lp").write_text("\n".join(lines) + "\nbad\n")
    rows = read_lp(spark, str(tmp_path), multiline=True, layout="lines", max_whole_file=1).orderBy("line").collect()
    assert [r.line for r in rows] == list(range(1, 14))
    assert [r.reject for r in rows] == [None] * 12 + ["cannot be parsed"]
    assert rows[7].fields[0].value.s == 'line 7\n\nmore, "text" = 7\n' and rows[7].time_ns == 7
