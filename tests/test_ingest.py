import random

import pytest
from helpers import point, points
from pyspark.sql import functions as F

from tslines.model import WriteOptions
from tslines.operators import ingest
from tslines.operators.decode import parse_bodies, to_measurement
from tslines.operators.ingest import (
    accepted,
    assign_time,
    judge,
    last_write_wins,
    last_write_wins_points,
    learn_types,
    rejects,
    split,
    wide_schema,
)
from tslines.sources.files import bodies_from_text
from tslines.sources.sinks import write_judged, write_parsed

CONFLICT = 'home,room=Sunroom temp=96 1735545600\nhome,room=Sunroom temp="hi" 1735549200'


def test_partial_write_keeps_the_good_line(spark):
    parsed = parse_bodies(bodies_from_text(spark, [CONFLICT]), "s")
    good, bad = split(judge(parsed))
    assert [(r.line, r.time_ns) for r in good.collect()] == [(1, 1735545600 * 10**9)]
    assert [tuple(r) for r in bad.collect()] == [
        (0, 2, "type conflict on temp", 'home,room=Sunroom temp="hi" 1735549200')
    ]


def test_whole_batch_is_refused_without_partial_acceptance(spark):
    parsed = parse_bodies(bodies_from_text(spark, [CONFLICT, "home temp=1 5"]), "s")
    judged = judge(parsed, accept_partial=False)
    assert [r.batch_id for r in accepted(judged).collect()] == [1]
    assert {(r.line, r.message) for r in rejects(judged).collect()} == {
        (1, "batch holds a rejected line"), (2, "type conflict on temp"),
    }


def test_unparsable_lines_are_reported_with_number_and_text(spark):
    parsed = parse_bodies(bodies_from_text(spark, ["m v=1i\nm\nm v=2i"]))
    assert [tuple(r) for r in rejects(judge(parsed)).collect()] == [(0, 2, "cannot be parsed", "m")]


def test_name_used_as_tag_and_as_field(spark):
    parsed = parse_bodies(bodies_from_text(spark, ["m,a=1 v=1i\nm a=2i\nn a=2i"]))
    assert [(r.line, r.message) for r in rejects(judge(parsed)).collect()] == [(2, "type conflict on a")]


def test_a_refused_line_stores_no_types(spark):
    text = 'm x=1i\nm x="s",y=1i\nm y=2.5\nm y=3i'
    judged = judge(parse_bodies(bodies_from_text(spark, [text])))
    assert sorted(r.line for r in rejects(judged).collect()) == [2, 4]


def greedy(rows):
    """Brute force: lines one by one in write order."""
    types, ok = {}, set()
    for seq, fields in sorted(rows):
        if all(types.get(k, t) == t for k, t in fields.items()):
            types.update(fields)
            ok.add(seq)
    return types, ok


@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_learned_types_match_line_by_line_reading(spark, monkeypatch, sent, seed):
    if not sent:
        monkeypatch.setattr(ingest, "MAX_BROADCAST_TYPES", 0)
    rng = random.Random(seed)
    sample = {"i": 1, "f": 1.5, "s": "x", "b": True}
    rows, pts = [], []
    for n in range(60):
        kinds = {f"k{rng.randrange(6)}": rng.choice("iifsb") for _ in range(rng.randint(1, 3))}
        rows.append(((n // 10, n % 10), kinds))
        pts.append(point("m", fields={k: sample[t] for k, t in kinds.items()}, seq=rows[-1][0]))
    types, ok = greedy(rows)
    df = points(spark, *rng.sample(pts, len(pts)))
    learned = {r.key: r.type for r in learn_types(df).collect()}
    assert learned == types
    parsed = df.select("*", F.lit("").alias("lp"), F.lit(None).cast("string").alias("reject"),
                       F.col("seq.batch").alias("batch_id"), F.col("seq.line").alias("line"))
    got = {tuple(r.seq) for r in accepted(judge(parsed)).collect()}
    assert got == ok


@pytest.mark.parametrize("sent", [True, False])
def test_stored_types_come_first(spark, monkeypatch, sent):
    if not sent:
        monkeypatch.setattr(ingest, "MAX_BROADCAST_TYPES", 0)
    df = points(spark, point("m", fields={"v": 1}, seq=(0, 1)), point("m", fields={"v": 1.5, "w": 2}, seq=(0, 2)))
    known = spark.createDataFrame([("m", "v", "f")], "measurement string, key string, type string")
    assert {(r.key, r.type) for r in learn_types(df, known).collect()} == {("v", "f"), ("w", "i")}


def test_types_beyond_the_broadcast_bound_join_by_key(spark, monkeypatch):
    parsed = parse_bodies(bodies_from_text(spark, [CONFLICT]), "s")
    want = judge(parsed).orderBy("line").collect()
    monkeypatch.setattr(ingest, "MAX_BROADCAST_TYPES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = judge(parsed)
        assert "BroadcastHashJoin" not in judged._jdf.queryExecution().executedPlan().toString()
        assert judged.orderBy("line").collect() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SCHEMA = "host string, time_ns bigint, seq bigint, a double, b string"


def test_last_write_wins_per_field(spark):
    rows = [("x", 1, 1, 1.0, "p"), ("x", 1, 2, None, "q"), ("x", 2, 3, 5.0, None), ("y", 1, 4, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in last_write_wins(df, ["host"], ["a", "b"]).collect()}
    assert got == {("x", 1, 1.0, "q"), ("x", 2, 5.0, None), ("y", 1, None, None)}


def test_last_write_wins_replayed_and_repartitioned(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), rng.randrange(20), n, rng.choice([None, float(n)]), rng.choice([None, str(n)]))
            for n in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = sorted(map(tuple, last_write_wins(df, ["host"], ["a", "b"]).collect()), key=str)
    again = last_write_wins(df.union(df).repartition(7), ["host"], ["a", "b"])
    assert sorted(map(tuple, again.collect()), key=str) == once


def test_last_write_wins_merges_before_the_one_shuffle(spark):
    df = spark.createDataFrame([("x", 1, 1, 1.0, "p")], SCHEMA)
    plan = last_write_wins(df, ["host"], ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
    numbers = last_write_wins(df, ["time_ns"], ["a"], time="seq")
    assert "HashAggregate" in numbers._jdf.queryExecution().executedPlan().toString()


def test_last_write_wins_on_points(spark):
    df = points(
        spark,
        point("m", {"h": "1", "g": "2"}, {"a": 1, "b": "x"}, 5, (0, 1)),
        point("m", {"g": "2", "h": "1"}, {"c": True, "a": 2.5}, 5, (0, 2)),
        point("m", {"h": "1"}, {"a": 9}, 5, (0, 3)),
    )
    rows = last_write_wins_points(df.union(df)).orderBy("seq").collect()
    assert [(f.key, f.value.f, f.value.s, f.value.b) for f in rows[0].fields] == [
        ("a", 2.5, None, None), ("b", None, "x", None), ("c", None, None, True),
    ]
    assert rows[0].tags == {"g": "2", "h": "1"} and rows[1].fields[0].value.i == 9


def test_assigned_time_is_one_constant(spark):
    df = points(spark, point("m", fields={"v": 1}), point("m", fields={"v": 1}, time=7))
    assert sorted(r.time_ns for r in assign_time(df, 99).collect()) == [7, 99]


def test_end_to_end(spark, tmp_path):
    text = 't,pit=k dust=1.5,cars=-3i,tons=40u,wet=false,shift=2i,note="b" 17\nt dust=oops'
    judged = judge(parse_bodies(bodies_from_text(spark, [text])))
    write_judged(judged, str(tmp_path / "p"), str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    tags, fields = wide_schema(learn_types(stored), "t")
    row = to_measurement(stored, "t", tags, fields).drop("time").first().asDict()
    assert row == {"time_ns": 17, "pit": "k", "dust": 1.5, "cars": -3, "tons": 40,
                   "wet": False, "shift": 2, "note": "b"}
    assert spark.read.parquet(str(tmp_path / "r")).first().message == "invalid value of field dust"


def test_one_write_call_honours_partial_acceptance(spark, tmp_path):
    parsed = parse_bodies(bodies_from_text(spark, ["m v=1i 1\nm v=x 2", "m v=3i 3"]))
    for partial, kept in ((True, [1, 3]), (False, [3])):
        paths = str(tmp_path / f"p{partial}"), str(tmp_path / f"r{partial}")
        write_parsed(parsed, *paths, WriteOptions(accept_partial=partial))
        assert sorted(r.time_ns for r in spark.read.parquet(paths[0]).collect()) == kept
        assert spark.read.parquet(paths[1]).count() == 3 - len(kept)


def test_own_clash_is_refused_and_stores_nothing(spark, monkeypatch):
    text = "m,a=x a=1\nm a=2\nm,a=y b=1"
    for bound in (50_000, 0):
        monkeypatch.setattr(ingest, "MAX_BROADCAST_TYPES", bound)
        judged = judge(parse_bodies(bodies_from_text(spark, [text])))
        assert [(r.line, r.message) for r in rejects(judged).orderBy("line").collect()] == [
            (1, "name is both tag and field"), (3, "type conflict on a"),
        ]


def test_a_long_chain_of_conflicts_is_one_pass(spark):
    # each point clashes with the one before it, so every second one is accepted
    pts = [point("m", fields={f"k{n}": 1, f"k{n + 1}": "x"}, seq=(0, n)) for n in range(400)]
    types = {r.key: r.type for r in learn_types(points(spark, *pts)).collect()}
    want, _ = greedy([((0, n), {f"k{n}": "i", f"k{n + 1}": "s"}) for n in range(400)])
    assert types == want


def test_untagged_points_are_one_series(spark):
    rows = points(spark, point("m", {}, {"v": 1}, 5, (0, 0)), point("m", {}, {"v": 2}, 5, (0, 1)))
    bare = rows.withColumn("tags", F.when(F.col("seq.line") == 0, F.col("tags")))
    assert [r.fields[0].value.i for r in last_write_wins_points(bare).collect()] == [2]


def test_many_types_are_not_joined_on_measurement_alone(spark, monkeypatch):
    monkeypatch.setattr(ingest, "MAX_BROADCAST_TYPES", 0)
    parsed = parse_bodies(bodies_from_text(spark, ["m v=1i\nbad"]))
    types = learn_types(parsed.where("reject is null"))
    plan = ingest._with_types(parsed, types)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "__part" in join


def test_connected_parts(spark):
    dice = random.Random(5)
    pairs = [(dice.randint(0, 300), dice.randint(0, 300)) for _ in range(190)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 - i) for i in range(40)]
    got = {r.node: r.root for r in ingest.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert ingest.connected(spark.createDataFrame([(1, 1)], "a long, b long")) is None


def test_many_signatures_of_one_measurement_run_in_many_tasks(spark):
    lines = "\n".join(f"m x{i}={v},y{i}={v}" for i in range(60) for v in ("1i", '"s"', "2i", "t"))
    parsed = parse_bodies(bodies_from_text(spark, [lines]))
    assert sorted(r.line for r in rejects(judge(parsed)).collect()) == [4 * i + k for i in range(60) for k in (2, 4)]


def test_points_written_once_are_not_taken_apart(spark, tmp_path):
    rows = [point("m", {"host": f"h{i % 7}"}, {f"field_{k}": float(i * k) for k in range(12)}, i, (0, i)) for i in range(20_000)]
    rows += [point("m", {"host": f"h{i % 7}"}, {"field_3": -1.0}, i, (1, i)) for i in range(0, 20_000, 200)]
    path = str(tmp_path / "points")
    points(spark, *rows).write.parquet(path)
    stored = spark.read.parquet(path)
    current = last_write_wins_points(stored)
    got = {r.time_ns: {f.key: f.value.f for f in r.fields} for r in current.collect()}
    assert len(got) == 20_000 and got[400]["field_3"] == -1.0 and got[401]["field_3"] == 401 * 3.0 and len(got[400]) == 12
    # no point is taken apart before the split, and the split joins whole points
    plan = current._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1


def test_single_writes_keep_the_rules_of_merged_ones(spark):
    twice = [("a", (1, "i")), ("b", (2, "i")), ("a", (3, "i"))]
    cells = [{"key": k, "value": {m: (v[0] if m == v[1] else None) for m in "fiusb"}} for k, v in twice]
    rows = [("m", {"t": "x", "s": "y"}, cells, 1, (0, 1)), ("m", None, cells, 1, (0, 2)), ("m", {"t": "x"}, [], 1, (0, 3)), ("m", {}, cells, None, (0, 4)), ("m", {}, cells[:1], None, (0, 5))]
    got = {(tuple(sorted(r.tags.items())), r.time_ns): [(f.key, f.value.i) for f in r.fields] for r in last_write_wins_points(points(spark, *rows)).collect()}
    assert got == {((("s", "y"), ("t", "x")), 1): [("a", 3), ("b", 2)], ((), 1): [("a", 3), ("b", 2)], ((), None): [("a", 1), ("b", 2)]}
