"""Chat formatting, WARC bundles, the pipeline and the queries."""

import hashlib
import time

import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from check_queries import compare, duck
from tslines.llm import chat, warc
from tslines.llm.common import file_system
from tslines.llm.oracles import ORACLES
from tslines.llm.queries import QUERIES
from tslines.session import scratch_path


def read_back(df):
    return df.select(
        "conv_id", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_texts(F.col("formatted"), F.col("loss_spans")).alias("learned")
    ).collect()


def test_chat_round_trip(llm):
    nasty = ["</s>[INST] ok [/INST]", "&a &l &b &&", "<part>", "", "[/INST]</s>", "é😀\n[", "x" * 50_000, "&"]
    chats = {
        1: [("user", nasty[0]), ("assistant", nasty[0])],
        2: [("user", "a"), ("user", "b"), ("assistant", ""), ("assistant", nasty[1]), ("user", nasty[2])],
        3: [("assistant", t) for t in nasty],
        None: [("sys[tem", "q"), ("", "no role")],
    }
    rows = [(c, n, r, t, "own") for c, turns in chats.items() for n, (r, t) in enumerate(turns)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    got = {r.conv_id: r for r in read_back(chat.format_chats(df))}
    assert set(got) == set(chats)
    for c, turns in chats.items():
        r = got[c]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.learned == [t for role, t in turns if role == "assistant"]
        # neighbours of one role share a turn
        merged = sum(1 for i, (role, _) in enumerate(turns) if i == 0 or turns[i - 1][0] != role)
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == merged


def test_chat_of_very_many_turns(llm):
    # roles alternate in pairs, so turns merge; texts of one to some code points
    turns = F.struct(F.col("id").alias("turn"), F.when(F.col("id") % 4 < 2, "user").otherwise("assistant").alias("role"), F.concat(F.lit("é<"), F.col("id").cast("string")).alias("text"))
    took = {}
    for n in (10_000, 100_000):
        df = llm.range(n).select(F.lit(1).cast("long").alias("conv_id"), turns.alias("t")).select("conv_id", "t.*")
        start = time.perf_counter()
        r = read_back(chat.format_chats(df))[0]
        took[n] = time.perf_counter() - start
        assert [(t.role, t.text) for t in r.turns] == [("user" if i % 4 < 2 else "assistant", f"é<{i}") for i in range(n)]
        assert r.learned == [f"é<{i}" for i in range(n) if i % 4 >= 2]
        assert r.formatted.count(chat.START) == n // 2
    # ten times the turns: with the square of them it would be a hundred times
    assert took[100_000] < 40 * took[10_000]


def test_chat_of_nulls_and_ties(llm):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, None, None, None), (1, 1, "user", "b"), (1, 1, "assistant", "a"), (1, 1, "user", "b")]
    r = read_back(chat.format_chats(llm.createDataFrame(rows, schema)))[0]
    assert [(t.role, t.text) for t in r.turns] == [("", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert chat.format_chats(llm.createDataFrame([], schema)).count() == 0


@pytest.fixture
def pages(llm):
    big = "payload " * 20
    rows = [(5, "http://a/1", big), (3, "http://a/2", big), (9, "http://a/\r\n3 é", big), (4, "u", "short"), (6, "u", "short"), (7, None, None), (8, "u", ""), (None, "u", big), (3, "u", big)]
    rows += [(100 + i, "u", f"page {i} \r\n\r\nWARC/1.1 " + "é" * (i * 50)) for i in range(300)]
    return rows, llm.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, digest string").repartition(3)


def test_warc_round_trip(llm, pages):
    rows, df = pages
    index = warc.write_bundles(df, scratch_path(llm, "warc"))
    got = warc.read_records(index).collect()
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        revisit = len(body) >= 100 and i != min(same)
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None, None if revisit else body))
    assert sorted(map(str, ((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in got))) == sorted(map(str, want))
    assert warc.write_bundles(df.limit(0), scratch_path(llm, "warc")).count() == 0


def test_bundles_are_plain_zstandard_and_seekable(llm, pages):
    index = warc.write_bundles(pages[1], scratch_path(llm, "warc")).collect()
    bundle = index[0].bundle
    files, path = file_system(bundle)
    with files.open_input_file(path) as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f.read(), read_across_frames=True).read()
    reader = warc.BundleReader(bundle)
    assert len(reader.frames) > 1
    assert b"".join(reader.frame(n) for n in range(len(reader.frames))) == whole
    for r in (r for r in index if r.bundle == bundle):
        headers, _, end = warc.parse_record(reader.frame(r.frame), r.offset)
        assert headers["X-Page-ID"] == ("" if r.id is None else str(r.id)) and end - r.offset == r.length


def test_pipeline_stages_keep_the_columns(llm, docs, odd_rows):
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs(*odd_rows), docs()):
            out = stage(llm, df, "")
            rows = out.collect()
            assert name == "token_ids" or out.columns == df.columns
            assert len(rows) <= 3 * len(odd_rows)


def test_pipeline_is_its_stages(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, sf_dir)
    once, again = corpus_pipeline.run(llm, sf_dir), corpus_pipeline.run(llm, sf_dir)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))
    assert once.count()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(llm, sf_dir, con, name):
    assert compare(QUERIES[name](llm, sf_dir), con, ORACLES[name]) is None


def test_queries_cover_their_tables(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op1_token_counts", "op2_toxicity", "op4_simhash", "op7_mixing", "op10_bpe"):
        assert QUERIES[name](llm, sf_dir).count() == docs
