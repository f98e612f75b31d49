"""Token counts and BPE against the tokenizers library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tslines.llm import bpe_codec, token_counts
from tslines.llm.bpe_automaton import Transducer, Vocabulary
from tslines.llm.common import tokenizer_path

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")

PARTS = [
    " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\u00a0", "\u2003", "\u0301", "e", "E", "ß", "Σ", "İ", "ſ", "the", "The", "'s", "'S", "'ll",
    "12", "½", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "中文", "!", "?!", "ﬁ", "\u200b", "aaaa", "zq", "#", "\x00", "\ufeff", "각",
    "\u058b", "\u088f", "\U000107bb", "—", "\u0378", "tion", "ing",
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rng = random.Random(5)
    odd = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    whole = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    return [*odd, *whole, "", " " * 90, "a" * 5000, "é" * 3000]


def test_counts_agree_with_the_library(texts):
    tool, library = token_counts.Counter(BYTES), Tokenizer.from_file(BYTES)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [tool.tokens(t) for t in texts] == want
    assert [tool.total(tool.chunked(t, 5 if len(t) < 200 else 300)) for t in texts] == want


def test_state_maps_compose_in_any_grouping():
    tool, rng = token_counts.Counter(BYTES), random.Random(7)
    for _ in range(300):
        parts = ["".join(rng.choice(PARTS[:20]) for _ in range(rng.randint(0, 4))) for _ in range(3)]
        a, b, c = map(tool.state_map, parts)
        left, right = tool.compose(tool.compose(a, b), c), tool.compose(a, tool.compose(b, c))
        assert tool.total(left) == tool.total(right) == tool.tokens("".join(parts))


def test_states_are_dropped_past_their_bound():
    small, large = Transducer(Vocabulary(BYTES), max_states=50), Transducer(Vocabulary(BYTES))
    for w in ("tokenization", "antidisestablishmentarianism", "zzzzqqqq", "hello") * 3:
        assert small.count(w.encode()) == large.count(w.encode())
    assert len(small.states) < 200


def test_count_tokens(docs, odd_rows):
    library = Tokenizer.from_file(BYTES)
    rows = token_counts.count_tokens(docs(*odd_rows), BYTES, chunk_chars=1000).collect()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts.count_tokens(docs(), BYTES).count() == 0


def test_count_parts_joins_texts_over_rows(llm, texts):
    library, rng, rows, want = Tokenizer.from_file(BYTES), random.Random(9), [], {}
    for i, text in enumerate(texts[:300]):
        cuts = sorted(rng.sample(range(len(text) + 1), min(3, len(text) + 1)))
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)], strict=True)):
            rows.append((i, n, text[a:b]))
        want[i] = len(library.encode(text, add_special_tokens=False).ids)
    rng.shuffle(rows)
    df = llm.createDataFrame(rows, "t int, part int, text string").repartition(4)
    assert {r.t: r.n_tokens for r in token_counts.count_parts(df, BYTES, "t", "part").collect()} == want


def test_bpe_agrees_with_the_library(texts):
    tool, library = bpe_codec.Encoder(WORDS), Tokenizer.from_file(WORDS)
    ids = tool.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.to_pylist() == want
    decoded = bpe_codec.spell(ids, bpe_codec.token_names(WORDS)).to_pylist()
    assert decoded == [library.decode(i, skip_special_tokens=False) for i in want]


def test_fragments_never_part_a_token():
    tool = bpe_codec.Encoder(WORDS)
    words = ["hello", "zqxj", "Ã©Ã©", "a", "qqzzxx", "helloqxhello", "jqjqjq"]
    sizes, ids = tool._encode_words(words)
    want = [e.ids for e in tool.last.encode_batch_fast(words, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]
    # some of these words do have certain cuts
    codes = [list(map(ord, w)) for w in words]
    assert any((~tool.joined[c[:-1], c[1:]]).any() for c in codes)


def test_known_keeps_what_comes_again():
    known = bpe_codec.Known(limit=4)
    for batch in (["a", "b", "c"], ["a", "b", "d", "e"], ["a", "f", "g"], ["h", "a"]):
        known.trim()
        new = known.missing(batch)
        known.add(new, np.array([len(x) + 1 for x in new], np.int64), np.array([ord(x[0]) for x in new for _ in range(len(x) + 1)], np.int32))
        known.numbers(batch)
        assert all(known.ids_of(x) == [ord(x)] * 2 for x in batch)
    assert "a" in known.number and "c" not in known.number

def test_encode_and_decode(docs, odd_rows):
    library = Tokenizer.from_file(WORDS)
    df = docs(*odd_rows)
    both = bpe_codec.encode(df, WORDS, ["doc_id", "key"], decoded=True)
    assert both.columns == ["doc_id", "key", "ids", "decoded"]
    apart = bpe_codec.decode(bpe_codec.encode(df, WORDS, ["doc_id"]), WORDS, ["doc_id", "ids"])
    want = sorted((str(i), e.ids, library.decode(e.ids, skip_special_tokens=False)) for i, t in odd_rows for e in [library.encode(t or "", add_special_tokens=False)])
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in both.collect()) == want
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in apart.collect()) == want
    assert bpe_codec.encode(docs(), WORDS, ["doc_id"]).count() == 0
