"""Source divergence against a plain count of every term."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tslines.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, word int, bits long, n int, rank int, total string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def table(llm, rows):
    return llm.createDataFrame([(i, t, g, s, 1, 2, 3, 4, "own") for i, (t, g, s) in enumerate(rows)], SCHEMA)


def brute(rows, least, ranks=50):
    groups, docs, n_lang = {}, {}, {}
    for text, lang, source in rows:
        lang, terms = lang or "", TERM.findall(lower(text or ""))
        groups.setdefault(lang, {}).setdefault(source or "", Counter()).update(terms)
        docs.setdefault(lang, Counter()).update(set(terms))
        n_lang.setdefault(lang, Counter()).update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= least]

        def rates(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        q, p = rates(n_lang[lang]), {s: rates(c) for s, c in sources.items()}
        for s, counts in sources.items():
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if counts[t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return Counter(out)


def corpus(seed=2, docs=400):
    dice = random.Random(seed)
    common = [f"w{a}{b}" for a in "abcdefghijklm" for b in "abcdefghijkl"] + ["Été", "中文", "ß x", "ZÄH"]
    rows = []
    for _ in range(docs):
        source = dice.choice(["s1", "s1", "s1", "s2", "s3", "S3", None, ""])
        shift = len(source or "") + ord((source or "s")[0]) % 5
        words = [common[int(dice.paretovariate(0.7) + shift) % len(common)] for _ in range(dice.randint(0, 60))]
        rows.append((" ,1_\n".join(words), dice.choice(["en", "de", None]), source))
    rows += [(None, "en", "mute"), ("", "en", "mute2"), ("only rare things", "xx", "alone"), ("zzz " * 50_000, "en", "long"), (None, "yy", "a"), (None, "yy", "b")]
    return rows + rows[:20]


@pytest.mark.parametrize("sizes", [(4096, 256, 200_000), (64, 2, 40)])
def test_divergence_agrees_with_plain_counts(llm, sizes):
    bucket, block, held = sizes
    rows = corpus()
    got = divergence.divergence(table(llm, rows), least_docs=5, bucket=bucket, block=block, held=held)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = brute(rows, 5)
    assert Counter(map(tuple, got.collect())) == want
    assert {p for _, _, p, *_ in want} == {"pair", "term"}


def test_more_than_fifty_terms_and_ties(llm):
    rows = [(" ".join(f"a{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)), "en", "s")] * 3 + [("other words here", "en", "t")] * 9
    assert Counter(map(tuple, divergence.divergence(table(llm, rows), least_docs=3).collect())) == brute(rows, 3)


def test_divergence_of_nothing(llm):
    assert divergence.divergence(table(llm, [])).collect() == []
    assert divergence.divergence(table(llm, [("one", "en", "a")])).collect() == []


def test_terms_are_those_of_the_pattern():
    dice = random.Random(4)
    for _ in range(300):
        text = "".join(dice.choice("aZ@[`{~ \n\0é中 \x85😀9") for _ in range(30))
        assert [t.decode() for t in divergence.terms_of(text.encode())] == TERM.findall(lower(text))


def test_joint_cells_of_one_word():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 4, (5, 64))
    zero, rate = rng.integers(1, 50, 5), rng.integers(1, 100, (5, 4))
    rate[:, 0] = zero
    entries = [(s, rate[s, c], zero[s], sum(1 << b for b in range(64) if counts[s, b] == c)) for s in range(5) for c in range(1, 4)]
    sid, p, z, bits = (np.array(c, dtype=t) for c, t in zip(zip(*entries, strict=True), (np.int64, np.int64, np.int64, np.uint64), strict=True))
    total = np.zeros((256, 256), np.int64)
    divergence._add_word(total, 0, 0, sid, p, z, bits.view(np.int64))
    for a in range(5):
        for b in range(5):
            terms = [(rate[a, x], rate[b, y]) for x, y in zip(counts[a], counts[b], strict=True) if x and y]
            want = sum(abs(x - y) - abs(x - zero[b]) - abs(zero[a] - y) + abs(zero[a] - zero[b]) for x, y in terms)
            assert total[a, b] == want
