"""URL rules, quality rules, mixing, toxicity."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tslines.llm import mixing, quality, toxicity, url_filter
from tslines.llm.queries import URL_RULES


def as_regex(glob):
    out = re.sub(r"\\\*\\\*|\\\*|\\\?", lambda m: {r"\*\*": ".*", r"\*": "[^/]*", r"\?": "[^/]"}[m[0]], re.escape(glob))
    return re.compile(out, re.S)


def test_patterns_agree_with_regular_expressions():
    rng = random.Random(1)
    globs = ["a*b", "*.a/**", "", "**", "*", "?b*", "ab" * 40 + "*c", "a**b*c", "x/y", "/**", "é?"]
    texts = ["".join(rng.choice("ab./cx\né") for _ in range(rng.randint(0, 10))) for _ in range(2000)] + ["ab" * 40 + "zzc", "ab" * 5000]
    flags = url_filter.Patterns(globs).match(texts)
    assert [[bool(as_regex(g).fullmatch(t)) for g in globs] for t in texts] == flags.tolist()


def test_judge_urls(llm):
    urls = [
        None, "", "no scheme", "http://A.COM", "http://a.com/", "http://x.example.com/en/1?q", "https://www.Example.com/en/", "http://net/es/", "http://notnet/fr/",
        "http://b.net/fr/#x", "http://b.net/frx/", "http://evil.org/x.example.com/en/", "a://b.net://c/es/", "http://é.net/es/\n" + "y" * 100_000, "http://b.net?/es/",
    ]
    df = llm.createDataFrame([(i % 9, u, "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    want = []
    for i, u in enumerate(urls):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        want.append((i % 9, host, path, best and best.name, best.verdict if best else "allow"))
    got = url_filter.judge_urls(df, URL_RULES)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert {r.verdict for r in url_filter.judge_urls(df, []).collect()} == {"allow"}
    assert url_filter.judge_urls(df.limit(0), URL_RULES).count() == 0


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, marked = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            marked |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


def test_quality(docs, odd_rows):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["a b\nc\n\n a b\na b\r\na b\n" * 4, "x # | $ " * 9, " ".join(f"word{i}" for i in range(40)), "😀 é " * 30, "w\x0bx\x1cy"]
    rows = [*odd_rows, *enumerate(texts, 50)]
    got = {}
    for r in quality.quality(docs(*rows)).collect():
        got.setdefault(str(r.doc_id), []).append(r)
    for i, text in rows:
        r, want = got[str(i)][0], brute_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    assert sum(map(len, got.values())) == len(rows)
    kept = quality.passing(docs(*rows))
    assert kept.columns == docs().columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for rs in got.values() for r in rs if r.kept)
    assert quality.passing(docs()).count() == quality.quality(docs()).count() == 0


def test_quality_keeps_labelled_good_documents(llm, sf_dir):
    docs, labels = llm.read.parquet(f"{sf_dir}/documents.parquet"), llm.read.parquet(f"{sf_dir}/labels.parquet")
    good = quality.quality(docs).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert good.count() and good.where("not kept").count() == 0


def test_rules_are_ordered_by_rejection_per_cost():
    rules = [quality.Rule(n, None) for n in "abc"]
    # a rejects most but is dear; b is cheap; after b nothing is left for c
    chain = quality.ordered(tuple(rules), {"a": 10.0, "b": 1.0, "c": 1.0}, {("a", "b"): 5, ("a",): 30, ("b", "c"): 9})
    assert [r.name for r in chain] == ["b", "a", "c"]


def test_the_cascade_splits_words_once(docs):
    df = docs(*[(i, f"some words of text {i} " * 9) for i in range(40)])
    plan = quality.passing(df)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bsplit\(\w*trim\(", plan)) == 1


def test_costs_are_those_of_the_rules(llm):
    # both reject the same rows; one hashes every word many times over
    dear = quality.Rule("dear", lambda c: F.expr("aggregate(transform(words, w -> length(sha2(repeat(w, 40), 512))), 0, (a, b) -> a + b)") % 2 == 0)
    cheap = quality.Rule("cheap", lambda c: F.size("words") > 0)
    sample = llm.range(300).select(F.lit("text").alias("text"), F.array_repeat(F.col("id").cast("string"), 200).alias("words"))
    for rules in ((dear, cheap), (cheap, dear)):
        cost, sets = quality.estimate(sample, rules)
        assert cost["dear"] > 3 * cost["cheap"] and sum(sets.values()) == 300
        assert [r.name for r in quality.ordered(rules, cost, sets)] == ["cheap", "dear"]


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = left / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * share > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else weight[s] * share for s in names}
        full |= over


def test_mix(docs):
    rng = random.Random(3)
    sources = ["a", "b", "é", None, "", "z"]
    odds = [400, 30, 500, 20, 60, 3]
    rows = [(i, " ".join("w" * rng.choice([1, 5, 40, 300])) , s) for s, n in zip(sources, odds, strict=True) for i in range(n)]
    rows += [(1, None, "a"), (2, "", "only empty"), (3, "w " * 5000, "é"), (None, "w w w", "a"), (5, "w w", "b"), (5, "w w", "b")]
    df = docs(*rows).repartition(3)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 3 and r.rate <= 3
    targets = brute_targets(sizes)
    biggest = {s: max(r.size for r in got if r.source == s) for s in sizes}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(biggest[s], 0.01 * target), s
    # rates keep the constraint before rounding
    for s, target in targets.items():
        assert sum(r.rate * r.size for r in got if r.source == s) == pytest.approx(target, abs=1)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    whole = mixing.repeat_rows(df)
    assert whole.columns == df.columns
    assert whole.count() == sum(r.copies for r in got)
    assert mixing.mix(docs()).count() == mixing.repeat_rows(docs()).count() == 0


def brute_segments(scores):
    """All maximal segments by their definition, recursively around the best one."""

    def best(a, b):
        found = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                # of equally good ones the shortest is meant
                if total > 1e-12 and (found is None or total > found[0] + 1e-9 or abs(total - found[0]) <= 1e-9 and j - i < found[2] - found[1] - 1):
                    found = (total, i, j + 1)
        return found

    def walk(a, b):
        found = best(a, b)
        return [] if found is None else walk(a, found[1]) + [found[1:]] + walk(found[2], b)

    return walk(0, len(scores))


def test_segments_are_all_maximal_ones():
    rng = random.Random(4)
    for _ in range(400):
        scores = np.array([rng.choice([-2.03, -1.01, -0.507, 0.0, 0.311, 1.13, 2.71]) + rng.random() / 100 for _ in range(rng.randint(0, 14))])
        assert [(a, b) for a, b, _ in toxicity.segments(scores)] == brute_segments(scores)


def test_toxicity_on_held_out_documents(llm, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = llm.read.parquet(f"{folder}/documents.parquet"), llm.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels, F.col("id") % 3 != 1)
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 1").collect()
    right = [(r.score >= 0.7) == bool(r.toxic) for r in rows]
    assert np.mean(right) > 0.95
    assert np.mean([r.score >= 0.7 for r in rows if not r.toxic]) < 0.02
    assert toxicity.score(docs, model).where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_of_odd_rows(docs, odd_rows, llm):
    labels = llm.createDataFrame([(1, 0), (2, 1), (5, 1), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    df = docs(*odd_rows)
    model = toxicity.fit(df, labels, F.lit(True))
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.fit(docs(), labels.limit(0), F.lit(True))
    assert len({r.score for r in toxicity.score(df, none).collect()}) == 1
    assert toxicity.score(docs(), model).count() == 0


def test_toxic_words_share_no_counts_with_others(docs, llm):
    # these two have the same checksum in its last 18 bits
    seen = {}
    for i in range(10**6):
        word = f"{'abcdefghij'[i % 10]}word{i}"
        bad = seen.setdefault(zlib.crc32(f"0:{word}".encode()) % (1 << 18), word)
        if bad[0] != word[0]:
            break
    rows = [(i, " ".join([(bad if i % 2 else word)] * 40)) for i in range(60)]
    labels = llm.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs(*rows), labels, F.lit(True))
    assert model.score(bad) > 0 > model.score(word)


def test_toxicity_counts_every_word_exactly(llm):
    texts = [(f"w{i} w{i % 7} both", i % 2) for i in range(500)]
    rows = llm.createDataFrame(texts, "text string, label int").repartition(3)
    known, toxic, every, n_toxic, n_all = toxicity.count_keys(rows)
    want = collections.defaultdict(lambda: [0, 0])
    for text, label in texts:
        for word in text.split():
            for key in toxicity.keys(word):
                want[key][0] += label
                want[key][1] += 1
    assert {k: [t, e] for k, t, e in zip(known.tolist(), toxic.tolist(), every.tolist(), strict=True)} == want
    assert (n_toxic, n_all) == (750, 1500) and known.tolist() == sorted(want)
    assert toxicity.count_keys(rows, most=len(known)) is not None and toxicity.count_keys(rows, most=len(known) - 1) is None


def brute_score(model, text):
    """Score and passages by the definition, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    at = {k: (float(t), float(e)) for k, t, e in zip(model.keys.tolist(), model.toxic.tolist(), model.all.tolist(), strict=True)}
    odds = []
    for word in words:
        share = model.share
        for key in reversed(toxicity.keys(word)):
            if key in at:
                share = (at[key][0] + toxicity.CONCENTRATION * share) / (at[key][1] + toxicity.CONCENTRATION)
        odds.append(math.log(share / (1 - share)) - math.log(model.share / (1 - model.share)) - toxicity.DRIFT)
    spans = [(a, b, sum(odds[a:b])) for a, b in brute_segments(odds)]
    surprise = [(a, b, model.decay * s - math.log(model.rate * len(words))) for a, b, s in spans]
    good = [(a, b, e) for a, b, e in surprise if e >= -math.log(toxicity.E_VALUE)]
    x = model.offset + model.slope * math.log1p(sum(e for _, _, e in good))
    return 1 / (1 + math.exp(-x)), [(a, b) for a, b, _ in good]


def test_toxicity_agrees_with_brute_force(docs, llm):
    rng = random.Random(8)
    clean, bad = [f"calm{c}" for c in "abcdefghij"], [f"vile{c}" for c in "abcdef"]
    rows = []
    for i in range(240):
        words = [rng.choice(clean) for _ in range(rng.randint(0, 14))]
        if i % 3 == 0:
            words[2:2] = [rng.choice(bad) for _ in range(rng.randint(4, 8))]
        words += [rng.choice(bad)] * (rng.random() < 0.1)
        rows.append((i, " ".join(words)))
    labels = llm.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    df = docs(*rows)
    model = toxicity.fit(df, labels, F.col("id") % 4 != 1)
    # the law: the mean exponential score of a clean token is one at the decay
    held = toxicity.fitting_rows(df, labels, F.col("id") % 4 != 1, "doc_id", "text", "toxic", 10**6).where("part = 1").collect()
    scores = [np.round(model.scores(r.text.split()) * 20) / 20 for r in held if r.label == 0 and r.text]
    mean = np.exp(model.decay * np.concatenate(scores)).mean()
    assert mean == pytest.approx(1, abs=1e-6) or model.decay in (0.05, 1.0)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    for i, text in rows:
        want, spans = brute_score(model, text)
        assert got[i].score == pytest.approx(want, abs=1e-9)
        assert [(p["first"], p["end"]) for p in got[i].passages] == spans
    assert any(r.passages for r in got.values())


def test_toxicity_fits_on_fewer_documents_rather_than_fewer_words(docs, llm):
    rows = [(i, " ".join(f"{'vile' if i % 2 else 'calm'}{i}x{j}" for j in range(20))) for i in range(16)]
    labels = llm.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs(*rows), labels, F.lit(True), most=16, most_keys=150)
    assert 0 < len(model.keys) <= 150
    assert len(toxicity.fit(docs(*rows), labels, F.lit(True), most=16, most_keys=1).keys) == 0


def test_scorer_forgets_without_changing_scores(docs, llm):
    model = toxicity.Model(0.1, np.array(sorted(toxicity.keys("bad")), np.int64), np.full(3, 5, np.float32), np.full(3, 6, np.float32), 1.0, 1.0, 1.0, 0.0)
    texts = [f"bad w{i} w{i + 1} BAD." for i in range(50)]
    small, large = toxicity.Scorer(model, 7), toxicity.Scorer(model)
    for i in range(0, 50, 3):
        for a, b in zip(small(texts[i : i + 3]), large(texts[i : i + 3]), strict=True):
            assert a.tolist() == b.tolist()


def test_mix_draws_a_fine_line(docs):
    rows = [(i, "w", "ab"[i % 2]) for i in range(40_000)]
    got = mixing.mix(docs(*rows, extra=False)).where("source = 'b'").agg(F.sum("copies").alias("n"), F.max("target").alias("target")).first()
    assert abs(got.n - got.target) <= 2
