"""Exact and near copies against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import xxhash

import corpus_pipeline
from tslines.llm import exact_dedup, similar, simhash


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def least(i):
    return -(10**9) if i is None else i


def test_copies(docs, odd_rows):
    rows = [*odd_rows, *[(100 + i, "hot") for i in range(200)], *[(i, f"text {i % 30}") for i in range(400, 500)]]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for counters, least_rows in ((4, 3), (1 << 14, 64)):
        got = exact_dedup.copies(docs(*rows).repartition(5), counters=counters, least_rows=least_rows).collect()
        assert len(got) == len(rows)
        kept = collections.Counter(r.text_sha256 for r in got if r.kept)
        assert kept == collections.Counter({sha(t): 1 for t in groups})
        for r in got:
            members = next(g for t, g in groups.items() if sha(t) == r.text_sha256)
            assert (least(r.keep_id), r.group_size) == (max(map(least, members)), len(members))
            assert not r.kept or r.doc_id == r.keep_id
    assert exact_dedup.copies(docs()).count() == 0


def test_drop_copies_keeps_columns_and_one_row_each(docs, odd_rows):
    df = docs(*odd_rows, *[(9, "hot") for _ in range(100)]).repartition(3)
    for least_rows in (1, 1000):
        kept = exact_dedup.drop_copies(df, counters=8, least_rows=least_rows)
        assert kept.columns == df.columns
        assert sorted(map(str, ((r.doc_id, r.text or "") for r in kept.collect()))) == sorted(
            map(str, [(4, odd_rows[3][1]), (2, ""), (3, " \t\n"), (6, "same text here"), (None, "no id"), (7, odd_rows[8][1]), (9, "hot")])
        )
    assert exact_dedup.drop_copies(docs()).count() == 0


def test_counters_never_lose_a_frequent_digest():
    rng = random.Random(1)
    stream = [b"a"] * 300 + [b"b"] * 150 + [str(i).encode() for i in range(600)]
    rng.shuffle(stream)
    counts = pd.Series(dtype=np.int64)
    for at in range(0, len(stream), 50):
        counts = exact_dedup.merge_counters(counts, pd.Series(collections.Counter(stream[at : at + 50])), 10)
        assert len(counts) <= 10
    assert {b"a", b"b"} <= set(counts.index)
    assert counts[b"a"] > 300 - len(stream) // 10


def brute_print(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    """Root of every distinct fingerprint, by trying all pairs."""
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def near_rows(rng):
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 300)) for _ in range(400)) for _ in range(12)]
    rows = []
    for i in range(240):
        words = base[i % 12 if i < 160 else 0].split()
        words[rng.randrange(400)] = f"new{rng.randint(0, 50)}"
        rows.append((1000 - i, " ".join(words)))
    return rows


def test_near_copies(docs, odd_rows):
    rows = [*odd_rows, *near_rows(random.Random(2))]
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(set(prints))
    small = collections.defaultdict(list)
    for (i, _), p in zip(rows, prints, strict=True):
        small[root[p]].append(i)
    want = sorted((str(i), f"{p:016x}", min((m for m in small[root[p]] if m is not None), default=None)) for (i, _), p in zip(rows, prints, strict=True))
    for tile in (1 << 12, 8):
        got = simhash.near_copies(docs(*rows).repartition(4), tile=tile).collect()
        assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_copies(docs()).count() == 0


def test_drop_near_copies_keeps_one_of_each(docs, odd_rows):
    rows = [*odd_rows, *near_rows(random.Random(3))]
    df = docs(*rows)
    kept = simhash.drop_near_copies(df)
    root = brute_components({brute_print(t) for _, t in rows})
    assert kept.columns == df.columns
    got = [(r.doc_id, root[brute_print(r.text)]) for r in kept.collect()]
    assert sorted(c for _, c in got) == sorted(set(root.values()))
    for i, component in got:
        members = [j for j, t in rows if root[brute_print(t)] == component]
        assert i == min((m for m in members if m is not None), default=None)
    assert simhash.drop_near_copies(docs()).count() == 0


def test_masks_share_a_key_for_every_close_pair():
    rng = random.Random(4)
    for count in (10, 10**8, 10**11):
        masks = simhash.block_masks(count)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 3):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_components_of_long_chains(llm):
    order = list(range(300))
    random.Random(6).shuffle(order)
    edges = list(zip(order, order[1:], strict=False)) + [(1000, 1001), (1001, 1002)]
    got = {r.node: r.root for r in simhash.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(order, 0), 1000: 1000, 1001: 1000, 1002: 1000}
    assert simhash.components(llm.createDataFrame([], "a long, b long")).count() == 0


def brute_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_similar(sets):
    """Root of every text over pairs of similarity 0.8 or more, and the number of these pairs."""
    root, pairs = list(range(len(sets))), 0

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                pairs += 1
                root[find(i)] = find(j)
    return [find(p) for p in range(len(sets))], pairs


def similar_rows(rng):
    """Texts with some of their words changed, so that pairs lie on both sides of 0.8."""
    rows = []
    for i in range(300):
        if i % 3 == 0 or i > 240:
            base = rows[0][1].split() if i > 240 else [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 300)) for _ in range(rng.choice([12, 60, 250]))]
        words = list(base)
        for _ in range(rng.randint(0, max(1, len(words) // 25))):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 50)}"
        rows.append((1000 - i, " ".join(words)))
    return rows


def test_the_near_copy_stage_finds_all_similar_pairs(llm, docs, odd_rows):
    rows = [*odd_rows, *similar_rows(random.Random(8))]
    sets = [brute_shingles(t) for _, t in rows]
    root, pairs = brute_similar(sets)
    assert pairs > 300
    ids = collections.defaultdict(list)
    for (i, _), r in zip(rows, root, strict=True):
        ids[r].append(i)
    want = sorted(str(min((i for i in g if i is not None), default=None)) for g in ids.values())
    df = docs(*rows).repartition(4)
    kept = corpus_pipeline.near_duplicates(llm, df, "")
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert sorted(str(r.doc_id) for r in similar.drop_similar(df, tile=300).collect()) == want
    assert similar.drop_similar(docs()).count() == 0


def test_spanning_links_of_sets_reach_what_pairs_reach():
    rows = similar_rows(random.Random(10))
    sets = [similar.shingle_set(t) for _, t in rows]
    want, _ = brute_similar([set(s.tolist()) for s in sets])
    links = similar.spanning_links(list(range(len(sets))), sets)
    assert len(links) == len(sets) - len(set(want))
    assert all(want[a] == want[b] for a, b in links)


def test_seeded_prints_are_simhashes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 4, 2500):
        hashes = rng.integers(0, 1 << 63, n, np.uint64)
        for seed, got in enumerate(simhash.seeded_prints(hashes, 3).view(np.uint8).reshape(3, 8), 1):
            mixed = []
            for h in hashes.tolist():
                h = (h + seed * 0x9E3779B97F4A7C15) % 2**64
                h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
                h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
                mixed.append((h ^ h >> 31).to_bytes(8, "little"))
            bits = [sum(h[b // 8] >> (7 - b % 8) & 1 for h in mixed) for b in range(64)]
            assert np.unpackbits(got).tolist() == [int(2 * c > n) for c in bits]


def test_similar_texts_are_candidates_by_simhash(llm):
    """Pairs of similarity just above 0.8 share a block and are close, other texts are not."""
    rng = np.random.default_rng(5)
    sets = []
    for n in (9, 45, 90, 450) * 25:
        both, one, other = np.split(rng.integers(0, 1 << 63, n // 9 * 10, np.uint64), [n // 9 * 8, n])
        sets += [np.concatenate([both, one]), np.concatenate([both, other])]
    rows = [(i, len(s), simhash.seeded_prints(s, similar.PRINTS).view(np.int64).tolist()) for i, s in enumerate(sets)]
    df = llm.createDataFrame(rows, "fp long, size long, prints array<long>")
    for members in (1 << 12, 2):
        links = {tuple(sorted(r)) for r in similar.candidates(df, members).collect()}
        assert links == {(i, i + 1) for i in range(0, len(sets), 2)}


def family(rng, n, changed=1):
    """Rows of `prints` for n near copies of one text, with seeded SimHashes near each other."""
    base = rng.integers(0, 1 << 63, 200, np.uint64)
    rows = []
    for i in range(n):
        own = base.copy()
        own[rng.integers(0, 200, changed)] = rng.integers(0, 1 << 63, changed, np.uint64)
        rows.append((int(rng.integers(0, 1 << 62)), len(own), simhash.seeded_prints(own, similar.PRINTS).view(np.int64).tolist()))
    return rows


def test_links_of_a_large_family_are_few(llm):
    """A block of a family of near copies must not add links of its own for each text."""
    rows = family(np.random.default_rng(7), 400, changed=8)
    df = llm.createDataFrame(rows, "fp long, size long, prints array<long>").repartition(4)
    for members in (1 << 12, 64):
        found = similar.candidates(df, members).collect()
        assert len(found) <= 2 * len(rows)
        roots = simhash.components(llm.createDataFrame(found, "a long, b long")).collect()
        assert {(r.node, r.root) for r in roots} == {(fp, min(r[0] for r in rows)) for fp, _, _ in rows}


def test_links_of_large_simhash_groups_are_few(llm):
    """Fingerprints within a few bits share most of their keys."""
    rng = random.Random(12)
    base = rng.getrandbits(64)
    prints = {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(600)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = llm.createDataFrame([(p,) for p in signed], "fp long").repartition(4)
    for tile in (1 << 12, 200):
        found = simhash.links(df, len(signed), tile=tile).collect()
        assert len(found) <= 2 * len(signed)
        roots = simhash.components(llm.createDataFrame(found, "a long, b long")).collect()
        assert {(r.node, r.root) for r in roots} == {(p, min(signed)) for p in signed}


def test_hung_keeps_the_closure(llm):
    rng = random.Random(13)
    edges = [tuple(rng.sample(range(i * 20, i * 20 + 20), 2)) for i in range(10) for _ in range(25)]
    df = llm.createDataFrame(edges, "a long, b long")
    want = {(r.node, r.root) for r in simhash.components(df).collect()}
    assert {(r.node, r.root) for r in simhash.components(simhash.hung(df)).collect()} == want


def test_only_members_apart_meet_again(llm):
    """A joined group gives no tiles, a few others give about a row per member, and any two of
    different roots meet."""
    schema = "key long, fp long, weight long"
    many = [(1, i, 1) for i in range(1000)] + [(2, i, 1) for i in range(500, 560)] + [(3, 5, 0), (3, 2000, 0)]
    roots = llm.createDataFrame([(i, 0) for i in range(997)], "node long, root long")
    rest = simhash.apart(llm.createDataFrame(many, schema), roots, 10).collect()
    assert {r.key for r in rest} == {1, 3}
    assert sum(r.key == 1 for r in rest) <= 1000 + 3 * 101
    at = collections.defaultdict(lambda: collections.defaultdict(set))
    for r in rest:
        assert r.root == (0 if r.fp < 997 else r.fp)
        at[r.key][r.fp].add(r.tile)
    for key, fps in at.items():
        for a in (k for k in fps if k >= 997):
            assert all(fps[a] & fps[b] for b in fps), key
    # all apart: every pair meets
    rest = simhash.apart(llm.createDataFrame([(1, i, 1) for i in range(60)], schema), roots.where("node < 0"), 10).collect()
    tiles = collections.defaultdict(set)
    for r in rest:
        tiles[r.fp].add(r.tile)
    assert len(tiles) == 60 and all(tiles[a] & tiles[b] for a in tiles for b in tiles)


def test_parted_groups_of_similar_texts_join_as_whole_ones(llm, docs):
    rows = similar_rows(random.Random(14))
    sets = [brute_shingles(t) for _, t in rows]
    root, _ = brute_similar(sets)
    want = sorted(max(-i for (i, _), r in zip(rows, root, strict=True) if r == c) for c in set(root))
    for tile in (700, 5000):
        assert sorted(-r.doc_id for r in similar.drop_similar(docs(*rows), tile=tile).collect()) == want
