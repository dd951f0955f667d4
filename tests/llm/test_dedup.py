import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestack.llm import exact_dedup, near_copies, simhash


def groups(rows):
    out = defaultdict(list)
    for d, t, *_ in rows:
        out[t or ""].append(d)
    return out


def check_exact(rows, got):
    want = groups(rows)
    by_text = {sha256(t.encode()).hexdigest(): t for t in want}
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    kept = Counter()
    for r in got:
        ids = want[by_text[r["text_sha256"]]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        assert r["doc_id"] in ids
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}


def test_exact_dedup(spark, odd, odd_rows, empty):
    check_exact(odd_rows, exact_dedup.dedup(spark, odd).collect())
    assert exact_dedup.dedup(spark, empty).count() == 0


def test_large_group_is_kept_whole(spark):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_exact(rows, exact_dedup.dedup(spark, df).collect())


def test_equal_digests_of_unequal_texts_are_told_apart(spark):
    rows = [(i, f"{'ab'[i % 2]}{i % 3}") for i in range(40)] + [(100, "c"), (101, "d"), (102, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda c: F.lit("ab")
    got = {r["doc_id"]: r for r in exact_dedup.dedup(spark, df, digest=weak).collect()}
    for d, t in rows:
        ids = [x for x, y in rows if y == t]
        assert (got[d]["keep_id"], got[d]["group_size"], got[d]["kept"]) == (max(ids), len(ids), d == max(ids))


def test_state_absorbs_only_new_files(spark, tmp_path):
    base = f"file://{tmp_path}"
    rows = lambda ids: spark.createDataFrame([(i, bytes([i % 3]), "f", i) for i in ids], "doc_id long, digest binary, file string, row long")
    rows(range(10)).write.parquet(f"{base}/landing")
    exact_dedup.absorb(spark, f"{base}/landing", f"{base}/state")
    rows(range(10, 20)).write.mode("append").parquet(f"{base}/landing")
    exact_dedup.absorb(spark, f"{base}/landing", f"{base}/state")
    got = {bytes(r["digest"])[0]: (r["keep_id"], r["keep_row"], r["n"]) for r in exact_dedup.state_rows(spark, f"{base}/state").collect()}
    assert got == {0: (18, 18, 7), 1: (19, 19, 7), 2: (17, 17, 6)}


def slow_fingerprint(text):
    import re

    import xxhash

    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def slow_components(ids, prints):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(len(ids)):
        least[find(i)].append(ids[i])
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("text", ["", None, "one", "a b c", "A b  C\td", "é Ü ß \x0b x\x0cy z", "w " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def near_rows():
    r = random.Random(4)
    rows = []
    for g in range(12):
        words = [f"w{r.randrange(900)}" for _ in range(60 + 20 * g)]
        for k in range(6):
            w = list(words)
            for _ in range(k // 2):
                w[r.randrange(len(w))] = "changed"
            rows.append((1000 - len(rows), " ".join(w)))
    rows += [(2000 + i, f"alone {r.random()} {r.random()} {r.random()} {r.random()}") for i in range(40)]
    return rows + [(3000, None), (3001, ""), (3002, " \n")]


def test_near_duplicates(spark):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark, df).collect()}
    prints = [slow_fingerprint(t) for _, t in rows]
    for (d, _), p, c in zip(rows, prints, slow_components([d for d, _ in rows], prints)):
        assert (got[d]["fingerprint"], got[d]["component_id"]) == (f"{p:016x}", c)
        assert got[d]["stays"] == (d == c)


def test_near_duplicates_of_odd_rows(spark, odd, odd_rows, empty):
    got = simhash.near_duplicates(spark, odd).collect()
    prints = [slow_fingerprint(r[1]) for r in odd_rows]
    want = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(odd_rows, prints, slow_components([r[0] for r in odd_rows], prints)))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    stays = Counter()
    for r in got:
        stays[r["component_id"]] += r["stays"]
    assert set(stays.values()) == {1}
    assert simhash.near_duplicates(spark, empty).count() == 0


@pytest.mark.parametrize("count", [10, 10**6, 10**9, 10**12])
def test_choices_of_blocks_lose_no_pair(count):
    blocks, choices = simhash.block_choices(4, count)
    bounds = simhash.block_bounds(blocks)
    r = random.Random(count)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), 4):
            y ^= 1 << b
        assert any(all((x >> lo) & ((1 << hi - lo) - 1) == (y >> lo) & ((1 << hi - lo) - 1) for lo, hi in (bounds[k] for k in c)) for c in choices)


def test_large_buckets_are_split_without_loss(monkeypatch):
    r = np.random.default_rng(0)
    base = r.integers(0, 1 << 63, 30, dtype=np.uint64)
    values = []
    for b in base:
        v = int(b)
        for _ in range(20):
            v ^= 1 << int(r.integers(0, 64))
            values.append(v)
    values = np.array(sorted(set(values)), np.uint64)

    def parts(edges):
        p = list(range(len(values)))

        def find(x):
            while p[x] != x:
                x = p[x]
            return x

        for a, b in edges:
            assert bin(int(values[a] ^ values[b])).count("1") <= 4
            p[find(a)] = find(b)
        return [find(i) for i in range(len(values))]

    whole = parts(simhash.spanning(values, 4))
    monkeypatch.setattr(simhash, "DIRECT", 16)
    split = parts(simhash.spanning(values, 4))
    assert len(set(zip(whole, split))) == len(set(whole)) == len(set(split))


@pytest.mark.parametrize("local", [simhash.LOCAL, 0])
def test_components_of_chains(spark, monkeypatch, local):
    monkeypatch.setattr(simhash, "LOCAL", local)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1002), (-5, -4)]
    random.Random(1).shuffle(edges)
    got = {r["v"]: r["label"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000, 1002: 1000, -5: -5, -4: -5}


def slow_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def slow_alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b) > 0


def slow_copies(rows):
    """Component (least doc_id, null last) of each row by comparing all pairs."""
    sets, part = [slow_shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if part[i] != part[j] and slow_alike(sets[i], sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    return [min((r[0] for r, p in zip(rows, part) if p == q and r[0] is not None), default=None) for q in part]


def edited_rows():
    """Copies with edits around the limit, chains of them, a passage that many share, short and empty texts."""
    r = random.Random(9)
    word = lambda: f"w{r.randrange(3000)}"
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(30):
        words = [word() for _ in range(20 + 8 * g)]
        for k in range(5):
            rows.append((5000 - len(rows), " ".join(words)))
            for _ in range(r.randrange(1 + g // 4)):
                words[r.randrange(len(words))] = word()
            if k == 2:
                words = words[r.randrange(1 + g // 2) :] + [word()]
    rows += [(6000 + i, passage + " " + " ".join(word() for _ in range(i))) for i in range(40)]
    return rows + [(7000, None), (7001, ""), (7002, "a B"), (7003, "A  b"), (7004, "a b c")]


@pytest.mark.parametrize("bins, block, direct, many", [(near_copies.BINS, near_copies.BLOCK, near_copies.DIRECT, 0), (1, 16, 8, 60), (4096, 4, 0, 60)])
def test_near_copies_against_all_pairs(spark, monkeypatch, bins, block, direct, many):
    """Also with components that must be split into blocks, many sets outside their largest part, keys that are chained, and graphs of many edges."""
    monkeypatch.setattr(simhash, "LOCAL", simhash.LOCAL if bins > 1 else 0)
    monkeypatch.setattr(near_copies, "BINS", bins)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "DIRECT", direct)
    rows = edited_rows()
    base = [f"v{i}" for i in range(60)]
    for i in range(many):  # copies of one text with one or two words changed
        words = list(base)
        words[i] = "x"
        words[(7 * i) % 60] = f"y{i % 3}"
        rows.append((8000 + i, " ".join(words)))
    got = {r["doc_id"]: r for r in near_copies.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = dict(zip([r[0] for r in rows], slow_copies(rows)))
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert {d for d, r in got.items() if r["stays"]} == set(want.values())


def test_candidates_connect_all_that_may_be_alike(spark, monkeypatch):
    """Keys over several tasks and batches: sets that share a key, with fitting sizes and fingerprints, come out connected."""
    monkeypatch.setattr(near_copies, "DIRECT", 20)
    monkeypatch.setattr(near_copies, "LONG", 30)
    r = np.random.default_rng(4)
    values = [np.unique(r.integers(0, 1 << 63, int(n), dtype=np.uint64)) for n in r.integers(5, 60, 60)]
    values += [np.sort(np.concatenate([v[:-1], r.integers(0, 1 << 63, 1, dtype=np.uint64)])) for v in values for _ in range(8)]
    rows = [(i, len(v), bytearray(near_copies.parities(v)), [int(k) for k in r.choice(6, 2, False, [0.6, 0.3, 0.04, 0.03, 0.02, 0.01])]) for i, v in enumerate(values)]
    places = {r[0]: {k: i for i, k in enumerate(r[3])} for r in rows}
    prints = spark.createDataFrame(rows, "fp long, size int, sketch binary, keys array<long>")
    with_settings = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        edges = [(e["a"], e["b"]) for e in near_copies.candidates(spark, prints, prints).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_settings)
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        assert set(rows[a][3]) & set(rows[b][3]) and a != b
        part[root(a)] = root(b)
    links = 0
    for a in range(len(rows)):
        for b in range(a):
            both = len(values[a]) + len(values[b])
            shared = [k for k in rows[a][3] if k in rows[b][3] and 9 * min(len(values[a]) - places[a][k], len(values[b]) - places[b][k]) >= 4 * both]
            if shared and 9 * len(np.setxor1d(values[a], values[b])) <= both:
                assert root(a) == root(b)
                links += 1
    assert links > 100


def test_stage_drops_copies_that_short_fingerprints_miss(spark, tmp_path):
    import corpus_pipeline

    rows = edited_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_deduplication(spark, docs, str(tmp_path)).collect()}
    assert kept == set(slow_copies(rows))


def test_simhash_links_are_candidates_and_are_compared(spark, monkeypatch, tmp_path):
    """SimHash is a step of the stage: without other candidates its links, and no others, are found, and those that are less alike go."""
    import corpus_pipeline

    rows = edited_rows()
    sets, fps = [slow_shingles(r[1]) for r in rows], [near_copies.shingles(r[1]) for r in rows]
    sims = [simhash.majority([x], len(x)) for x in fps]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (sims[i] ^ sims[j]).bit_count() <= near_copies.DISTANCE]
    part = list(range(len(rows)))
    for i, j in pairs:
        part = [part[j] if p == part[i] else p for p in part]
    prints = spark.createDataFrame([(i, s - (s >> 63 << 64)) for i, s in enumerate(sims)], "fp long, sim long")
    near = {r["fp"]: r["near"] for r in near_copies.by_simhash(spark, prints).collect()}
    assert near == {i: min(k for k, q in enumerate(part) if q == p) for i, p in enumerate(part)}
    assert any(not slow_alike(sets[i], sets[j]) for i, j in pairs) and any(slow_alike(sets[i], sets[j]) and sets[i] != sets[j] for i, j in pairs)
    monkeypatch.setattr(near_copies, "candidates", lambda spark, prints, classes: spark.createDataFrame([], "a long, b long"))
    want = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if part[i] == part[j] and slow_alike(sets[i], sets[j]):
                want = [want[j] if p == want[i] else p for p in want]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_deduplication(spark, docs, str(tmp_path)).collect()}
    assert kept == {min(r[0] for r, p in zip(rows, want) if p == q) for q in want}
    assert len(kept) < len(rows)


def test_near_copies_of_odd_rows(spark, odd, odd_rows, empty):
    got = Counter((r["doc_id"], r["component_id"]) for r in near_copies.near_copies(spark, odd).collect())
    assert got == Counter((r[0], c) for r, c in zip(odd_rows, slow_copies(odd_rows)))
    assert near_copies.near_copies(spark, empty).count() == 0
