import random
from collections import Counter

import numpy as np
import pytest

from lodestack.llm import quality, queries, sharding, simhash
from tests.llm.conftest import SCHEMA, text_of
from tests.llm.test_dedup import slow_components, slow_fingerprint


def junk(i):
    r = random.Random(i)
    kind = i % 3
    words = text_of("en", 40, i).split()
    return " ".join(w + r.choice(["###", "***", "$$$"]) for w in words) if kind == 0 else " ".join(w.upper() + "!!" for w in words) if kind == 1 else " ".join([words[0]] * 60)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, junk(i) if i % 5 == 0 else text_of("en", 40 + i % 30, i), "en", "bad" if i % 5 == 0 and i % 2 else f"s{i % 3}", 200) for i in range(600)]
    labels = [(i, int(i % 5 != 0), 0) for i in range(0, 600) if i % 4 != 1] + [(None, 1, 0), (3, None, 0), (9999, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_rows_without_labels(spark, labelled):
    docs, labels = labelled
    got = quality.score(spark, docs, labels).collect()
    assert len(got) == 600
    unseen = [r for r in got if r["doc_id"] % 4 == 1]
    assert sum(r["kept"] == (r["doc_id"] % 5 != 0) for r in unseen) >= 0.98 * len(unseen)
    assert all(0 <= r["quality"] <= 1 and 0 <= r["text_score"] <= 1 and 0 <= r["meta_score"] <= 1 for r in got)
    kept = quality.keep_good(spark, docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_quality_of_odd_rows(spark, odd, odd_rows, empty, labelled):
    docs, labels = labelled
    assert quality.score(spark, odd, labels.limit(0)).filter("kept and quality is null").count() == len(odd_rows)
    assert quality.score(spark, empty, labels).count() == 0
    both = docs.unionByName(odd.select(docs.columns))
    assert quality.score(spark, both, labels).count() == 600 + len(odd_rows)
    clash = both.selectExpr("*", "1 as label", "'q' as kept", "0.5 as quality", "'x' as x")
    assert quality.keep_good(spark, clash, labels).columns == clash.columns


def test_views_teach_each_other():
    """Each view knows another half of the cases; labels cover cases that both views know."""
    r = np.random.default_rng(0)
    n = 1500
    y = r.integers(0, 2, n).astype(float)
    a, b = r.normal(size=(n, 3)), r.normal(size=(n, 3))
    a[:, 0] += 4 * (2 * y - 1)
    b[:, 0] += 4 * (2 * y - 1)
    model = quality.co_train((a[:40], b[:40]), y[:40], (a[40:1000], b[40:1000]))
    p, pa, pb = model.scores(a[1000:], b[1000:])
    assert ((p > 0.5) == y[1000:]).mean() > 0.98 and ((pa > 0.5) == y[1000:]).mean() > 0.97
    noise = r.normal(size=(n, 3))
    model = quality.co_train((a[:400], noise[:400]), y[:400], (a[400:1000], noise[400:1000]))
    assert ((model.scores(a[1000:], noise[1000:])[0] > 0.5) == y[1000:]).mean() > 0.98


def weak_rows(n):
    """Sources that tell the quality of two rows in three; words that tell a little of it."""
    r = random.Random(3)
    good, bad = ([f"{c}{i:02d}" for i in range(40)] for c in "gb")
    rows = []
    for i in range(n):
        y = r.randrange(2)
        words = [r.choice(good if (r.random() < 0.5 + (0.12 if y else -0.12)) else bad) for _ in range(40)]
        rows.append((i, " ".join(words), "en", f"{'xy'[y]}{r.randrange(3)}" if i % 3 else None, 200, y))
    return rows


def test_rounds_help_when_labels_are_few(spark):
    rows = weak_rows(1600)
    docs = spark.createDataFrame([r[:5] for r in rows], SCHEMA).repartition(4)
    labels = spark.createDataFrame([(r[0], r[5], 0) for r in rows[:100]], "doc_id long, quality int, toxic int")
    right = {}
    for rounds in (0, 5):
        got = {r["doc_id"]: r for r in quality.score(spark, docs, labels, rounds=rounds).collect()}
        unseen = [r for r in rows[100:] if r[3] is None]
        right[rounds] = [sum((got[r[0]][c] >= 0.5) == bool(r[5]) for r in unseen) / len(unseen) for c in ("text_score", "quality")]
    assert right[5][0] > right[0][0] and right[5][1] > right[0][1], right


def test_one_round_against_brute_force(spark):
    """Lessons of all rows, and the step they cause, row by row."""
    rows = weak_rows(300)
    views = [np.stack([quality.text_view(r[1]) for r in rows]), np.stack([quality.meta_view(r[3], r[2], r[4]) for r in rows])]
    y = np.array([float(r[5]) for r in rows])
    model = quality.Model([quality.logistic(x[:80], y[:80]) for x in views])
    model.scales = [quality.logistic(quality.margin(w, x[:80])[:, None], y[:80], ridge=1e-2) for w, x in zip(model.views, views)]
    docs = quality._rows(spark.createDataFrame([r[:5] for r in rows[80:]], SCHEMA).repartition(5))
    lessons = quality.lessons_of(spark, docs, model, 0.9)
    for v in range(2):
        count, grade, curve = 0, np.zeros(views[v].shape[1] + 1), np.zeros(views[v].shape[1] + 1)
        for i in range(80, 300):
            z = float(views[1 - v][i] @ model.views[1 - v][:-1] + model.views[1 - v][-1]) * model.scales[1 - v][0] + model.scales[1 - v][1]
            other = 1 / (1 + np.exp(-z))
            if max(other, 1 - other) >= 0.9:
                x = np.append(views[v][i], 1.0).astype(float)
                own = 1 / (1 + np.exp(-(x @ model.views[v])))
                count, grade, curve = count + 1, grade + x * (own - (other > 0.5)), curve + x * x * own * (1 - own)
        total = lessons.sums[v]
        assert total[0] == count and (count or v == 1)
        assert np.allclose(total[1 : 1 + len(grade)], grade, atol=1e-4) and np.allclose(total[1 + len(grade) :], curve, atol=1e-4)
        x, w = np.hstack([views[v][:80], np.ones((80, 1))]).astype(float), model.views[v]
        if count:
            k, p = min(0.5, 80 / count), 1 / (1 + np.exp(-(x @ w)))
            keep = np.append(np.ones(len(w) - 1), 1e-6)
            curved = sum(np.outer(a, a) * (q * (1 - q) + 1e-9) for a, q in zip(x, p)) * (1 + k * count / 80) + np.diag(keep + k * curve)
            move = np.linalg.solve(curved, sum(a * (q - t) for a, q, t in zip(x, p, y)) + k * grade + keep * w)
            assert np.allclose(quality.taught(w, views[v][:80], y[:80], total), w - move * min(1, 5 / abs(move).max()), atol=1e-3)


def test_an_id_that_repeats_is_learned_from_once(spark, labelled):
    docs, labels = labelled
    many = docs.unionByName(docs.filter("doc_id = 0").crossJoin(spark.range(500)).drop("id"))
    assert quality.fit(spark, many, labels) is not None
    assert quality.score(spark, many, labels).count() == 1100


def slow_shards(rows, limit):
    """Bucket by bucket: split what exceeds the limit on the next bit."""
    out, todo = {}, [("", rows)]
    while todo:
        prefix, inside = todo.pop()
        if sum(b for _, b in inside) <= limit or len(prefix) == 64:
            for key, _ in inside:
                out[key] = prefix
        else:
            for bit in "01":
                part = [(k, b) for k, b in inside if k[len(prefix)] == bit]
                if part:
                    todo.append((prefix + bit, part))
    return out


@pytest.mark.parametrize("limit", [100, 3000, 10**9])
def test_shards(spark, limit):
    rows = [(i, "x" * (i * 37 % 200), None, None, None) for i in range(400)] + [(500, "big" * 2000, None, None, None), (501, None, None, None, None), (None, "none", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    keys = sharding.keyed(df).collect()
    bits = {r["doc_id"]: format(r["key"] & (1 << 64) - 1, "064b") for r in keys}
    want = slow_shards([(bits[r["doc_id"]], r["bytes"]) for r in keys], limit)
    got = sharding.shards(spark, df, limit).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    size, number = Counter(), Counter()
    for r in got:
        assert r["shard"] == want[bits[r["doc_id"]]] and r["depth"] == len(r["shard"])
        size[r["shard"]] += r["bytes"]
        number[r["shard"]] += 1
    for r in got:
        assert (r["shard_bytes"], r["shard_documents"]) == (size[r["shard"]], number[r["shard"]])
        assert r["oversize"] == (r["shard_bytes"] > limit)
        assert not r["oversize"] or r["shard_documents"] == 1


def test_the_query_splits_unevenly(spark):
    got = queries.op9_sharding(spark, "/root/testdata/sf0.01").select("shard", "depth", "shard_bytes", "oversize").distinct().collect()
    assert len(got) > 32 and len({r["depth"] for r in got}) > 1
    assert all(r["oversize"] or r["shard_bytes"] <= sharding.LEAST for r in got)


def test_shards_of_odd_rows(spark, odd, odd_rows, empty, tmp_path):
    got = sharding.shards(spark, odd, 50_000).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd_rows)
    assert sharding.shards(spark, empty).count() == 0
    repeated = spark.createDataFrame([(1, "y" * 1000)] * 50, "doc_id long, text string")
    assert {(r["oversize"], r["shard_documents"], r["depth"]) for r in sharding.shards(spark, repeated, 2000).collect()} == {(True, 50, 64)}
    sharding.write_shards(spark, odd, f"file://{tmp_path}/shards", 50_000)
    back = spark.read.option("basePath", f"file://{tmp_path}/shards").parquet(f"file://{tmp_path}/shards")
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(r[:2] for r in odd_rows)


def write(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_pipeline_against_brute_force(spark, labelled, tmp_path):
    import corpus_pipeline

    docs, labels = labelled
    rows = [tuple(r) for r in docs.collect()]
    rows += [(700, rows[1][1], "en", "s1", 200), (701, rows[1][1], "en", "s1", 200), (702, rows[2][1] + " the", "en", "s2", 200), (703, text_of("en", 400, 77), "en", "s2", 9), (704, text_of("en", 400, 77)[:-1] + " of", "en", "s2", 9)]
    write(spark.createDataFrame(rows, SCHEMA), tmp_path, "documents")
    write(labels, tmp_path, "labels")
    kept = rows
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, str(tmp_path))
        if name == "best_fit_packing":
            packed = out.collect()
            break
        assert out.columns == current.columns
        out.write.parquet(f"{tmp_path}/{name}")
        current = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({tuple(r) for r in current.collect()})
    good = {r for r in kept if r[0] % 5 != 0 or r[0] >= 700}
    assert len(seen[0] ^ good) <= 3
    assert seen[1] == {r for r in seen[0] if any(c.isalpha() for c in r[1])}
    last = {}
    for r in seen[1]:
        last[r[1]] = max(last.get(r[1], r), r)
    assert seen[2] == set(last.values())
    order = sorted(seen[2])
    prints = [slow_fingerprint(r[1]) for r in order]
    named = slow_components([r[0] for r in order], prints)
    assert seen[3] == {r for r, c in zip(order, named) if r[0] == c}
    assert {r["doc_id"] for r in packed} == {r[0] for r in seen[3]}
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter((r["doc_id"], r["piece"], r["length"]) for r in packed)


def test_stages_take_odd_and_empty_tables(spark, odd, odd_rows, empty, labelled, tmp_path):
    import corpus_pipeline

    write(labelled[1], tmp_path, "labels")
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert name == "best_fit_packing" or out.columns == docs.columns
            assert (out.count() == 0) == (docs is empty)
    kept = corpus_pipeline.exact_deduplication(spark, odd, str(tmp_path))
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter({(r[1] or ""): 1 for r in odd_rows})


def test_queries_are_registered():
    assert sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES) == list(range(1, 11))
    assert simhash.SEED == 42


def test_workers_drop_what_other_stages_keep():
    from lodestack.llm import token_ids, work

    token_ids.encoder(token_ids.tokenizer_path(None))
    assert list(work.frugal(lambda batches: batches, "encoders")(iter([1]))) == [1] and token_ids._ENCODERS
    assert list(work.frugal(lambda batches: batches)(iter([1]))) == [1] and not token_ids._ENCODERS
