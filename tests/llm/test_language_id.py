import zlib

import numpy as np

from lodestack.llm import language_id
from tests.llm.conftest import WORDS, text_of


def brute_bits(samples, text, order, kept):
    """Code length by counting followers of every context in the samples, context by context."""
    total = 0.0
    for i, b in enumerate(text):
        context = text[max(0, i - order) : i]
        while context not in kept:
            context = context[1:]
        bits = 0.0
        while True:
            follow = {}
            for s in samples:
                for j in range(len(context), len(s)):
                    if s[j - len(context) : j] == context:
                        follow[s[j]] = follow.get(s[j], 0) + 1
            n, d = sum(follow.values()), len(follow)
            if b in follow:
                bits += np.log2((n + d) / follow[b])
                break
            if n:
                bits += np.log2((n + d) / d)
            if not context:
                bits += 8
                break
            context = context[1:]
        total += bits
    return total


def test_code_lengths_are_those_of_the_context_trees():
    samples = {k: [text_of(k, 40, 1).encode()] for k in ("en", "fr")}
    model = language_id.train(samples, order=3, states=150)
    seen = {}
    for texts in samples.values():
        for t in texts:
            for k in range(1, 4):
                for i in range(len(t) - k + 1):
                    seen[t[i : i + k]] = seen.get(t[i : i + k], 0) + 1
    kept = {c for c, _ in sorted(seen.items(), key=lambda p: (-p[1], len(p[0]), p[0]))[:149]}
    kept = {b""} | {c for c in kept if all(c[i:j] in kept for i in range(len(c)) for j in range(i + 1, len(c) + 1))}
    texts = [b"the and Q", b"", text_of("fr", 200, 3).encode(), b"x", text_of("en", 20, 9).encode()]
    bits, text, size = model.code_lengths(texts, segment=50)
    assert [int(size[text == i].sum()) for i in range(5)] == [len(t) for t in texts]
    for i in (0, 3, 4):
        for x, name in enumerate(model.languages):
            assert abs(bits[text == i, x].sum() - brute_bits(samples[name], texts[i], 3, kept)) < 1e-2
    # long texts cross lanes and windows
    long = text_of("en", 3000, 5).encode() * 60
    whole = model.code_lengths([long])[0].sum(0)
    parts = model.code_lengths([long, b"the", long])[0]
    assert np.allclose(parts.sum(0) - model.code_lengths([b"the"])[0].sum(0), 2 * whole, rtol=1e-5)


def test_held_out_accuracy(spark, corpus):
    rows = language_id.identify(spark, corpus).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 240
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)


def test_held_out_rows_are_not_learned(spark, corpus):
    learned = language_id.sample(corpus, 400, 20_000, 10**9)
    texts = {t for v in learned.values() for t in v}
    for r in corpus.collect():
        assert (r["text"].encode() in texts) == (zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2)


def test_a_foreign_passage_counts_by_its_size(spark, corpus):
    mixed = spark.createDataFrame([(1, text_of("en", 120, 1) + " " + text_of("fr", 60, 2))], "doc_id long, text string")
    model = language_id.train(language_id.sample(corpus, 400, 20_000, 10**6))
    names, scores, _ = language_id.predict(model, [mixed.first()["text"]])
    assert names == ["en"] and 0.5 < scores[0] < 0.9


def test_odd_rows(spark, odd, odd_rows, empty, corpus):
    got = {(r["doc_id"]): r for r in language_id.identify(spark, odd).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[8]["lang_pred"] == "und" and got[1]["score"] == 0
    assert got[4]["lang_pred"] in WORDS
    assert language_id.identify(spark, odd).count() == len(odd_rows)
    assert language_id.identify(spark, empty).count() == 0
    unlabelled = odd.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language_id.identify(spark, unlabelled).collect()} == {"und"}
    kept = language_id.keep_known(spark, odd)
    assert kept.columns == odd.columns and not {1, 2, 8} & {r["doc_id"] for r in kept.collect()}
    assert language_id.keep_known(spark, unlabelled).filter("doc_id = 3").count() == 1
    assert language_id.keep_known(spark, corpus).count() == corpus.count()


def test_sample_is_bounded(spark):
    """Ids that repeat, equal rows, and a lang of its own for every row: what reaches the driver stays small."""
    learned = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2]
    one = [(learned[0], f"the words of row {i}", "en") for i in range(3000)] + [(learned[1], "equal rows", "de")] * 3000
    got = language_id.sample(spark.createDataFrame(one, "doc_id long, text string, lang string"), 100, 1000, 10**6)
    assert 40 < len(got["en"]) < 200 and len(got.get("de", [])) <= 1
    many = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id) as text", "concat('l', id) as lang")
    assert len(language_id.sample(many, 100, 1000, 10**6)) <= language_id.LANGUAGES


def test_ties_go_to_the_first_language():
    model = language_id.train({"b": [b"same text"], "a": [b"same text"]})
    assert language_id.predict(model, ["same text"])[0] == ["a"]
