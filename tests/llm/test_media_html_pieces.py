import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from lodestack.llm import html_text, media_webp, sentencepiece_codec
from lodestack.llm.media_webp import CROSS_COLOUR, PALETTE, PREDICTOR, SUBTRACT_GREEN


def image(r, h, w, colours):
    return r.integers(0, 1 << 32, colours, dtype=np.uint32)[r.integers(0, colours, (h, w))]


@pytest.mark.parametrize("size", [(1, 1, 1), (5, 7, 2), (9, 13, 4), (16, 16, 15), (11, 23, 200)])
@pytest.mark.parametrize("cache", [0, 1, 6])
def test_webp_round_trip(size, cache):
    h, w, colours = size
    r = np.random.default_rng(h * w + cache)
    p = image(r, h, w, colours)
    blocks = ((h + 3) // 4, (w + 3) // 4)
    modes = r.integers(0, 14, blocks).astype(np.uint32)
    elements = r.integers(0, 1 << 24, blocks).astype(np.uint32) | np.uint32(255 << 24)
    meta = (2, r.integers(0, 3, blocks).astype(np.uint32))
    every = [[], [(PREDICTOR, 2, modes)], [(CROSS_COLOUR, 2, elements)], [(SUBTRACT_GREEN,)], [(SUBTRACT_GREEN,), (PREDICTOR, 2, modes), (CROSS_COLOUR, 2, elements)], [(PALETTE,)], [(PALETTE,), (PREDICTOR, 2, modes[:, :1].repeat(blocks[1], 1))]]
    for transforms in every:
        if len(transforms) == 2 and transforms[0] == (PALETTE,) and colours <= 16:
            continue  # the predictor's blocks would be those of the packed width
        for references in (False, True):
            for groups in (None, meta):
                if groups and transforms and transforms[0] == (PALETTE,) and colours <= 16:
                    continue
                assert (media_webp.decode(media_webp.encode(p, transforms, cache, references, groups)) == p).all()


def test_known_stream():
    """One opaque red pixel: header, no transform, no cache or meta image, five codes of one symbol."""
    bits = []

    def put(value, n):
        bits.extend(value >> i & 1 for i in range(n))

    for value, n in ((0x2F, 8), (0, 14), (0, 14), (0, 1), (0, 3), (0, 1), (0, 1), (0, 1)):
        put(value, n)
    for symbol in (0, 255, 0, 255, 0):  # green, red, blue, alpha, distance
        put(1, 1)
        put(0, 1)
        put(1, 1)
        put(symbol, 8)
    raw = np.packbits(np.array(bits, np.uint8), bitorder="little").tobytes()
    assert media_webp.decode(media_webp._file(raw)).tolist() == [[0xFFFF0000]]


def test_near_table():
    assert len(media_webp.NEAR) == 120
    assert media_webp.NEAR[:8] == [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2)]
    assert media_webp.NEAR[-3:] == [(-7, 7), (8, 6), (8, 7)]


def test_broken_streams_raise():
    r = np.random.default_rng(1)
    good = media_webp.store(r.integers(32, 127, 1920, dtype=np.uint8).tobytes())
    for read in (media_webp.decode, lambda raw: media_webp.decode_all([raw])):
        for bad in (b"", good[:40], good[:-200], b"RIFX" + good[4:], good[:20] + b"\x00" + good[21:]):
            with pytest.raises(ValueError):
                read(bad)
    for _ in range(300):  # any other damage is an error or another image
        bad = bytearray(good)
        bad[r.integers(20, len(bad))] ^= 1 << int(r.integers(8))
        for read in (media_webp.decode, lambda raw: media_webp.decode_all([raw])):
            try:
                read(bytes(bad))
            except ValueError:
                pass


@pytest.mark.parametrize("size", [(1, 1, 1), (5, 7, 2), (9, 13, 4), (16, 16, 15), (11, 23, 200)])
def test_side_by_side_is_one_by_one(size):
    """Images of all kinds decoded together: caches, references, transforms, meta codes, alpha."""
    h, w, colours = size
    r = np.random.default_rng(h)
    blocks = ((h + 3) // 4, (w + 3) // 4)
    modes, elements = r.integers(0, 14, blocks).astype(np.uint32), r.integers(0, 1 << 24, blocks).astype(np.uint32)
    meta = (2, r.integers(0, 3, blocks).astype(np.uint32))
    files, want = [], []
    for transforms in ([], [(PREDICTOR, 2, modes)], [(PREDICTOR, 2, modes * 0 + 1)], [(PREDICTOR, 2, modes * 0 + 2)], [(CROSS_COLOUR, 2, elements)], [(SUBTRACT_GREEN,)], [(PALETTE,)]):
        for cache in (0, 1, 6):
            for references in (False, True):
                for groups in (None, meta if transforms != [(PALETTE,)] else None):
                    p = image(r, h, w, colours)
                    p[h // 2 :] = p[: h - h // 2] if r.random() < 0.5 else p[h // 2 :]
                    want.append(p)
                    files.append(media_webp.encode(p, transforms, cache, references, groups))
    got = media_webp.decode_all(files)
    assert all((a == b).all() for a, b in zip(got, want)) and all((media_webp.decode(f) == p).all() for f, p in zip(files, want))


def test_stored_texts_use_the_format():
    """Texts of the corpus come through prefix codes, cache, references and transforms, and get smaller."""
    import duckdb

    texts = duckdb.sql("select coalesce(text, '') from read_parquet('/root/testdata/sf0.001/documents.parquet')").fetchall()
    payloads = [t.encode() + b" " * (max(192, -(-len(t.encode()) // 192) * 192) - len(t.encode())) for (t,) in texts] + [b"ab" * 96 * 20, bytes(range(64)) * 3 * 30]
    media_webp.SEEN.clear()
    media = [media_webp.store(p) for p in payloads]
    assert [media_webp.payload_of(x) for x in media_webp.load_all(media)] == payloads
    assert sum(map(len, media)) < 0.75 * sum(map(len, payloads))
    assert all(media_webp.SEEN[k] > 0 for k in ("cache", "references", "palette", "predictor"))


def test_feature_against_a_plain_loop():
    r = np.random.default_rng(8)
    for n in (1, 7, 64, 130):
        pixels = r.integers(0, 1 << 24, (n, 64)).astype(np.uint32) | np.uint32(255 << 24)
        flat = [((x >> 16) & 255, (x >> 8) & 255, x & 255) for x in pixels.reshape(-1).tolist()]
        means = [sum(p[i] for p in flat) / len(flat) for i in range(3)]
        cuts = [k * len(flat) // 64 for k in range(65)]
        bits = "".join("1" if sum(map(sum, flat[a:b])) / (b - a) > sum(sum(p) for p in flat) / len(flat) else "0" for a, b in zip(cuts, cuts[1:]))
        assert media_webp.feature(pixels) == ",".join(f"{m:.3f}" for m in means) + f",{int(bits, 2):016x}"


def test_media_columns(spark, odd, odd_rows, empty):
    got = media_webp.media_columns(spark, odd).collect()
    want = Counter()
    for d, t, *_ in odd_rows:
        raw = (t or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        want[d, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    assert len({(r["payload_sha256"]) for r in got}) == len({(r["payload_sha256"], r["media_sha256"], r["feature"], r["media_bytes"]) for r in got})
    assert media_webp.media_columns(spark, empty).count() == 0


def test_long_payload_becomes_several_images():
    payload = bytes(range(256)) * 3 * 4096
    media = media_webp.store(payload)
    assert media.count(b"WEBPVP8L") >= 4 and media_webp.payload_of(media_webp.load(media)) == payload


PAGES = {
    "article": ("<html><head><title>T</title><style>x{}</style></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy this now, the best there is of all</div>"
                "<article><h1>Head &amp; tail</h1><p>One <b>bold</b> word<br>and\n more.<p>Two&nbsp;three.</article><aside>Side text that is long enough to count</aside><footer>&copy; me</footer></body></html>",
                "Head & tail One bold word and more. Two three."),
    "divisions": ("<body><div id=menu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class=content><p>First paragraph with quite some text in it.</p><p>Second paragraph with more text than that, surely.</p></div>"
                  "<div class='comments'><p>Great article, I liked every word of it!</p></div><div><a href=a>x</a> <a href=b>y</a></div><script>var a='<p>no</p>'</script></body>",
                  "First paragraph with quite some text in it. Second paragraph with more text than that, surely."),
    "plain": ("just <i>some</i> text", "just some text"),
    "empty body": ("<html><body><nav>menu</nav></body></html>", ""),
    "unclosed": ("<body><article><p>text that is <b>not closed<p>and goes on", "text that is not closed and goes on"),
    "nothing": ("", ""), "null": (None, ""), "comment": ("<!-- <p>x</p> --><p>y</p>", "y"),
    "less than": ("<article><p>a < b and 3 > 2</p></article>", "a < b and 3 > 2"),
    "hidden": ("<article><p>seen</p><p hidden>not seen</p><p style='display:none'>nor this</p><form><input value=x>Sign up</form></article>", "seen"),
    "list": ("<main><h2>Title</h2><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></main>", "Title one two a b"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert html_text.main_text(page) == want


def test_extract(spark):
    rows = [(i, f"u{i}", p, "x") for i, (p, _) in enumerate(PAGES.values())] + [(None, None, "<p>x", None), (0, "u0", PAGES["article"][0], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_text.extract(spark, df).collect())
    want = Counter((i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES.values())) + Counter([(None, None, "x", 1), (0, "u0", PAGES["article"][1], len(PAGES["article"][1]))])
    assert got == want
    assert html_text.extract(spark, df.limit(0)).count() == 0


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "bottom" + "</div>" * 5000
    assert html_text.main_text(deep) == "bottom"
    words = "word " * 200_000
    assert html_text.main_text(f"<article><p>{words}</article>") == words.strip()


@pytest.fixture(scope="module")
def model():
    with open(sentencepiece_codec.model_path(None), "rb") as f:
        return f.read()


def unigram_of(model):
    """The same pieces and scores as a unigram model: the trainer's model type is field 3."""
    assert model.count(b"\x18\x02 ") == 1
    return model.replace(b"\x18\x02 ", b"\x18\x01 ")


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_ids_are_the_library_ids(model, kind):
    from sentencepiece import SentencePieceProcessor

    raw = model if kind == "bpe" else unigram_of(model)
    library, own = SentencePieceProcessor(model_proto=raw), sentencepiece_codec.Codec(raw, kept=50)
    r = random.Random(2)
    texts = ["", " ", "   ", "Hello world", " x  y ", "a\n\nb\t", "日本語 😀", "<s> </s> <unk>", "aaaa aaaaa", "é ﬁ \xa0", "ab" * 900, "x" * 700 + " " + "é" * 300]
    texts += ["".join(r.choice("abcdeth ing.,\n <>/日é😀  ") for _ in range(r.randrange(50))) for _ in range(400)]
    for t in texts:
        ids = np.frombuffer(own.encode(t), "<u4").tolist()
        want = library.encode(t)
        if kind == "bpe":
            assert ids == want
        else:  # equal sums of scores may be reached by several ways
            assert "".join(library.id_to_piece(i) for i in ids) == "".join(library.id_to_piece(i) for i in want)
            assert abs(sum(own.score[i] for i in ids) - sum(own.score[i] for i in want)) < 1e-3 or any(library.is_byte(i) for i in want)
        assert own.decode(own.encode(t)) == t
    import pyarrow as pa

    texts += ["a▁b", "▁", "x▁ y"]
    assert own.encode_all(pa.array(texts)) == [own.encode(t) for t in texts]


def test_window_stays_bounded(model):
    own = sentencepiece_codec.Codec(model)
    pieces = (x for _ in range(3000) for x in ("▁the", "inter", "nation", "al"))
    longest, out = 0, []
    for part in own.segments(pieces):
        longest = max(longest, sum(len(c) for _, c in part))
        out += [p for p, _ in part]
    whole = np.frombuffer(own.encode(" ".join(["theinternational"] * 3000)), "<u4").tolist()
    assert out == whole and longest < 400


def test_codec_documents(spark, odd, odd_rows, empty, model):
    encoded = sentencepiece_codec.encode_documents(odd)
    back = sentencepiece_codec.decode_documents(encoded).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((d, t or "") for d, t, *_ in odd_rows)
    trip = sentencepiece_codec.round_trip(spark, odd).collect()
    assert Counter((r["doc_id"], r["decoded_chars"], r["decoded_sha256"]) for r in trip) == Counter((d, len(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in odd_rows)
    assert sentencepiece_codec.round_trip(spark, empty).count() == 0


def test_densities_by_hand():
    """Characters a tag, adjusted by the share of characters and tags in links; sums of children."""
    root = html_text.parse("<body><div><p>aaaaaaaaaa</p><p><a>bbbb</a>cccccc</p></div><nav>menu</nav></body>")
    body = root.parts[0]
    got = [(n.tag, n.chars, n.tags, round(n.density, 2), round(n.total, 2)) for n in html_text.measure(body)]
    # p: 10 / 1; with a link of 4: 10 * ln(10/4) / ln(ln(10/6*4 + 0.2*10 + e)); div: 20/3 * ln(20/4 * 3) / ln(ln(20/16*4 + 0.2*20 + e))
    assert got[1:] == [("div", 20, 3, 20.05, 20.31), ("p", 10, 0, 10.0, 0.0), ("p", 10, 1, 10.31, 0.0)]
    assert got[0][:3] == ("body", 20, 4) and got[0][4] == 20.05


def test_density_finds_the_text_without_an_article():
    page = "<body><div class='top'><a href=1>One</a> <a href=2>Two</a></div><div id=x><h1>Head</h1>{}</div><div class=comments>{}</div></body>"
    own, other = "".join(f"<p>{'word ' * (20 + i)}</p>" for i in range(5)), "".join(f"<p>{'reply ' * 60}</p>" for i in range(9))
    want = " ".join(["Head", *(" ".join(["word"] * (20 + i)) for i in range(5))])
    assert html_text.main_text(page.format(own, other)) == want


def test_article_tag_does_not_decide(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    for (page,) in rows:
        assert html_text.main_text(page.replace("<article>", "<div>").replace("</article>", "</div>")) == html_text.main_text(page)


def test_inline_elements_that_are_no_content_nest():
    assert html_text.main_text("<p>x <span class='ad'>a <span>b</span> leak</span> y") == "x y"
    assert html_text.main_text("<div><p>x <span class=ad>a <b>b</p><p>next</div>") == "x next"


def test_words_of_a_class_inside_the_article():
    assert html_text.main_text("<article><div class='tags related side-by-side'>kept</div><div class='ad-box'>gone</div></article>") == "kept"


@pytest.mark.parametrize("part, times", [('<a "', 250_000), ('<a ">" ', 150_000), ("<a '>", 200_001), ("<", 1_000_000), ("<!--", 250_000), ("<span class=ad>", 70_000), ("<script>", 130_000), ("</div>", 170_000), ("<div>", 200_000)])
def test_broken_pages_take_linear_time(part, times):
    start = time.process_time()
    html_text.main_text(part * times + '"')
    assert time.process_time() - start < 2


def test_stream_commits_often_and_waits_for_little(spark, monkeypatch):
    """The query's path over long texts: many commits, a bounded window, ids of the library."""
    from sentencepiece import SentencePieceProcessor

    path = sentencepiece_codec.model_path(None)
    library = SentencePieceProcessor(model_file=path)
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    r = random.Random(5)
    texts += ["  two   spaces \n" * 90, "", " ", " " * 300, "a" * 1000, "x " + "é日" * 700 + " y  ", "\u2581mark\u2581\u2581 x", "a \u2581b" * 200, " ".join(texts[:40])]
    texts += ["".join(r.choice("ab  \u2581é") for _ in range(400)) for _ in range(40)]
    want = [np.array(library.encode(t), "<u4").tobytes() for t in texts]
    with open(path, "rb") as f:
        model = f.read()
    for portion in (sentencepiece_codec.PORTION, 64, 7):
        monkeypatch.setattr(sentencepiece_codec, "PORTION", portion)
        made = sentencepiece_codec.Codec(model)
        assert made.stream([sentencepiece_codec.portions(t) for t in texts]) == want
        longest = max(len(w) for t in texts for w in t.split(" "))
        assert made.commits >= sum(map(len, texts)) / (2 * portion + longest) and made.widest <= max(2 * portion, 2 * made.longest + 64 + portion) + (longest if portion > 64 else 300)


def test_search_alone_holds_a_bounded_window():
    """One word of 200,000 characters: commits where all paths meet."""
    from sentencepiece import SentencePieceProcessor

    path = sentencepiece_codec.model_path(None)
    word = "".join(random.Random(2).choice("etaoinshr") for _ in range(200_000))
    with open(path, "rb") as f:
        made = sentencepiece_codec.Codec(f.read())
    got = made.stream([sentencepiece_codec.portions(word)])
    assert got == [np.array(SentencePieceProcessor(model_file=path).encode(word), "<u4").tobytes()]
    assert made.commits >= len(word) / (2 * sentencepiece_codec.PORTION) and made.widest <= 3 * sentencepiece_codec.PORTION
