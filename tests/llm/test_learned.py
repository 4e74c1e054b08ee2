"""Main text, language identification and resampling."""

import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from slackline.llm import html, language, queries, resampling
from tests.llm import edge


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = "<article><h1>Head &amp; line</h1><p>One <b>bold</b>\n  word<br>next</p><p>Two</p></article>"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (page(ARTICLE), "Head & line\nOne bold word next\nTwo"),
        (page("<nav><a>x</a></nav><div class='ad'>buy</div>" + ARTICLE + "<footer>f</footer>"), "Head & line\nOne bold word next\nTwo"),
        (page("<article><p>a<p>b<li>c</article>"), "a\nb\nc"),
        (page("<article><p><b>a<br><p>b</p></article><footer>x</footer>"), "a\nb"),
        (page("<script>var t='</p><article>no</article>'</script><article><p>yes</p></article>"), "yes"),
        (page("<style>p{}</style><!-- <article>no</article> --><article>yes<!-- x --> too</article>"), "yes too"),
        (page("<article><p>kept</p><div class='comments'><article>reader</article></div></article>"), "kept"),
        (page("<article><form>f</form><aside>a</aside><p>kept</p><button>b</button></article>"), "kept"),
        (page("<header><h1>site</h1></header><main><p>m</p></main>"), "m"),
        (page("<div>plain</div><p>page</p>"), "plain\npage"),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>cut off</p><p cla", "cut off"),
        ("<p>a &lt;b&gt; &#233; &eacute; &nbsp; x</p>", "a <b> é é x"),
        ("no markup at all", "no markup at all"),
        ("1 < 2 and <p>x", "1 < 2 and\nx"),
        ("", ""),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a b\nc"),
        ("<article><p hidden>no</p><p data-x='hidden'>yes</p></article>", "yes"),
        (page("<div class='cookie-notice'>We use</div><article><p class='lead'>x</p></article><div id='comments'>r</div>"), "x"),
        (page("<article><div class='article-header'><h1>Title</h1></div><p>x</p></article>"), "Title\nx"),
        (page("<article><section id='related-work'><p>w</p></section><div class='related-posts'>r</div></article>"), "w"),
        (page("<article class='post social-policy'><p>x</p><div class='ad'>buy</div></article>"), "x"),
        (page("<article><p>x</p></article><article class='comment-body'><p>reader</p></article>"), "x"),
        (page("<div class='article-header'>site</div><article><p>x</p></article>"), "x"),
    ],
)
def test_extraction(source, text):
    assert html.extract(source) == text


def host_pages(n, host="a.example.com"):
    rng = np.random.default_rng(1)
    out = []
    for i in range(n):
        paragraphs = "".join(f"<p>{' '.join(f'w{rng.integers(0, 10**6)}' for _ in range(12))}</p>" for _ in range(int(rng.integers(3, 7))))
        box = "<div><p>Always the same words here</p></div>"
        out.append((i, f"http://{host}/{i}", page(f"<div><p>Site of things</p></div><div>{paragraphs}</div>{box}")))
    return out


def test_constant_nodes_of_a_host_become_template(spark):
    rows = host_pages(9)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    known = html.wrappers(df).collect()
    assert [r["host"] for r in known] == ["a.example.com"]
    assert {t for _, t in json.loads(known[0]["template"])} == {"Site of things", "Always the same words here", "t"}
    texts = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    assert all("Always" not in t and "Site of" not in t for t in texts.values())
    assert all(t.count("\n") >= 2 for t in texts.values())


def test_copies_of_a_page_are_no_template(spark):
    rows = host_pages(1) * 30
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html.wrappers(df).count() == 0
    assert all("Site of things" in r["text"] for r in html.main_text(df).collect())


def test_every_layout_and_language_of_a_host_has_its_template(spark):
    rng = np.random.default_rng(4)
    line = lambda: " ".join(f"w{rng.integers(0, 10**6)}" for _ in range(8))
    rows = []
    for i in range(90):
        body = "".join(f"<p>{line()}</p>" for _ in range(3))
        if i % 3 == 0:
            source = f"<html lang='de'><body><div><p>Alle Themen</p></div><div>{body}</div></body></html>"
        elif i % 3 == 1:
            source = f"<html lang='en'><body><div><p>All topics</p></div><div>{body}</div></body></html>"
        else:
            source = f"<html><body><table><tr><td>Shop home</td></tr></table><ul><li>{line()}</li><li>{line()}</li></ul></body></html>"
        rows.append((i, f"http://h.example/{i}", source))
    # A block on some pages of the host only is content.
    rows += [(100 + i, f"http://h.example/n{i}", f"<html lang='en'><body><div><p>Storm warning</p></div><div><p>{line()}</p></div></body></html>") for i in range(3)]
    rows.append((200, "http://h.example/404", "<html><body><h1>Not found</h1></body></html>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    assert not any(t in text for text in texts.values() for t in ("Alle Themen", "All topics", "Shop home"))
    assert all(texts[i].count("\n") == (1 if i % 3 == 2 else 2) for i in range(90))
    assert all("Storm warning" in texts[100 + i] for i in range(3))
    assert texts[200] == "Not found"


def test_a_page_that_is_half_constant_still_tells_of_its_host(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(8):
        body = "".join(f"<p>{' '.join(f'w{rng.integers(0, 10**6)}' for _ in range(8))}</p>" for _ in range(4))
        constant = "<div>Home</div><div>All topics</div><div>Write to us</div><div>All rights kept</div>"
        rows.append((i, f"http://half.example/{i}", page(f"{constant}<div>{body}</div>")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html.main_text(df).collect():
        assert r["text"].count("\n") == 3 and "topics" not in r["text"]


def shape_of(*names):
    paths = html.Paths()
    found = []
    for name in names:
        at = 0
        for sign in name.split("/"):
            at = paths.step(at, sign)
        found.append(at)
    return paths.shape(found)


def test_skeleton_of_paths():
    def listed(slot):
        return [slot.sign, *[listed(s) for s in slot.slots]]

    whole = html.skeleton(shape_of("a/b", "a/c", "d", "a/e", "a"))
    assert listed(whole) == ["", ["#", ["a", ["b"], ["c"]], ["d"], ["a", ["e"]]]]
    assert html._count(whole) == 8


def plain_match(a, b):
    if a.sign != b.sign:
        return 0
    score = [[0] * (len(b.slots) + 1) for _ in range(len(a.slots) + 1)]
    for i, x in enumerate(a.slots, 1):
        for j, y in enumerate(b.slots, 1):
            score[i][j] = max(score[i - 1][j], score[i][j - 1], score[i - 1][j - 1] + plain_match(x, y))
    return score[-1][-1] + 1


def test_tree_matching_equals_its_recursion():
    rng = random.Random(3)
    shapes = [["/".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 9))] for _ in range(30)]
    trees = [html.skeleton(shape_of(*dict.fromkeys(s))) for s in shapes]
    for a in trees:
        for b in trees:
            score, pairs = html.match(a, b)
            assert score == plain_match(a, b) == len(pairs)
            assert all(x.sign == y.sign for x, y in pairs)


def test_very_deep_and_odd_pages(spark):
    """Nesting of 100,000 elements, end tags that close nothing, and such pages on one host."""
    deep = "<div>" * 100_000 + "bottom" + "</div>" * 100_000
    texts = "".join(f"<div>t{i} " for i in range(3000))
    stray = "<section>" * 20_000 + "<p>in</p>" + "</article>" * 100_000
    inline = "<i>" * 50_000 + "x" + "</b>" * 50_000
    rows = [(i, f"http://deep.example/{i}", page(f"<div><p>w{i} one</p></div>")) for i in range(5)]
    rows += [(10, "http://deep.example/a", deep), (11, "http://deep.example/b", texts), (12, "http://deep.example/c", stray), (13, None, inline)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    assert (got[10], got[12], got[13]) == ("bottom", "in", "x")
    assert got[11] == "\n".join(f"t{i}" for i in range(3000))
    assert got[3] == "w3 one"


def test_repeated_rows_and_extra_columns(spark):
    rows = [(1, "http://x.example/1", page(ARTICLE), "a", 2, "b", "c", "d")] * 4
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, page long, text string, blocks string, layout string")
    got = html.main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = "Head & line\nOne bold word next\nTwo"
    assert {tuple(r) for r in got.collect()} == {(1, "http://x.example/1", text, len(text))}
    assert got.count() == 4


def test_many_skeletons_of_a_host_are_aligned_in_batches(spark):
    """Pages of three layouts, each with its own number of repeated parts, on one host."""
    rng = random.Random(8)
    rows = []
    for i in range(120):
        kind = "xyz"[i % 3]
        own = [f"{kind}/{kind}{n}/{kind}{n}{m}" for n in range(6) for m in range(3)]
        extra = [f"{kind}/odd{rng.randint(0, 999)}" for _ in range(2)]
        rows.append(("h", i, 1, json.dumps(shape_of(*own, *extra))))
    df = spark.createDataFrame(rows, "host string, skeleton long, n long, paths string")
    for batch in (500, 10):
        found = {r["skeleton"]: r["layout"] for r in html.alike(df, batch).collect()}
        assert len(found) == 120
        assert len(set(found.values())) == 3
        assert all(found[i] == found[i % 3] for i in range(120))


def test_tree_matching_keeps_order():
    a, b = html.skeleton(shape_of("x", "y", "z")), html.skeleton(shape_of("y", "x", "z"))
    score, pairs = html.match(a, b)
    assert score == 4
    assert sorted((p.sign, q.sign) for p, q in pairs[2:]) in ([("x", "x"), ("z", "z")], [("y", "y"), ("z", "z")])


def test_pages_with_nulls_and_odd_urls(spark):
    rows = [
        (1, None, ARTICLE), (2, "http://h/x", None), (None, "", ""), (3, "no url", "<p>x</p>"),
        (3, "no url", "<p>x</p>"), (4, "HTTP://User:pw@Host.Example:80/", "<p>" + "y " * 50_000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.main_text(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert (by[2]["text"], by[None]["text"], by[3]["text"]) == ("", "", "x")
    assert by[4]["n_chars"] == 2 * 50_000 - 1
    assert df.select(html.host(df.url).alias("h")).collect()[5]["h"] == "host.example"
    assert html.main_text(df.limit(0)).count() == 0


LANGS = {
    "en": "the weather of this morning was better than they had thought",
    "de": "das wetter an diesem morgen war besser als sie gedacht haben",
    "fr": "le temps de ce matin était meilleur que ce qu'ils pensaient",
}


def language_rows(n=60):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(n):
        lang = list(LANGS)[i % 3]
        words = LANGS[lang].split()
        rows.append((i, " ".join(rng.choice(words, size=25)), lang))
    return rows


def test_held_out_language(spark):
    rows = language_rows() + [(900, None, "en"), (901, "12 34 !", "en"), (902, "", None), (None, "the weather", "en"), (903, "语语语", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.identify(df).collect()}
    assert len(got) == len(rows)
    for i, _, lang in rows[:60]:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["lang_pred"] == lang
        assert 0 <= got[i]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert got[903]["lang_pred"] in LANGS
    assert got[None]["held_out"] is False


def test_prediction_uses_the_text_alone(spark):
    rows = language_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    other = spark.createDataFrame([(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in rows], df.schema)
    key = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(d).collect())
    assert key(df) == key(other)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language.identify(df).collect()] == ["und"]
    assert language.identify(df.limit(0)).count() == 0


def test_filters_hold_what_was_learned(spark):
    df = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    filters = language.learn(df)
    hits, total = filters.counts([" ".join(w.split()) for w in LANGS.values()])
    assert (hits.argmax(axis=1) == [filters.languages.index(x) for x in LANGS]).all()
    assert (filters.false < 0.05).all()
    assert (total > 50).all()


def test_more_languages_than_one_plane(spark):
    rows = [(i, " ".join(chr(0x4E00 + 97 * i + k) * 4 for k in range(20)), f"l{i:03d}") for i in range(130)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.learn(df)
    assert filters.planes.shape[0] == 3
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(df, filters, keep=["doc_id"]).collect()}
    assert all(got[i] == x for i, _, x in rows)


def test_a_long_text_is_read_in_pieces():
    text = "abc def " * 400_000
    total = sum(np.bincount(owner, minlength=2) for owner, _ in language.ngrams(["x", text]))
    assert total.tolist() == [0, 5 * 800_000]


def quality_rows():
    rng = np.random.default_rng(9)
    good, bad = [f"g{i}" for i in range(200)], [f"b{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(400):
        words = rng.choice(bad if i % 4 == 0 else good, size=60)
        docs.append((i, " ".join(words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(i % 4 != 0), 0))
    return docs, labels


def test_resampling_prefers_target_like_text(spark):
    docs, labels = quality_rows()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = resampling.resample(d, b, share=0.75).collect()
    assert len(rows) == 400
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert len(kept) == 300
    assert all(i % 4 for i in kept)
    again = resampling.resample(d, b, share=0.75).collect()
    assert {r["doc_id"] for r in again if r["kept"]} == kept


def test_gumbel_numbers_sample_in_proportion(spark):
    docs = [(i, "a b c") for i in range(4000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    rows = resampling.resample(d, b, share=0.5, temperature=1.0).collect()
    kept = [r["doc_id"] for r in rows if r["kept"]]
    assert len(kept) == 2000
    assert abs(np.mean(kept) - 2000) < 100


def test_rows_a_little_below_the_cut_are_drawn_too(spark):
    d = spark.createDataFrame([(i, "x p" if i % 2 else "x q") for i in range(2000)], "doc_id long, text string")
    labels = [(i, 1, 0) for i in range(1, 1200, 2)] + [(i, 1, 0) for i in range(0, 600, 2)]
    b = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = resampling.resample(d, b, share=0.5).collect()
    weights = {r["doc_id"] % 2: r["log_weight"] for r in rows}
    assert 1.0 < weights[1] - weights[0] < 2.0
    kept = [r["doc_id"] % 2 for r in rows if r["kept"]]
    assert len(kept) == 1000 and 150 < kept.count(0) < 400


def plain_log_weights(docs, good):
    """log importance ratio of each text, with plain numbers: buckets, counts, prior, sums."""

    def found_in(text):
        hashes = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in text.split()]
        half, mask = resampling.BUCKETS // 2, (1 << 64) - 1
        pairs = [((a * 0x9E3779B97F4A7C15 + (b >> 7)) & mask) * 0xC2B2AE3D27D4EB4F & mask for a, b in zip(hashes, hashes[1:])]
        return [h % half for h in hashes] + [half + (p >> 20) % half for p in pairs]

    raw, target = Counter(), Counter()
    for i, text in docs:
        raw.update(found_in(text))
        if i in good:
            target.update(found_in(text))
    size = sum(raw.values()) + resampling.BUCKETS
    share = {b: (raw[b] + 1) / size for b in raw}
    rest = 1 / size
    kinds = Counter((target[b], share[b]) for b in raw)
    kinds[0, rest] += resampling.BUCKETS - len(raw)
    n = sum(target.values())
    like = {}
    for g, p in kinds:
        m = n * p
        logs = [
            math.lgamma(s + g) - math.lgamma(s) + s * math.log(s / (s + m)) + (g * math.log(m / (s + m)) if g else 0)
            for s in resampling.SHAPES
        ]
        like[g, p] = [math.exp(x - max(logs)) for x in logs]
    weight = [1 / len(resampling.SHAPES)] * len(resampling.SHAPES)
    for _ in range(resampling.ROUNDS):
        total = [0.0] * len(weight)
        for kind, count in kinds.items():
            own = [w * x for w, x in zip(weight, like[kind])]
            total = [t + count * o / sum(own) for t, o in zip(total, own)]
        before, weight = weight, [t / resampling.BUCKETS for t in total]

    def ratio(g, p):
        own = [w * x for w, x in zip(before, like[g, p])]
        return sum(o / sum(own) * (s + g) / (s + n * p) for o, s in zip(own, resampling.SHAPES))

    values = {kind: ratio(*kind) for kind in kinds}
    whole = sum(count * values[g, p] * p for (g, p), count in kinds.items())
    return {i: sum(math.log(values[target[b], share[b]] / whole) for b in found_in(text)) for i, text in docs}


def test_log_weights_and_the_kept_rows_match_plain_numbers(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(200)]
    docs = [(i, " ".join(rng.choices(vocabulary[:150] if i % 3 else vocabulary[50:], k=rng.randint(1, 60)))) for i in range(150)]
    good = {i for i in range(0, 150, 2) if i % 3}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, int(i in good), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    rows = resampling.resample(d, b, share=0.4).collect()
    want = plain_log_weights(docs, good)
    for r in rows:
        assert r["log_weight"] == pytest.approx(want[r["doc_id"]], rel=1e-7, abs=1e-7)
    order = sorted(rows, key=lambda r: -r["sample_key"])
    assert {r["doc_id"] for r in order[:60]} == {r["doc_id"] for r in rows if r["kept"]}
    assert len({r["log_weight"] for r in rows}) > 140


def test_resampling_of_edge_rows(spark):
    df = edge.documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 0, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = resampling.resample(df, labels).collect()
    assert len(rows) == df.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["log_weight"] is None and not by[3]["kept"]
    assert by[4]["log_weight"] is None and not by[5]["kept"]
    assert resampling.resample(df.limit(0), labels).count() == 0
    none = resampling.resample(df, labels.limit(0))
    assert none.count() == df.count()


def test_kth_largest(spark):
    df = spark.range(10_000).selectExpr("CAST(IF(id < 4000, 7.5, id / 3.0) AS DOUBLE) AS v")
    values = sorted((r["v"] for r in df.collect()), reverse=True)
    for k in (1, 2, 777, 5999, 6000, 9000, 10_000):
        assert resampling.kth_largest(df, "v", k) == values[k - 1]
    assert resampling.kth_largest(df, "v", 0) is None


def test_queries_run_on_the_given_tables(spark):
    for name in ("op6_resampling", "op8_html", "op9_language"):
        assert queries.REGISTRY[name](spark, "/root/testdata/sf0.001").count() > 0


def test_text_is_the_article_of_the_given_pages(spark):
    import re
    from html import unescape

    pages = queries.table(spark, "/root/testdata/sf0.001", "pages")
    got = {r["page_id"]: r["text"] for r in queries.op8_html(spark, "/root/testdata/sf0.001").collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.DOTALL)
        inside = re.sub(r"<[^>]*\Z", "", article[1] if article else "")
        parts = re.split(r"</?(?:p|h1)[^>]*>", inside.replace("<br>", " "))
        texts = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert got[r["page_id"]] == "\n".join(t for t in texts if t)
