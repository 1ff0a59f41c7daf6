import html
import random
import re
from collections import Counter

import pytest

from placewright.llm import html_text, pii, quality

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    parts = ["a.b@c.de", "@x.y", "a@b@c.d.e", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1.1", "1.2.3.4.5", "+1 (743) 555-3824", "+12", " ", "x", "é", "-", ".", "0001.2.3.4", "9" * 30, "4111-1111-1111-1111"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 300_000 + "a" * 300_000 + "@") == []


@pytest.mark.parametrize("block", [2_000_000, 1])
def test_terms_that_reveal_an_entity_go(spark, block):
    rng = random.Random(1)
    common = [f"word{c}" for c in "abcdefghij"]
    say = lambda *more: " ".join([rng.choice(common) for _ in range(8)] + list(more) + [rng.choice(common) for _ in range(8)])
    rows = [(i, say("Zanzibar", "kestrel", "jo@x.org")) for i in range(6)] + [(50, say("kestrel"))] + [(100 + i, say()) for i in range(80)]
    rows += [(300, None), (301, ""), (None, say("Zanzibar")), (7, say("+1 (743) 555-3824"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r.doc_id: r for r in pii.sanitise(docs, block=block).collect()}
    texts = dict(rows)
    for i in range(6):
        found = {texts[i][s.start : s.stop] for s in out[i].spans}
        assert found == {"Zanzibar", "kestrel", "jo@x.org"} and "Zanzibar" not in out[i].text and "[EMAIL]" in out[i].text and "[NAME]" in out[i].text
    assert "Zanzibar" not in out[None].text and "kestrel" not in out[50].text  # wherever they stand
    assert not any(out[100 + i].spans for i in range(80)) and out[300].text is None and out[301].text == ""
    report = {r.doc_id: r for r in pii.span_report(pii.sanitise(docs, block=block)).collect()}
    assert report[7].n_phone == 1 and report[3].n_email == 1 and report[3].n_term == 2


def test_a_name_beside_an_email_that_occurs_once_goes(spark):
    rng = random.Random(2)
    common = [f"word{c}" for c in "abcdefghij"]
    say = lambda *more: " ".join([rng.choice(common) for _ in range(8)] + list(more) + [rng.choice(common) for _ in range(8)])
    rows = [(1, say("Quillon", "jo@x.org")), (2, say("+1 (743) 555-3824", "Varga", "al@y.org"))] + [(100 + i, say()) for i in range(80)]
    out = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    texts = dict(rows)
    assert {texts[1][s.start : s.stop] for s in out[1].spans} == {"Quillon", "jo@x.org"} and "[NAME] [EMAIL]" in out[1].text
    assert {texts[2][s.start : s.stop] for s in out[2].spans} == {"+1 (743) 555-3824", "Varga", "al@y.org"}  # no parts of entities
    assert not any(out[100 + i].spans for i in range(80))


def test_terms_are_counted_by_different_texts_at_every_size(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") + "q" for _ in range(6)) + (" Quillon jo@x.org" if i == 0 else "") for i in range(40)]
    rows = [(i, t) for i, t in enumerate(texts * 3 + texts[:5] * 7 + [None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    words = {w.lower() for t in texts for w in re.findall("[A-Za-z]+", t)}
    keys = dict(zip(pii._hash(sorted(words)).tolist(), sorted(words)))
    terms = spark.createDataFrame([(k,) for k in keys], "term long")
    want = {w: sum(w in re.findall("[a-z]+", t.lower()) for t in set(texts)) for w in words}
    found = []
    for limit in (2_000_000, 1):
        monkeypatch.setattr(pii, "TERMS", limit)
        counted, n = pii.counted(docs)
        assert n == len(set(texts)) and {keys[r.term]: r.n for r in pii.term_frequencies(counted, terms).collect()} == want
        found.append(sorted((r.term, r.bits, r.entities) for r in pii.disclosing_terms(docs).collect()))
    assert found[0] == found[1] and pii._hash(["quillon"])[0] in {t for t, _, _ in found[0]}


def test_sanitise_awkward_rows(awkward, nothing):
    assert pii.sanitise(awkward).count() == awkward.count() and pii.sanitise(nothing).count() == 0


def test_probabilities_sum_to_one(spark):
    import numpy as np

    rng = random.Random(2)
    rows = [(" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 5))) for _ in range(200)), "en", i % 2) for i in range(6)]
    docs = spark.createDataFrame(rows, "text string, lang string, half int")
    alphabets = quality._alphabets(docs.select("text", "lang"))
    counts = quality.gram_counts(docs, alphabets).selectExpr("2 as model", "lang", "gram", "n").groupBy("model", "lang", "gram").sum("n").withColumnRenamed("sum(n)", "n")
    m = quality.Model(alphabets["en"])
    for table, df in zip((m.p, m.back), quality.kneser_ney(counts)):
        own = df.toPandas()
        for k, part in own.groupby("k"):
            m.put(table, int(k), part.iloc[:, 3].to_numpy(), part.iloc[:, 4].to_numpy())
    for context in ([0, 0, 0], [0, 0, 7], [7, 8, 9], [9, 9, 9], [60, 61, 62]):
        base = np.uint64((context[0] << 18) | (context[1] << 12) | (context[2] << 6))
        assert abs(np.exp(m.log_p(base | np.arange(64, dtype=np.uint64))).sum() - 1) < 1e-6


def test_classifier_keeps_good_and_drops_bad(spark, awkward, nothing):
    rng = random.Random(3)
    syllables = ["an", "ti", "re", "sho", "ber", "lum"]
    good = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))
    bad = lambda n: " ".join("".join(rng.choice("XQZ#%!7") for _ in range(5)) for _ in range(n))
    rows = [(i, good(rng.randint(40, 200)), "en") for i in range(200)] + [(1000 + i, bad(100), "en") for i in range(20)] + [(2000 + i, "same " * 150, "en") for i in range(5)]
    rows += [(3000, None, "en"), (3001, "", None), (3002, good(50), "xx"), (3003, "   ", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(0, 1, 0), (None, 1, 0), (1000, 0, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.drop_low_quality(docs, labels).collect()}
    assert len(kept & set(range(200))) >= 190 and not kept & set(range(1000, 1020)) and not kept & set(range(2000, 2005))
    assert {3000, 3001, 3002, 3003} <= kept
    assert quality.classify(nothing, labels).count() == 0 and quality.classify(docs, labels.limit(0)).where("_kept").count() == len(rows)
    out = quality.drop_low_quality(awkward, spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int"))
    assert out.columns == awkward.columns


def page(body, host="h.example"):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><div class='top'>{host} banner text</div>{body}<div class='legal'>All rights reserved by {host}</div></body></html>"


@pytest.mark.parametrize("limit", [10**6, 0])
def test_style_tree_removes_what_a_site_repeats(spark, nothing, limit):
    rows = [(i, f"https://h.example/{i}", page(f"<div class='body'><p>Story {i} begins &amp; goes on.</p><p>It ends at {i * i}.<br>Really.</div>")) for i in range(8)]
    rows += [(100, "https://alone.example/x", page("<p>Only page</p>", "alone")), (101, None, None), (102, "https://h.example/e", ""), (103, "https://k.example/a", "<article><header><h1>T</h1></header><nav>menu</nav><p>a <b>b<p>c &am")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = {r.page_id: r for r in html_text.extract(pages, limit=limit).collect()}
    for i in range(8):
        assert out[i].text == f"Story {i} begins & goes on.\nIt ends at {i * i}. Really."
        assert out[i].n_chars == len(out[i].text)
    assert out[100].text == "alone banner text\nOnly page\nAll rights reserved by alone"
    assert out[101].text == out[102].text == "" and out[103].text == "T\na b\nc &am"
    assert html_text.extract(nothing.selectExpr("doc_id as page_id", "text as url", "text as html"), limit=limit).count() == 0


def test_copies_of_an_article_stay(spark):
    text = "<article><h1>Same</h1><p>Same story</p><div class='comments'><p>no</p></div><form>x</form></article>"
    pages = spark.createDataFrame([(i, "https://c.example/", page(text)) for i in range(6)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(pages).collect()} == {"Same\nSame story"}


@pytest.mark.parametrize(
    "body",
    [
        "<body class='has-sidebar'><p>Text</p></body>",
        "<body class='sidebar'><p>Text</p></body>",
        "<body><div id='content' class='no-sidebar'><p>Text</p></div></body>",
        "<body><main class='search-results search'><p>Text</p></main></body>",
        "<body><div class='search'><article class='post comments-open'><p>Text</p></article></div></body>",
        "<body><div data-id='share' title=\"a class='share'\"><p>Text</p></div></body>",
        "<body><form action='/'><input><div><p>Text</p></div><label>Name</label><button>Go</button></form></body>",
        "<body><div class='share'><p>no</p></div><p>Text</p><form>no</form><ul class='x menu'><li>no</ul></body>",
    ],
)
def test_names_rule_out_no_content(body):
    assert [t for t, _, _ in html_text.Page(f"<html><head><title>t</title></head>{body}</html>", True).blocks] == ["Text"]


def test_many_open_names_cost_no_square():
    assert html_text.Page("<select>" + "<option>x" * 200_000 + "</select><p>Text", True).blocks == [("Text", "/p1", False)]


def test_copies_of_an_article_stay_without_article_tags(spark):
    tail = lambda n: "".join(f"<p>Line {i} of the long story.</p>" for i in range(n))
    frame = lambda i, body: page(f"<div class='body'>{body}</div><div class='day'>Day {i}</div>")
    rows = [(i, "https://c.example/", page(f"<div class='body'>{tail(9)}</div>", "c.example")) for i in range(6)]  # copies alone
    rows += [(10 + i, "https://d.example/", frame(i, tail(9))) for i in range(5)]  # in frames of their own, among others
    rows += [(20 + i, "https://d.example/", frame(20 + i, f"<p>Story {i}.</p>")) for i in range(20)]
    out = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    story = "\n".join(f"Line {i} of the long story." for i in range(9))
    assert all(story in out[i] for i in (*range(6), *range(10, 15)))
    assert all(out[20 + i] == f"Story {i}.\nDay {20 + i}" for i in range(20))  # what the site repeats goes still


def test_pages_of_the_test_tables_equal_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = Counter()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html or "", re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in re.split(r"</?(?:p|h1|h2|h3|li|ul|div|article)[^>]*>", inner[1] if inner else "")]
        want[r.page_id, "\n".join(b for b in blocks if b)] += 1
    assert Counter((r.page_id, r.text) for r in html_text.extract(pages).collect()) == want


def test_long_runs_of_digits_are_no_addresses(spark):
    texts = ["1.2.3." + "0" * 5000, "9" * 6000 + ".1.1.1", "0001.2.3.4"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_ip for r in pii.span_report(pii.sanitise(docs)).collect()} == {0: 1, 1: 0, 2: 1}


@pytest.mark.parametrize("inner,want", [
    ("<div class='header'><h1>Headline</h1></div><p>x</p>", ["Headline", "x"]),
    ("<section class='related'>Related work</section><p class='share'>Shares of X rose</p>", ["Related work", "Shares of X rose"]),
    ("<p>x</p><div class='comments'><p>First!</p></div><ul class='share'><li>Tell</li></ul><aside>Note</aside>", ["x"]),
    ("<p>x</p></section></b><p>y</p>", ["x", "y"]),
])
def test_words_rule_out_less_inside_an_article(inner, want):
    assert [t for t, _, _ in html_text.Page(f"<body><div class='header'>Site</div><section><article>{inner}</article></section></body>", True).blocks] == want


@pytest.mark.parametrize("source,want", [
    ("<b>" * 100_000 + "</x>" * 100_000 + "t", 1), ("<x><article>" + "<b>" * 100_000 + "</x>" * 100_000 + "t", 1), ("<div>" * 100_000 + "t", 1), ("<b>" * 50_000 + "<p></p>" * 50_000, 0),
    ("<b " * 300_000, 1), ("t<!-- " * 100_000, 1), ("<p>t<!-- > " + "a" * 100_000, 1)])
def test_long_and_deep_pages_take_time_in_proportion(source, want):
    import time

    start = time.process_time()
    page = html_text.Page(source, True)
    assert len(page.found) == want and time.process_time() - start < 5
    assert page.low(frozenset()) == set()


def test_tree_of_pages_without_an_article(spark):
    """Entropies by hand, and a branch that goes with all its content: pages repeat in full, and tie."""
    from math import log

    # a menu that all share, a line that two of four share, and text of each page's own; the fifth page is a copy of the first
    bodies = [f"<div id=top><p>Home</p></div><div id=mid><p>Deal {i // 2}</p></div><div id=own><p>Story {i}</p></div>" for i in range(4)]
    rows = [(i, "http://h.example/a", b) for i, b in enumerate([*bodies, bodies[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    tree = {r.node: r for r in html_text.style_tree(pages).collect()}
    page = html_text.Page(bodies[0], True)
    entropy = {text.split()[0]: tree[node].entropy for text, node, _ in page.found}
    assert entropy["Home"] == pytest.approx(0) and entropy["Story"] == pytest.approx(1) and entropy["Deal"] == pytest.approx(-2 * 0.5 * log(0.5) / log(4))
    assert {r.pages for r in tree.values()} == {4}
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {i: f"Deal {i % 4 // 2}\nStory {i % 4}" for i in range(5)}
    assert {r.page_id: r.text for r in html_text.extract(pages, threshold=0.5).collect()} == {i: f"Story {i % 4}" for i in range(5)}


def test_rare_characters_count_as_themselves(spark):
    """A language of 600 characters, some beyond U+FFFF: words of known pairs of them, and the same characters in other pairs."""
    rng = random.Random(4)
    chars = [chr(0x4E00 + i) for i in range(560)] + [chr(0x20000 + i) for i in range(40)]
    pairs = [a + b for a, b in zip(chars[::2], chars[1::2])]
    good = lambda: " ".join("".join(rng.choice(pairs) for _ in range(2)) for _ in range(150))
    bad = lambda: " ".join("".join(rng.choice(chars) for _ in range(4)) for _ in range(150))
    rows = [(i, good(), "zh") for i in range(200)] + [(1000 + i, bad(), "zh") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    kept = {i for i, r in found.items() if r._kept}
    assert len(kept & set(range(200))) >= 190 and not kept & set(range(1000, 1020))
    assert found[1000]._symbols == sum(len(w.encode("utf-16-le")) // 2 + 1 for w in dict(r[:2] for r in rows)[1000].split(" "))


def test_probabilities_of_wide_symbols_sum_to_one(spark):
    import numpy as np

    rng = random.Random(6)
    rows = [(" ".join("".join(chr(rng.choice([0, 0x41, 0xFFFF, 0x10FFFF, *range(0x9000, 0x9064)])) for _ in range(rng.randint(1, 5))) for _ in range(200)), "zh", 0) for _ in range(4)]
    docs = spark.createDataFrame(rows, "text string, lang string, half int")
    alphabets = quality._alphabets(docs.select("text", "lang"))
    assert alphabets == {"zh": None}
    counts = quality.gram_counts(docs, alphabets).selectExpr("2 as model", "lang", "gram", "n")
    m = quality.Model(None)
    for table, df in zip((m.p, m.back), quality.kneser_ney(counts, ["zh"])):
        for k, part in df.toPandas().groupby("k"):
            m.put(table, int(k), part.iloc[:, 3].to_numpy(), part.iloc[:, 4].to_numpy())
    seen = m.p[4][0]
    for base in [0, *(int(x) & ~0xFFFF for x in seen[[0, len(seen) // 2, -1]]), 0xFFFE_8FF7_0123_0000]:
        # the context's units stand above the last one, as in a seen n-gram of order 4
        assert abs(np.exp(m.log_p(np.uint64(base) | np.arange(2**16, dtype=np.uint64))).sum() - 1) < 1e-6
