"""The corpus operators against brute force, SQL and round trips, on small tables."""

import html
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from widelathe.llm import components, decontaminate, exact_dedup, html_extract, mixing, quality, queries, sharding, simhash, token_output, toxicity, url_filter
from widelathe.llm.common import held_out

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- SQL


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, sql = queries.queries()[name](spark, SF), duck.sql(queries.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(sql.columns)
    assert sorted(str(tuple(r[c] for c in names)) for r in df.collect()) == sorted(map(str, sql.select(*names).fetchall()))


# --- HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li>menu</li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p><b>One<br>two <i>in</i>line<p>Three&nbsp;<a href="#">four</a></p><div class="ad">Buy</div><ul><li>x</li><li>y</ul>
<section class="comments"><p>Reader says</p></section><form><p>Mail</p></form></article><aside>Side</aside><footer>&copy; foot</footer></body></html>"""


def test_main_text():
    assert [t for t, own, _ in html_extract.blocks_of(PAGE) if own] == ["Head & line", "One two inline", "Three four", "x", "y"]
    assert html_extract.blocks_of(None) == [] and html_extract.blocks_of("") == []
    assert [t for t, own, _ in html_extract.blocks_of("<p>a<p>b</div>c") if own] == ["a", "b", "c"]
    assert [t for t, own, _ in html_extract.blocks_of("<article><p>cut &am") if own] == ["cut &am"]


def test_names_inside_an_article():
    own = lambda page: [t for t, kept, _ in html_extract.blocks_of(page) if kept]
    assert own('<div class="post"><p class="share-price">Price</p><p>Text of the post</p></div>') == ["Price", "Text of the post"]
    assert own('<article><div class="login-tutorial"><p>How to</p></div><p>More</p></article>') == ["How to", "More"]
    assert own('<article><p>Text</p><div class="comment-list"><p>Reader</p></div><div class="ad box"><p>Buy</p></div></article>') == ["Text"]
    assert own("<p>A &<b>amp; B</b> &lt;i&gt;</p>") == ["A &amp; B <i>"]
    began = time.time()
    own("<xmp>" * 20_000 + "x")
    assert time.time() - began < 1


def made_page(rng):
    """A random page and the blocks of its main text, as they were put in."""
    word = lambda: rng.choice(["alpha", "beta &amp; co", "gamma&nbsp;x", "<b>bold</b>", "un<i>brok</i>en", "caf&eacute;", "a\n  b"])
    plain = lambda t: " ".join(html.unescape(re.sub("<[^>]*>", "", t)).split())
    wanted = []

    def line():
        return " ".join(word() for _ in range(rng.randint(3, 12)))

    def put(tag):
        t = line()
        wanted.append(plain(t))
        return f"<{tag}>{t}</{tag}>"

    def content(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 3:
            return put(rng.choice(["p", "h2", "blockquote"]))
        if kind == 3:
            return "<ul>" + "".join(put("li") for _ in range(rng.randint(1, 3))) + "</ul>"
        if kind == 4:
            return f'<div class="{rng.choice(["part", "lead", "body-text"])}">' + "".join(content(depth - 1) for _ in range(rng.randint(1, 3))) + "</div>"
        return rng.choice(['<div class="ad">{}</div>', '<section id="comments"><p>{}</p></section>', "<form><p>{}</p></form>", "<aside>{}</aside>", "<script>{}</script>", "<!-- {} -->"]).format(line())

    around = lambda: "".join(rng.choice(["<nav><ul><li>{}</li></ul></nav>", '<div class="cookie-notice"><p>{}</p></div>', "<header><h1>{}</h1></header>", "<footer><p>{}</p></footer>", '<div class="sidebar"><ul><li>{}</li></ul></div>', "<style>{}</style>"]).format(line()) for _ in range(rng.randrange(4)))
    tag = rng.choice(["article", "main"])
    before = around()
    body = "".join(content(2) for _ in range(rng.randint(2, 6)))
    return f"<!DOCTYPE html><html><head><title>{line()}</title></head><body>{before}<div class='wrap'><{tag}>{body}</{tag}></div>{around()}</body></html>", wanted


def test_made_pages_give_what_was_put_in(spark):
    rng = random.Random(4)
    pages = [(k, f"http://h{k % 3}.example/{k}", *made_page(rng)) for k in range(300)]
    df = spark.createDataFrame([p[:3] for p in pages], "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {k: "\n\n".join(wanted) for k, _, _, wanted in pages}


@pytest.mark.parametrize(
    "page",
    [
        '<div class="post"><p>Main text of the post</p></div><section id="comments"><article><p>Reader says so much more than the post</p></article></section>',
        '<article><p>Tease</p></article><div><p>Main text of the post</p><p>and a good deal more of it, so that the other is little</p></div>',
        '<div class="content-sidebar-wrap"><article><p>Main text of the post</p></article><div class="sidebar"><p>Side</p></div></div>',
        '<div class="has-sidebar"><p>Main text of the post</p></div>',
        '<div class="post-with-comments"><main><p>Main text of the post</p></main></div><div class="comment-list"><p>Reader says so much more than the post</p></div>',
        '<div id="no-sidebar"><div>Main text of the post</div></div>',
    ],
)
def test_wrappers_and_comments_do_not_hide_the_article(spark, page):
    own = [t for t, own, _ in html_extract.blocks_of(page) if own]
    assert "Main text of the post" in own and not {"Side", "Reader says so much more than the post"} & set(own)
    got = html_extract.extract(spark.createDataFrame([(1, None, page)], "page_id long, url string, html string")).head()
    assert got["text"].split("\n\n") == own


def test_templates_are_told_by_their_recurrence(spark):
    page = lambda k: f"<body><div>Every page says this</div><div><p>Own text {k}</p></div><p>Plain {k}</p></body>"
    data = [(k, f"http://h.example/{k}", page(k)) for k in range(30)] + [(90, "http://other.example/", page(90)), (91, None, None)]
    got = {r["page_id"]: r for r in html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got[3]["text"] == "Own text 3\n\nPlain 3" and got[3]["n_template"] == 1
    assert got[90]["text"] == "Every page says this\n\nOwn text 90\n\nPlain 90"
    assert (got[91]["text"], got[91]["n_chars"]) == ("", 0)


def test_copies_and_lists_of_articles_are_no_template(spark):
    item = "<ul><li>Size</li><li>Weight</li></ul>"
    data = [(k, f"http://h.example/{k}", "<div><p>One article in print views</p></div>") for k in range(6)]
    data += [(10 + k, f"http://h.example/a{k}", f"<article><p>Text {k}</p>{item}</article>") for k in range(6)]
    data += [(20 + k, f"http://h.example/b{k}", f"<article><div>Long body of an article, reprinted</div><p>{k}</p></article>") for k in range(6)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got[0] == "One article in print views" and got[10] == "Text 0\n\nSize\n\nWeight" and got[20] == "Long body of an article, reprinted\n\n0"


def test_quotes_open_values_only(spark):
    own = lambda page: [t for t, own, _ in html_extract.blocks_of(page) if own]
    assert own("<p class=it's>First para.</p><p>Second isn't lost.</p><p>Third.</p>") == ["First para.", "Second isn't lost.", "Third."]
    assert own("<p title='a > b' class=\"x>y\">One</p><p data-x= role=menu>Two</p><p title=\"x class=ad\">Three</p><p class=\"open>Four</p>") == ["One", "Two", "Three", "Four"]


def test_deep_pages_take_time_in_proportion():
    import time

    page = lambda n: "".join(f"<div class=sidebar-x><p>t{k}</p>" for k in range(n)) + "</div>" * n
    began = time.time()
    blocks, containers, _ = html_extract.parse(page(8000))
    assert len(blocks) == len(containers) == 8000 and time.time() - began < 5
    assert [p for _, p in containers] == list(range(-1, 7999))


def test_templates_against_brute_force(spark):
    rng = random.Random(21)
    parts = [f"<div><p>part {k}</p>{'<div>inner %d</div>' % (k % 3) if k % 2 else ''}</div>" for k in range(8)]
    data = []
    for k in range(60):
        picked = rng.sample(parts, 3)
        data.append((k, f"http://h{k % 2}.example/{k}", "".join(picked) + f"<p>Own {k // 2 if k < 10 else k} and more words of it</p>"))
    data += data[:5]  # repeated rows
    pages = {}
    for _, url, page in data:
        blocks, containers, _ = html_extract.parse(page)
        host = url.split("/")[2]
        pages[url] = host, blocks, containers, "\n".join(t for t, own, _, _ in blocks if own)
    counts = Counter()
    for host, h, _ in {(host, h, text) for host, _, c, text in pages.values() for h, _ in c if h is not None}:
        counts[host, h] += 1
    wanted, changed = {}, 0
    for url, (host, blocks, containers, _) in pages.items():
        kept = []
        for t, own, _, at in blocks:
            hit = False
            while at >= 0:
                hit |= counts[host, containers[at][0]] >= 12
                at = containers[at][1]
            if own and not hit:
                kept.append(t)
        wanted[url] = "\n\n".join(kept)
        changed += len(kept) < len(blocks)
    got = html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string"), min_pages=12).collect()
    assert len(got) == 65 and {r["url"]: r["text"] for r in got} == wanted and 0 < changed


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_shapes_that_recur_are_template(spark, monkeypatch, broadcast):
    monkeypatch.setattr(html_extract, "BROADCAST_SUBTREES", broadcast)
    # a menu and a box that are filled anew on each page, under names that say nothing; content in plain containers and, on host two, mostly in named ones
    box = lambda k: f'<div class="zz{" x" * (k % 2)}"><a>Offer {k}</a><a>More {k * 7}</a></div>'
    one = lambda k: f'{box(2 * k)}<div><p>Story {k} is told here at some length</p><p>and goes on {k}</p></div><section><p>Then it ends {k}</p></section>'
    two = lambda k: "".join(f'<div class="para"><p>Paragraph {j} of story {k} is here</p></div>' for j in range(4))
    data = [(k, f"http://one.example/{k}", one(k)) for k in range(30)] + [(100 + k, f"http://two.example/{k}", two(k)) for k in range(30)] + [(200 + k, f"http://few.example/{k}", one(k)) for k in range(9)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got[3] == "Story 3 is told here at some length\n\nand goes on 3\n\nThen it ends 3"
    assert got[103] == "\n\n".join(f"Paragraph {j} of story 3 is here" for j in range(4))
    assert "Offer" in got[203]  # too few pages to tell
    alone = {r["page_id"]: r["text"] for r in html_extract.extract(df, by_count=False).collect()}
    assert "Offer" in alone[3]


def test_the_share_of_a_large_host_does_not_grow_with_it(spark):
    data = [(k, f"http://h.example/{k}", ("<div>Notice</div>" if k < 10 else "") + f"<p>Own text {k}</p>") for k in range(40)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages, min_pages=2, min_share=0.5).collect()}
    assert got == {k: f"Own text {k}" for k in range(40)}


def test_templates_joined_by_salt_are_the_same(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    wanted = sorted(html_extract.extract(pages, min_pages=2).collect())
    monkeypatch.setattr(html_extract, "BROADCAST_SUBTREES", 0)
    assert sorted(html_extract.extract(pages, min_pages=2).collect()) == wanted


# --- SimHash


def brute_print(text, k=3):
    w = [x.translate(UPPER) for x in spaced(text)]
    runs = [" ".join(w[j : j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark, documents):
    got = {r["doc_id"]: r for r in simhash.simhash_components(documents).collect()}
    prints = {r["doc_id"]: brute_print(r["text"]) for r in documents.collect()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {i: r["component_id"] for i, r in got.items()} == groups_of(prints, near)


@pytest.mark.parametrize("tau", [1, 2])
@pytest.mark.parametrize("paired", [256, 1])
def test_links_of_crowded_fingerprints(spark, monkeypatch, paired, tau):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            prints.add(x)
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= tau]
    signed = lambda x: x - ((x >> 63) << 64)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    linked = {(a % 2**64, b % 2**64) for a, b in simhash.links(df, tau).collect()}
    assert all((a ^ b).bit_count() <= tau for a, b in linked)
    assert groups_of(prints, linked) == groups_of(prints, near)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (5, 5), (100, 101)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, k=5):
    w = [x.translate(UPPER) for x in spaced(text)]
    return {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()


def test_one_of_each_group_of_near_copies_stays(spark):
    rng = random.Random(3)
    data = []
    for g in range(15):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        data.append((10 * g, " ".join(base)))
        for c in range(1, 5):
            copy = list(base)
            for at in rng.sample(range(300), (0, 1, 3, 40)[c - 1]):
                copy[at] = "changed"
            data.append((10 * g + c, " ".join(copy)))
    sets = {i: shingles(t) for i, t in data}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = sorted(set(groups_of(sets, near).values()))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == wanted


def test_near_copies_among_texts_that_share_a_long_passage(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(200))
    data = []
    for g in range(350):
        own = [f"w{rng.randrange(10**6)}" for _ in range(30)]
        data.append((2 * g, passage + " " + " ".join(own)))
        keep = rng.choice((12, 14, 16))
        data.append((2 * g + 1, passage + " " + " ".join(own[:keep] + [f"w{rng.randrange(10**6)}" for _ in range(30 - keep)])))
    sets = {i: shingles(t) for i, t in data}
    near = [(a, b) for a in sets for b in range(a + 1, len(data)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = sorted(set(groups_of(sets, near).values()))
    assert 0 < len(near) < 400
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == wanted


def test_near_copies_that_share_no_band(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BANDS", 1)
    rng = random.Random(4)
    data = []
    for g in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        data.append((2 * g, " ".join(base)))
        data.append((2 * g + 1, " ".join(base[: rng.choice((88, 90, 91))] + [f"w{rng.randrange(10**6)}" for _ in range(9)])))
    sets = {i: shingles(t) for i, t in data}
    near = [(a, b) for a in sets for b in range(a + 1, len(data)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == sorted(set(groups_of(sets, near).values()))


def test_bitmaps_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(6)
    for n in (1, 30, 300, 3000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.append(a[: n - n // 7], rng.integers(0, 2**64, n // 3, dtype=np.uint64)))
        apart = len(np.setxor1d(a, b))
        x, y = simhash.parity_bits(a, 1024), simhash.parity_bits(b, 1024)
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= apart
        x, y = simhash.wide_bits(a), simhash.wide_bits(b)
        size = min(len(x), len(y))
        assert np.bitwise_count((simhash.folded(x, size) ^ simhash.folded(y, size)).view(np.uint64)).sum() <= apart
        assert not size or (simhash.folded(x, 16) == simhash.parity_bits(a, 1024)).all()


def test_long_near_copies_and_repeated_rows(spark):
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(400)]
    data = [(None, None), (5, ""), (6, None), (7, "one two"), (8, "One two"), (9, "one two")]
    for g in range(12):
        base = passage + [f"w{rng.randrange(10**6)}" for _ in range(1200)]
        copy = base[:1500] + [f"w{rng.randrange(10**6)}" for _ in range((60, 120, 200)[g % 3])]
        data += [(100 + 2 * g, " ".join(base)), (101 + 2 * g, " ".join(copy)), (100 + 2 * g, " ".join(base))]
    sets = {(i, k): shingles(t) for k, (i, t) in enumerate(data)}
    same = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    order = sorted(sets, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    place = {x: n for n, x in enumerate(order)}
    groups = groups_of(range(len(order)), [(place[a], place[b]) for a in sets for b in sets if place[a] < place[b] and same(a, b)])
    wanted = sorted(order[r][0] for r in set(groups.values()))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == wanted
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_similar_sets_share_a_prefix():
    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 5, 6, 30, 301):
        for _ in range(40):
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            b = np.append(a[: max(1, n - int(rng.integers(0, n // 5 + 1)))], rng.integers(0, 2**64, int(rng.integers(0, n // 5 + 1)), dtype=np.uint64))
            both = len(np.intersect1d(a, b))
            times = np.zeros(1 << simhash.COUNTER_BITS, dtype=np.int64)
            np.add.at(times, simhash.counters(rng.choice(a, n // 2)), rng.integers(1, 9, n // 2))
            x, y = (simhash.prefix_of(c, 0.8, times) for c in (a, b))
            assert len(x) == n // 5 + 1
            assert both < 0.8 * (len(a) + len(b) - both) or set(x) & set(y)


def test_histogram_counts_the_shingles_of_all_texts(spark, documents):
    data = [(r["text"],) for r in documents.collect()] + [(None,), ("",), ("a b",)]
    wanted = np.zeros(1 << simhash.COUNTER_BITS, dtype=np.int64)
    for (text,) in data:
        for x in shingles(text):
            wanted[xxhash.xxh64_intdigest(" ".join(x), 42) >> (64 - simhash.COUNTER_BITS)] += 1
    df = spark.createDataFrame(data, "text string").repartition(3)
    assert (simhash._histogram(df, "text", 5) == wanted).all()
    assert not simhash._histogram(df.limit(0), "text", 5).any()


# --- Toxicity


def brute_segments(s):
    """Maximal segments by the recursive definition: the best one, then those left and right of it."""
    best = max(((sum(s[a:b]), -(b - a), -a) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-12:
        return []
    a = -best[2]
    b = a - best[1]
    return brute_segments(s[:a]) + [(a, b)] + [(x + b, y + b) for x, y in brute_segments(s[b:])]


def test_segments_are_the_maximal_ones():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.choice([-3.0, -1.0, -0.5, 1.25, 2.0, 5.0]) + rng.random() / 1000 for _ in range(rng.randint(0, 14))]
        found = toxicity.segments(s)
        assert [(a, b) for a, b, _ in found] == brute_segments(s)
        assert all(x == pytest.approx(sum(s[a:b])) for a, b, x in found)
    scores, gap = {3: 4.0, 5: 2.0, 30: 1.0}, -0.5
    dense = [scores.get(k, gap) for k in range(40)]
    assert [x[:2] for x in toxicity.segments(list(scores.values()), list(scores), gap)] == [x[:2] for x in toxicity.segments(dense)]


def area_under(y, s):
    pairs = [(a > b) + (a == b) / 2 for a, p in zip(s, y, strict=True) if p for b, q in zip(s, y, strict=True) if not q]
    return sum(pairs) / len(pairs)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_toxicity_of_held_out_rows(small):
    docs, labels = small
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("toxic", "score", "predicted").collect()
    assert area_under([r[0] for r in out], [r[1] for r in out]) > 0.85
    assert all(0 <= r[1] <= 1 and r[2] == (r[1] >= 0.7) for r in out)


def test_toxic_passages_lie_in_the_text(spark, small):
    model = toxicity.Model({b"vile": (6.0, 9.0), b"foul*": (6.0, 9.0)}, -0.3, 1.0, 0.01, (-3.0, 2.0, 2.0))
    df = spark.createDataFrame([("Così, là: the vile, foulness here. " + "and so on " * 50 + "a Vile one", 1), ("clean text", 2), (None, 3)], "text string, score int")
    first, second, third = toxicity.score(df, model, spans=True).collect()
    assert [first["text"][p["start"] : p["end"]] for p in first["passages"]] == ["vile, foulness", "Vile"]
    assert second["passages"] == [] and third["passages"] == [] and third["score"] == second["score"] < 0.1 < first["score"]


def test_no_labels_give_one_score(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.score(documents, toxicity.fit(documents, none)).select("score").distinct().count() == 1
    assert quality.score(documents, quality.fit(documents, none)).select("score").distinct().count() == 1


# --- Quality


def test_quality_of_held_out_rows(small):
    docs, labels = small
    out = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("quality", "score").collect()
    assert area_under([r[0] for r in out], [r[1] for r in out]) > 0.95


def test_isotonic_never_falls():
    x, y = quality.isotonic(np.arange(6.0), np.array([0, 2, 1, 5, 4, 9.0]), np.full(6, 10.0))
    assert len(x) == 4 and (np.diff(y) >= 0).all() and y[1] == pytest.approx(3.5 / 21)


# --- Sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_and_inverse(n):
    p = sharding.Permutation(n, 9)
    out = p.apply(np.arange(n))
    assert sorted(out) == list(range(n)) and list(p.invert(out)) == list(range(n))
    for row in range(0, n, 97):
        shard, slot = sharding.place_of(row, n_rows=n, n_shards=7, seed=9)
        assert sharding.row_at(shard, slot, n_rows=n, n_shards=7, seed=9) == row


def test_shards(spark, documents):
    cut = documents.select("doc_id", "text")
    out = sharding.assign_shards(cut, 7, seed=4).collect()
    sizes = Counter(r["shard"] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(out) == documents.count()
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    assert all(sharding.place_of(r["row_number"], n_rows=len(out), n_shards=7, seed=4) == (r["shard"], r["slot"]) for r in out)
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.assign_shards(cut.repartition(9), 7, seed=4).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in out}


# --- URLs


def test_longest_rule_wins_also_when_joined_by_shuffle(spark, monkeypatch):
    urls = ["http://a.com/en/7x?q", "HTTP://A.COM/en/1", "http://example.com/en/712#f", "http://xexample.com/en/7", "com/en/", None, "http://com/en", "http://b.net", "x://c.d.net/de/"]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id int, url string")
    rules = spark.createDataFrame([("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), (None, "/x", "block"), ("com", "/en/", "allow")], "host string, path string, verdict string")
    wanted = ["com/en/ block", "com/en/ block", "example.com/en/7 allow", "com/en/ block", "None allow", "None allow", "None allow", "None allow", "net/de/ block"]
    for limit in (1000, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
        got = {r["page_id"]: f"{r['rule']} {r['verdict']}" for r in url_filter.filter_urls(pages, rules).collect()}
        assert [got[k] for k in range(len(urls))] == wanted
    assert url_filter.filter_urls(pages, rules.limit(0)).where("verdict = 'allow' AND rule IS NULL").count() == len(urls)


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("concat('host', id, '/p') AS key")
    bloom = url_filter.build_filter(keys, 5000)
    assert all(f"host{k}/p".encode() in bloom for k in range(5000))
    assert sum(f"other{k}".encode() in bloom for k in range(5000)) < 100
    crowded = url_filter.build_filter(keys, 5000, most_bytes=64)
    assert crowded.blocks == 1 and all(f"host{k}/p".encode() in crowded for k in range(0, 5000, 50))


# --- Mixing


def test_mix_meets_its_targets(spark, documents):
    out = mixing.mix(documents).collect()
    size = Counter()
    for r in out:
        assert r["size"] == len(spaced(r["text"])) and r["taken"] == r["size"] * r["rounds"] <= 3 * r["size"]
        size[r["source"]] += r["size"]
    names = sorted(size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, total = set(), sum(size.values())
    while True:
        level = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if weight[s] * level > 3 * size[s]}
        if more <= full:
            break
        full |= more
    target = {s: 3 * size[s] if s in full else weight[s] * level for s in names}
    for s in names:
        own = [r for r in out if r["source"] == s]
        assert own[0]["target"] == pytest.approx(target[s]) and own[0]["source_size"] == size[s]
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own)
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(documents.repartition(5)).collect()} == {(r["doc_id"], r["taken"]) for r in out}


# --- Decontamination


def brute_scan(text, items, size=10):
    words = letters(text)
    hit, found = set(), set()
    for item, body in items:
        w = letters(body)
        n = min(size, len(w))
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(item)
    return len(words), len(hit), found - {None}


@pytest.mark.parametrize("block", [100_000, 2])
def test_scan_in_one_and_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    items = [(1, "the cat sat on the mat and then it ran away fast"), (2, "Hello, WORLD"), (10, "x"), (3, ""), (4, None), (None, "only words"), (2, "Hello, WORLD")]
    texts = ["… the CAT sat; on the mat and then it ran away fast! hello world", "hello worlds x xx", "è x, only words; hello", "", None, "cat sat on the mat and then it ran away fast the cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    for r in decontaminate.scan(docs, bench).collect():
        n, hit, found = brute_scan(r["text"], [(None if i is None else str(i), t) for i, t in items])
        assert (r["n_words"], r["n_hit"], r["items"], r["n_items"], r["contaminated"]) == (n, hit, sorted(found), len(found), hit > 0)
        assert sum(len(letters(r["text"][s["start"] : s["end"]])) for s in r["spans"]) == hit
    assert decontaminate.scan(docs, bench.limit(0)).where("contaminated").count() == 0


def test_blocks_are_loaded_once_while_they_are_kept(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 10)
    bench = spark.createDataFrame([(k, " ".join(f"w{k * 100 + j}" for j in range(14))) for k in range(7)], "item_id int, text string")
    folders = decontaminate.write_blocks(decontaminate.windows_of(bench, 10, "item_id", "text"))
    loaded, load = [], decontaminate.load_block
    monkeypatch.setattr(decontaminate, "load_block", lambda f: loaded.append(f) or load(f))
    decontaminate._kept.clear()
    for _ in range(10):  # batches
        for f in folders:
            decontaminate._block(f)
    assert sorted(loaded) == sorted(folders) and len(folders) == 4
    assert sum(len(decontaminate._block(f)) for f in folders) == 7 * 5


def test_ten_blocks_are_loaded_once_a_task(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 4)
    bench = spark.createDataFrame([(k, " ".join(f"w{k * 100 + j}" for j in range(14))) for k in range(8)], "item_id int, text string")
    folders = decontaminate.write_blocks(decontaminate.windows_of(bench, 10, "item_id", "text"))
    loaded, load = [], decontaminate.load_block
    monkeypatch.setattr(decontaminate, "load_block", lambda f: loaded.append(f) or load(f))
    decontaminate._kept.clear()
    texts = [[f"x w{k * 100 + 1} " + " ".join(f"w{k * 100 + j}" for j in range(2, 14)) for k in range(8)] + [None] for _ in range(10)]
    made = [r for part in decontaminate.scan_batches((pa.array(t) for t in texts), folders) for r in part.to_pylist()]
    assert len(folders) == 10 and sorted(loaded) == sorted(folders)
    assert [(r["n_hit"], r["items"]) for r in made] == ([(13, [str(k)]) for k in range(8)] + [(0, [])]) * 10
    # texts that don't fit together: the blocks that are still kept are met first
    loaded.clear()
    decontaminate._kept.clear()
    monkeypatch.setattr(decontaminate, "HELD_BYTES", 5 * sum(len(t or "") for t in texts[0]))
    again = [r for part in decontaminate.scan_batches((pa.array(t) for t in texts), folders) for r in part.to_pylist()]
    assert again == made and len(loaded) == 10 + 10 - decontaminate.KEPT_AUTOMATA


# --- Exact dedup


def test_new_texts_with_clashing_names(spark):
    names = "doc_id long, text string, lsm_digest int, lsm_body int, lsm_id int, known int, words int, hit int"
    stored = spark.createDataFrame([(1, "a b", *[0] * 6), (2, None, *[0] * 6)], names)
    rows = exact_dedup._rows(stored, ["doc_id"], "doc_id", "text", exact_dedup.digest(F.col("text"))).select("row.*")
    index = exact_dedup.DigestIndex(spark)
    index.flush(rows)
    later = spark.createDataFrame([(5, "ab", *[7] * 6), (6, "abc", *[7] * 6), (7, "", *[7] * 6)], names)
    got = exact_dedup.new_texts(index, later, stored)
    assert got.columns == later.columns and [tuple(r) for r in got.collect()] == [(6, "abc", *[7] * 6)]


def test_later_documents_meet_the_runs_through_filters(spark):
    stored = spark.createDataFrame([(k, f"text  number {k % 700}") for k in range(1000)] + [(None, None)], "doc_id long, text string")
    rows = exact_dedup._rows(stored, ["doc_id"], "doc_id", "text", exact_dedup.digest(F.col("text"))).select("row.*")
    index = exact_dedup.DigestIndex(spark)
    index.flush(rows.where("id < 500"))
    index.flush(rows.where("id >= 500 OR id IS NULL"), memtables=2)
    assert len(index.runs) == 3
    later = spark.createDataFrame([(5000 + k, f"textnumber{k}") for k in range(600, 2600)] + [(1, " "), (2, None)], "doc_id long, text string")
    asked = later.select(exact_dedup.digest(F.col("text")).alias("digest"))
    for run in index.runs:
        held = {r[0] for r in spark.read.parquet(run).select("digest").collect()}
        passed = [r[0] for r in index.may_hold(asked, run).collect()]
        true = [r[0] for r in asked.collect() if r[0] in held]
        assert set(true) <= set(passed) and len(passed) - len(true) < 400  # of 2,000, one in 16 or so
    wanted = sorted([5000 + k for k in range(700, 2600)])
    assert sorted(r["doc_id"] for r in exact_dedup.new_texts(index, later, stored).collect()) == wanted
    found = {r["digest"]: (r["best"]["id"], r["n"]) for r in index.lookup(asked).collect()}
    index.compact()
    assert len(index.runs) == 1 and found == {r["digest"]: (r["best"]["id"], r["n"]) for r in index.lookup(asked).collect()}
    assert exact_dedup.new_texts(index, later.limit(0), stored).count() == 0


def test_texts_decide_where_digests_collide(spark, documents):
    wanted = sorted(exact_dedup.exact_dedup(documents).collect())
    one_letter = lambda text: F.substring(exact_dedup.digest(text), 1, 1)
    assert sorted(exact_dedup.exact_dedup(documents, digest_of=one_letter).collect()) == wanted


def test_collisions_are_seen(spark):
    rows = spark.createDataFrame([(1, "k", 2, "aa", 1), (2, "k", 2, "aa", 2), (3, "k", 2, "ab", 3), (4, "m", 1, "a", 4), (5, "m", 1, "a", 5)], "id int, digest string, length int, body string, uid long")
    best = F.struct((-F.max("length")).alias("less"), F.lit(False).alias("none"), F.min("id").alias("id"), F.lit(0).alias("uid"))
    groups = rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("n"))
    assert [r[0] for r in exact_dedup._compare(rows, groups).collect()] == ["k"]


def test_longest_then_smallest_id_stays(spark, odd):
    out = exact_dedup.exact_dedup(odd, columns=["doc_id", "text"]).collect()
    by = {}
    for r in out:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)} for g in by.values())
    assert {r["keep_id"] for r in by["abcdef"]} == {7} and {r["keep_id"] for r in by[""]} == {4}


# --- Token output


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_encoder_is_the_library(documents):
    path, library = tokenizer()
    texts = [r["text"] for r in documents.collect()] + ["", " ", "a\t b", "a\u00a0 b  c", "x\x1c y", "don't  stop<|endoftext|> now", "\n\n a \n", "a.b,c'd's #x", "²ab, Ⅷ. œuvre, ŝ,", "a,,  b\r\n c", "日本語, テスト", "e\u0301a,b"]
    made = token_output.Encoder(path).encode(texts)
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in made] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_shards_and_keyed_reads(spark, odd, tmp_path):
    path, library = tokenizer()
    rows = odd.select("doc_id", "text").collect()
    out = token_output.token_table(odd, path, f"file://{tmp_path}/t", shards=3).orderBy("start").collect()
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    assert [r["doc_id"] for r in out] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in out:
        ids = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts[r["doc_id"]]]
        crcs = {(len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for x in ids}
        assert r["start"] == at and (r["n_tokens"], r["ids_crc32"]) in crcs
        at += r["n_tokens"]
    shards = [token_output.Shard(f.read_bytes()) for f in sorted((tmp_path / "t").glob("*.tids"))]
    assert [s.get(1).tolist() for s in shards if s.get(1) is not None] == [library.encode("a b c d e f", add_special_tokens=False).ids + [0]]
    assert all(s.get(12345) is None for s in shards)
    assert token_output.token_table(odd.limit(0), path).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(2).integers(-(2**62), 2**62, 5000)).astype("<i8")
    assert sorted(token_output.PerfectHash.build(keys).slots(keys)) == list(range(len(keys)))


# --- Odd rows, empty tables, clashing names


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, odd, empty):
    docs = odd.limit(0) if empty else odd
    n, bench = docs.count(), spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    outs = {
        "simhash": simhash.simhash_components(docs, columns=docs.columns),
        "toxicity": toxicity.score(docs, toxicity.fit(docs, labels), spans=True),
        "quality": quality.score(docs, quality.fit(docs, labels)),
        "sharding": sharding.assign_shards(docs, 3),
        "mixing": mixing.mix(docs),
        "scan": decontaminate.scan(docs, bench),
        "exact": exact_dedup.exact_dedup(docs, columns=docs.columns),
    }
    for name, out in outs.items():
        assert out.count() == n, name
        assert len({c.lower() for c in out.columns}) == len(out.columns), name
    assert simhash.keep_one(docs).count() == (0 if empty else 4)
    if not empty:
        zero = outs["simhash"].where("text IS NULL OR trim(text) = ''").select("fingerprint").distinct().collect()
        assert [r[0] for r in zero][0] == "0" * 16


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, "<p>a</p>", 0, 0, 0), (None, "", None, 0, 0, 0), (1, None, "<p>a</p>", 0, 0, 0)], "page_id long, url string, html string, text int, host int, rule int")
    rules = spark.createDataFrame([("h", "/", "block")], "host string, path string, verdict string")
    for df in (pages, pages.limit(0)):
        assert html_extract.extract(df).count() == url_filter.filter_urls(df, rules).count() == df.count()


def test_keyed_reads_touch_few_bytes(spark, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(3 * k, f"text {k} " * (k % 50)) for k in range(400)] + [(None, "no key"), (9, "again")], "doc_id long, text string")
    folder = f"file://{tmp_path}/tids"
    token_output.write_shards(docs, path, folder, shards=5)
    whole = token_output.encoder(path)
    for key in (0, 3, 9, 300, 1197):
        k = key // 3
        ids = np.frombuffer(whole.encode([f"text {k} " * (k % 50)])[0], dtype=whole.dtype)
        assert token_output.lookup(spark, folder, key).tolist() == [*ids.tolist(), 0]
    assert token_output.lookup(spark, folder, 4) is None and token_output.lookup(spark, folder, 10**9) is None
    row = token_output.read_manifest(spark, folder).where("first_key <= 600 AND last_key >= 600").first()
    shard = token_output.ShardFile(folder, row["file"])
    head = shard.read
    ids = shard.get(600)
    assert shard.read - head == 4 + 4 + 4 + 8 + 16 + ids.nbytes and shard.source.size() > 20 * head


def test_chunks_make_the_ids_of_whole_texts():
    import public_tokenizers

    own = token_output.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    pieces = ["word", "Wort,", "è!", " ", "  ", "\n\n", "\t", "\u00a0", "\u2003", "'s", "123", "a.b", "…", "<|endoftext|>", "日本", "x;y", "#tag", "(é)"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert own.encode(texts) == [own.whole(t) for t in texts]
