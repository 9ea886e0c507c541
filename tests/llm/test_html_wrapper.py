"""Main text of pages whose parts are known."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from boxmill.llm import html_wrapper as hw

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<div class="ad">Buy {ad}</div><aside><p>Side</p></aside>{top}<article><header><h1>{title}</h1><p>By me</p></header>{body}<form><input name=q>Search</form></article>
<section id="comments"><article><p>Nice post {ad}</p></article></section><footer>&copy; us</footer></body></html>"""


def text(html):
    return "\n\n".join(t for _, t in hw.parse(html)[1])


def test_parts_that_are_not_the_article_are_left_out():
    html = PAGE.format(ad="now", top="", title="A &amp; B", body="<p>One <b>two</b>\n three&nbsp;four<p>Five<br>six<ul><li>seven<li>eight</ul><!-- no --><script>x</script>")
    assert text(html) == "A & B\n\nOne two three four\n\nFive six\n\nseven\n\neight"


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (None, ""),
        ("", ""),
        ("a < b", "a < b"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div><a>Home</a> <a>News</a></div><p>text", "text"),
        ("<div class=ad>x<article><p>y</article>", "y"),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\n\nb\n\nc\n\nd"),
        ("<p>x <!-- open", "x"),
        ("<p>x<script>open", "x"),
        ("<p title='a>b'>x</p>", "x"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"),
        ("<P>&lt;i&gt; &#233; &euro;</P></div></p>", "<i> é €"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<div class='page with-sidebar'><article><p>x</article></div>", "x"),
        ("<p>x<ol class=commentlist><li>y</ol><div id=footerLinks><p>z</div>", "x"),
        ("<div role=navigation>m</div><main><p>x</main>", "x"),
    ],
)
def test_odd_markup(html, expected):
    assert text(html) == expected


def nodes(tree):
    return [tree[2]] + [n for c in tree[1] for n in nodes(c)]


def test_skeletons_survive_writing():
    tree = hw.parse(PAGE.format(ad="x", top="<div id='box-7'></div>", title="t", body="<p>a"))[0]
    assert hw.read_back(hw.written(tree)) == tree


def best_matching(a, b):
    """Size of the best ordered matching, by trying all."""
    if a[0] != b[0]:
        return 0

    def rows(x, y):
        if not x or not y:
            return 0
        return max(rows(x[1:], y), rows(x, y[1:]), best_matching(x[0], y[0]) + rows(x[1:], y[1:]))

    return 1 + rows(a[1], b[1])


def test_alignment_against_all_matchings():
    r = random.Random(1)

    def tree(depth, count):
        node = [r.choice("ab") if depth else "r", [], count[0]]
        count[0] += 1
        if depth < 3:
            node[1] = [tree(depth + 1, count) for _ in range(r.randint(0, 3))]
        return node

    for _ in range(60):
        a, b = tree(0, [0]), tree(0, [0])
        pairs = hw.align(a, b)
        assert len(pairs) == best_matching(a, b)
        assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)


def test_what_stands_on_most_pages_of_a_host_is_template(spark):
    """Plain divs without telling names: only the comparison of pages finds the template."""
    page = lambda i, extra: f"<body><div>Welcome to us</div>{extra}<div><p>Story {i} begins.</p><p>Common line</p><p>It ends {i * 7}.</p></div><div>Call 555</div></body>"
    rows = [(i, f"http://a.example/{i}", page(i, "<table><tr><td>t" + str(i) + "</table>" if i % 3 == 0 else "")) for i in range(12)]
    rows += [(100 + i, "https://b.example/x", page(1, "")) for i in range(2)] + [(200, None, None), (201, "", "<p>x")]
    df = spark.createDataFrame([(*r, "z") for r in rows], f"{SCHEMA}, host string")
    for how in ({}, {"broadcast_bytes": 0}):
        got = {r.page_id: r for r in hw.extract_text(df, **how).collect()}
        assert len(got) == len(rows)
        assert got[1].text == "Story 1 begins.\n\nIt ends 7." and got[3].text == "t3\n\nStory 3 begins.\n\nIt ends 21."
        assert got[100].text.startswith("Welcome to us")  # two pages are no evidence
        assert (got[200].text, got[200].n_chars, got[201].text) == ("", 0, "x")
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert hw.extract_text(df.limit(0)).collect() == []


def test_every_page_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in hw.extract_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.limit(20).collect():
        assert "<" not in got[r.page_id].replace("< ", "") or "&lt;" in r.html
        assert got[r.page_id].split("\n\n")[0][:30] in " ".join(hw.unescape(r.html).split())


def test_copies_of_a_page_are_no_evidence(spark):
    """Copies count once, also where they differ outside the article or in the skeleton; so does what few pages have."""
    article = lambda i: f"<article><h1>Title {i}</h1><p>Story {i} begins.</p></article>"
    rows = [(i, "http://a.example/", article(1 if i < 6 else i) + ("<div>now</div>" * (i % 3) if i < 6 else "")) for i in range(10)]
    quote = lambda i: f"<div><p>Tale {i}.</p>" + (f"<blockquote>Said {i // 5}</blockquote>" if i < 9 else "") + f"<p>It ends {i}.</p></div><div>Call 555</div>"
    rows += [(100 + i, "http://b.example/", quote(0 if i < 5 else i)) for i in range(20)]
    parts = ["<p>One.</p>", "<p>Two.</p>", "<p>Three.</p>"]  # distinct pages that differ in nothing else
    rows += [(200 + i, "http://c.example/", "<article>" + "".join(x for j, x in enumerate(parts) if i >> j & 1) + "</article>") for i in range(1, 8)]
    got = {r.page_id: r for r in hw.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[200 + i].text for i in (1, 2, 7)] == ["One.", "Two.", "One.\n\nTwo.\n\nThree."]
    assert [got[i].text for i in range(10)] == [f"Title {j}\n\nStory {j} begins." for j in [1] * 6 + [6, 7, 8, 9]]
    assert got[100].text == "Tale 0.\n\nSaid 0\n\nIt ends 0." and got[119].text == "Tale 19.\n\nIt ends 19."


def test_every_layout_of_a_host_has_its_template(spark):
    """Two layouts that share no element, a part that the commonest skeleton lacks, and a host of skeletons that all differ."""
    layouts = ["<div>Welcome</div><div><p>Story {0}.</p></div>", "<section>Hello</section><section><p>Story {0}.</p></section><table><tr><td>Call 555</table>"]
    rows = [(i, "http://a.example/", "<body>" + layouts[i >= 9].format(i)) for i in range(16)]
    rows += [(100 + i, "http://b.example/", "<body><h2>Up</h2>" + ("<ul><li>Rate us</ul>" if i > 11 else "") + f"<p>Tale {i}.") for i in range(20)]
    rows += [(200 + i, "http://c.example/", "<body>" + f"<div class={'abcdefghi'[i] * 2}><p>Tale {i}.</div>" + ("<section><p>Rate us</section>" if i else "")) for i in range(9)]
    got = {r.page_id: r.text for r in hw.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(16)] == [f"Story {i}." for i in range(16)]
    assert [got[100 + i] for i in range(20)] == [f"Tale {i}." for i in range(20)]
    assert [got[200 + i] for i in range(9)] == [f"Tale {i}." for i in range(9)]


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<h1><a href='/x'>Title</a></h1><p>text", "Title\n\ntext"),
        ("<article><p>text<ol><li><a href=x>Source</a></ol><table><tr><td><a>cell</a></table></article>", "text\n\nSource\n\ncell"),
        ("<div><p>The whole text of the page.</p></div><article><p>Teaser</p></article>", "The whole text of the page.\n\nTeaser"),
        ("<p>Menu</p><article><p>The whole text of the page.</p></article>", "The whole text of the page."),
        ("<p>a</p><svg viewBox='0 0 1 1'/><p>b</p><svg><path d='x'/><text>no</text></svg><p>c<svg/>d", "a\n\nb\n\ncd"),
        ("<p>a<iframe src='x'/>b<iframe src=y>no</iframe>c<script src=x />no</script>", "abc"),
    ],
)
def test_text_of_the_article_is_kept(html, expected):
    assert text(html) == expected


def odd_host(k):
    """Seven pages of a layout of its own, whose tags and classes tell nothing, and their whole main texts."""
    r = random.Random(k)
    words = [a + b for a in "brastekomi" for b in ("lan", "dor", "vik", "sum", "tep")]
    say = lambda n: " ".join(r.choice(words) for _ in range(n)).capitalize() + "."
    tag, names = r.choice(["div", "section"]), {p: r.choice("qxz") * n for n, p in enumerate(("menu", "advert", "banner", "side"), 1)}
    wrap = lambda part, inner: f'<{tag} class="{names[part]}">{inner}</{tag}>'
    links = lambda n: "".join(f'<li><a href="/{r.random()}">{r.choice(words)}</a>' for _ in range(n))
    parts = r.sample(["menu", "advert", "banner", "side"], r.randint(2, 4))
    pages = []
    for i in range(7):
        blocks = [("h1", say(5))] + [("p", say(r.randint(30, 60))) for _ in range(r.randint(2, 4))]
        extra = r.choice(["ul", "table", "quote", "link", "same", "none"])
        inner = "".join(f"<{t}>{x}</{t}>" for t, x in blocks)
        text = [x for _, x in blocks]
        if extra == "ul":
            rows = [say(6) for _ in range(3)]
            inner, text = inner + "<ul>" + "".join(f"<li>{x}" for x in rows) + "</ul>", text + rows
        elif extra == "table":
            cells = [say(2) for _ in range(4)]
            inner, text = inner + f"<table><tr><td>{cells[0]}<td>{cells[1]}<tr><td>{cells[2]}<td>{cells[3]}</table>", text + cells
        elif extra == "quote":
            x = say(20)
            inner, text = inner + f"<blockquote>{x}</blockquote>", text + [x]
        elif extra == "link":
            x = say(7)
            inner, text = inner + f"<p><a href=/y>{x}</a></p>", text + [x]
        if k % 3 == 0:  # a heading that all pages share, with a text of each
            x = say(12)
            inner, text = inner + f"<h2>Ingredients</h2><p>{x}</p>", text + ["Ingredients", x]
        around = {"menu": f"<ul>{links(5)}</ul>", "advert": say(4), "banner": "Everything must go today", "side": f"<p>{say(3)}</p><ul>{links(4)}</ul>"}
        before, after = ([wrap(p, around[p]) for p in parts[n::2]] for n in (0, 1))
        cls = ["share-price", "legal-news", "ad-hoc", "m" + str(k)][k % 4]
        pages.append((100 * k + i, f"http://h{k}.example/{i}", f"<html><body>{''.join(before)}<div class='{cls}'>{inner}</div>{''.join(after)}<div>&copy; h{k} {say(3)}</div></body></html>", "\n\n".join(text)))
    return pages


def test_whole_texts_of_thirty_odd_layouts(spark):
    """No tag or name tells the parts apart: the comparison of a host's pages has to."""
    rows = [p for k in range(1, 31) for p in odd_host(k)]
    got = {r.page_id: r for r in hw.extract_text(spark.createDataFrame([p[:3] for p in rows], SCHEMA)).collect()}
    wrong = [p[0] for p in rows if got[p[0]].text != p[3]]
    assert not wrong, (wrong, got[wrong[0]].text, [p[3] for p in rows if p[0] == wrong[0]])
    assert sum(r.n_furniture for r in got.values()) > 200 and sum(r.n_named for r in got.values()) == 0
    assert all(r.n_template + r.n_furniture > 0 for r in got.values())


def test_pages_of_the_table_with_names_taken_away(spark, sf_dir):
    """Hosts of five pages or more give the same texts whatever their elements and classes are called."""
    pages = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet")
    plain = {r.page_id: r for r in hw.extract_text(pages).collect()}
    html = F.col("html")
    for a, b in (("<article>", '<div class="q1">'), ("</article>", "</div>"), ("<nav>", '<div class="q2">'), ("</nav>", "</div>"), ("<footer>", '<div class="q3">'), ("</footer>", "</div>"), ('class="ad"', 'class="q4"')):
        html = F.regexp_replace(html, F.lit(a), F.lit(b))
    renamed = {r.page_id: r for r in hw.extract_text(pages.withColumn("html", html)).collect()}
    compared = [i for i, r in renamed.items() if r.n_furniture]
    assert len(compared) > 100 and all(renamed[i].text == plain[i].text for i in compared)
    assert all(plain[i].n_named == 0 for i in compared)


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<article class='share-price'><p>a b c</p></article>", "a b c"),
        ("<article><div class='legal-news'><p>a</div><div class='ad-hoc'><p>b</div><div id='head-of-state'><p>c</div></article>", "a\n\nb\n\nc"),
        ("<article><p>x</p><div class='ad-box'>y</div><div class='related-posts'><p>z</div></article>", "x"),
        ("<article><div class='post-header'><h1>Title</h1></div><p>x</p></article>", "Title\n\nx"),
        ("<article><p><a href=x>A link that is the whole paragraph</a></p></article>", "A link that is the whole paragraph"),
        ("<p>x<div class='user-comments'><p>y</div><div class='newsletter-signup'>z</div>", "x"),
    ],
)
def test_names_have_to_say_it_alone(html, expected):
    assert text(html) == expected


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<div><h1>T</h1><p>a b</p><p><a href=x>A whole paragraph that is one link</a></p></div>", "T\n\na b\n\nA whole paragraph that is one link"),
        ("<p><a href=x>" + "long " * 60 + "</a></p><p>b</p>", ("long " * 60).strip() + "\n\nb"),
        ("<div><p><a>Home</a></p><p><a>News</a></p></div><p>b</p>", "b"),
        ("<div><a>" + "Home " * 60 + "</a></div><ul><li><a>One</a><li><a>Two</a></ul><p>b</p>", "b"),
        ("<p>b</p><ul><li>see <a>One</a><li><a>Two</a></ul>", "b\n\nsee One\n\nTwo"),
        ("<article><p>The area is <math><semantics><mrow><mi>a</mi><mo>=</mo><msup><mi>r</mi><mn>2</mn></msup></mrow><annotation encoding='application/x-tex'>a=r^2</annotation></semantics></math> in all.</p></article>", "The area is a=r2 in all."),
        ("<p>a <math><mi>x</mi><mo>&lt;</mo><mn>2</mn></math></p>", "a x<2"),
        ("<article><p>Rated <span aria-hidden=true>four</span> <p aria-hidden='true'>seen</p></article>", "Rated four\n\nseen"),
        ("<article><header><h1>T</h1><p class='article-standfirst'>In short</p><p>By me</p><p hidden class=intro>no</p></header><p>x</article>", "T\n\nIn short\n\nx"),
    ],
)
def test_blocks_of_the_article_that_look_like_others(html, expected):
    assert text(html) == expected


def say(r, n):
    return " ".join(r.choice(["brast", "koml", "dorvik", "sumtep", "lan", "viktor", "estra"]) + str(r.randrange(99)) for _ in range(n)).capitalize() + "."


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div class=q>{}</div></main>", "<div class=q>{}</div><div>&copy; Somebody</div>"])
def test_versions_of_an_article_stay_whole(spark, wrap):
    """Five versions that differ in the title and one paragraph, alone on a host and among as many other pages."""
    r = random.Random(4)
    shared = [say(r, 30) for _ in range(6)]
    version = lambda: [say(r, 5), *shared[:3], say(r, 30), *shared[3:]]
    other = lambda: [say(r, 5)] + [say(r, 30) for _ in range(4)]
    html = lambda b: "<body><div><ul><li><a>Home</a><li><a>News</a></ul></div>" + wrap.format(f"<h1>{b[0]}</h1>" + "".join(f"<p>{x}</p>" for x in b[1:]))
    pages = [(i, "http://a.example/", version()) for i in range(5)] + [(10 + i, "http://b.example/", version() if i < 5 else other()) for i in range(9)]
    got = {x.page_id: x.text for x in hw.extract_text(spark.createDataFrame([(i, u, html(b)) for i, u, b in pages], SCHEMA)).collect()}
    tail = lambda t: t.removesuffix("\n\n© Somebody")  # noqa: E731  where a host has little else, names decide
    assert {i: tail(t) for i, t in got.items()} == {i: "\n\n".join(b) for i, _, b in pages}


@pytest.mark.parametrize("around", ["<main>{}</main>", "<nav>m</nav><div class=w>{}</div><div>Everything must go</div>"])
def test_notes_beside_the_story_are_text(spark, around):
    r = random.Random(6)
    parts = [(say(r, 40), say(r, 40), say(r, 8)) for _ in range(6)]
    rows = [(i, "http://a.example/", "<body>" + around.format(f"<div class=story><p>{a}</p><p>{b}</p></div><div class=notes><p>{c}</p></div>")) for i, (a, b, c) in enumerate(parts)]
    got = {x.page_id: x.text for x in hw.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: "\n\n".join(p) for i, p in enumerate(parts)}


def plain_extract(rows):
    """page_id to main text, by dictionaries over the pages of each host."""
    hosts, out = {}, {}
    for page_id, url, html in rows:
        tree, found = hw.read_page(html)
        named = hw.by_names(found)
        host = (url or "").split("://", 1)[-1].split("/")[0].split("?")[0].split("#")[0].lower() if "://" in (url or "") else ""
        content = hw._hash("\0".join(t for (_, t, _, _), keep in zip(found, named, strict=True) if keep))
        blocks = [{"node": n, "hash": hw._hash(t), "linked": share, "flags": f, "text": t} for n, t, f, share in found]
        hosts.setdefault(host, []).append((page_id, hw.written(tree), content, blocks))
    for pages in hosts.values():
        once = {}  # a page for each content, that of the least skeleton
        for _, skeleton, content, blocks in pages:
            kept = sorted({(b["node"], b["hash"], len(b["text"]), b["linked"], b["flags"] & hw.MARKED) for b in blocks})
            rank = (hw._hash(skeleton), [list(k) for k in kept])
            if content not in once or rank[0] < once[content][0]:
                once[content] = (rank[0], skeleton, kept)
        if len(once) < 5:
            out |= {i: hw.main_text(blocks, None)[0] for i, _, _, blocks in pages}
            continue
        n = {k: sum(s == k for _, s, _ in once.values()) for k in {p[1] for p in pages}}
        wrapper = max(n, key=lambda k: (n[k], hw._hash(k)))
        slots = {k: dict((x[2], x[2]) for x in hw.nodes_of(hw.read_back(k))) if k == wrapper else dict(hw.all_slots(hw.read_back(k), hw.align(hw.read_back(k), hw.read_back(wrapper)))) for k in n}
        seen, texts = {}, {}
        for k, own in slots.items():
            for slot in own.values():
                seen[slot] = seen.get(slot, 0) + n[k]
        for _, k, kept in once.values():
            for node, digest, chars, linked, marked in kept:
                t = texts.setdefault(slots[k][node], {}).setdefault(digest, [0, 0, 0, 0, 0])
                for j, v in enumerate((1, chars, linked, chars * marked)):
                    t[j] += v
                t[4] = max(t[4], chars)
        for k in n:
            stats = []
            for node, slot in slots[k].items():
                if slot in texts:
                    of = texts[slot]
                    fixed = {h for h, t in of.items() if 2 * t[0] > seen[slot] >= 5}
                    add = lambda j, of=of: sum(t[j] for t in of.values())
                    stats.append((node, seen[slot], add(1), add(2), add(3), sum(t[1] - t[2] for t in of.values() if t[0] == 1), sum(of[h][0] * of[h][4] for h in fixed), sorted(fixed)))
            rules = hw.rules_of(k, stats, len(once), 0.8)
            out |= {i: hw.main_text(blocks, rules)[0] for i, s, _, blocks in pages if s == k}
    return out


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_every_page_against_a_plain_comparison(spark, sf_dir, size):
    pages = spark.read.parquet(f"{sf_dir.replace('0.001', size)}/pages.parquet")
    expected = plain_extract([(r.page_id, r.url, r.html) for r in pages.collect()])
    got = {r.page_id: r.text for r in hw.extract_text(pages).collect()}
    assert got == expected and len(got) == pages.count()


def test_wide_and_deep_pages_are_aligned_in_bounded_time():
    import time

    r = random.Random(2)
    wide = [["r", [[f"d{r.randrange(500)}", [], i + 1] for i in range(3000)], 0] for _ in range(2)]
    began = time.process_time()
    pairs = hw.align(*wide)
    assert len(pairs) > 100 and all(wide[0][1][a - 1][0] == wide[1][1][b - 1][0] for a, b in pairs[1:])
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(sorted(pairs), sorted(pairs)[1:], strict=False))
    deep = [hw.read_page("<div>" * n + "x")[0] for n in (3000, 2500)]
    assert len(hw.align(*deep)) == 2501 and hw.read_back(hw.written(deep[1]))[1][0][0] == "div"
    assert time.process_time() - began < 30


def test_wide_tables_give_the_size_of_a_plain_one():
    """Rows made again from saved ones give a matching of the size that a full table has."""
    r = random.Random(3)
    for _ in range(20):
        a, b = ([[r.choice("abc"), [[r.choice("xy"), [], 0] for _ in range(r.randint(0, 2))], 0] for _ in range(r.randint(0, 9))] for _ in range(2))
        trees = []
        for kids in (a, b):
            tree, n = ["r", kids, 0], 0
            for node in hw.nodes_of(tree):
                node[2], n = n, n + 1
            trees.append(tree)
        assert len(hw.align(*trees)) == best_matching(*trees)
