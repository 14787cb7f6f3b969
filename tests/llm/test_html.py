import os
import random
import time

import pytest

from jobtide.llm import html_extract as H


def page(i, body, nav="Home"):
    return (
        f'<html><head><title>T{i}</title><style>p{{}}</style><script>var t="</p>";x({i})</script></head><body><nav><a>{nav}</a></nav><header>Site</header><div class="ad">Buy</div>'
        f'<div id="box"><p>Our paper since 1900</p></div><article><h1>Title {i}</h1>{body}<div class="share">Share</div></article><aside>side</aside>'
        '<div id="comments"><p>First!</p></div><form><p>Name</p></form><footer>&copy; x</footer></body></html>'
    )


def test_extract_drops_what_is_not_article():
    body = "<p>A &amp; B\n  c&eacute;<br>d <b>bold<p>Second <i>one</i><ul><li>x<li>y</ul><blockquote>q</blockquote><!-- no --><p></p>"
    assert H.extract(page(1, body)) == "Title 1\n\nA & B cé d bold\n\nSecond one\n\nx\n\ny\n\nq"
    assert H.extract(None) == H.extract("") == H.extract("<p> \n</p>") == ""
    assert H.extract("just text &lt;b&gt;") == "just text <b>"
    assert H.extract("<div><p>one<p>two</div><script>bad") == "one\n\ntwo"


def outline(tree):
    """An outline of nested (letter, children) pairs."""
    sigs, parents, todo = [], [], [(tree, -1)]
    for (sig, kids), parent in todo:
        sigs.append(ord(sig))
        parents.append(parent)
        todo += [(k, len(sigs) - 1) for k in kids]
    return H.Outline(sigs, [0] * len(sigs), parents, [])


def largest(a, b):
    """Simple tree matching by the book: nodes of the largest match of two trees with equal roots."""
    if a[0] != b[0]:
        return 0

    def chain(x, y):
        if not x or not y:
            return 0
        return max(chain(x[:-1], y), chain(x, y[:-1]), chain(x[:-1], y[:-1]) + largest(x[-1], y[-1]))

    return 1 + chain(a[1], b[1])


def test_simple_tree_matching_is_the_largest():
    rng = random.Random(3)

    def tree(depth):
        return (rng.choice("ab"), [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    for _ in range(150):
        x, y = ("r", [tree(2) for _ in range(3)]), ("r", [tree(2) for _ in range(3)])
        a, b = outline(x), outline(y)
        got = H.align(a, b)
        assert len(got) == largest(x, y) and len(set(got.values())) == len(got)
        assert all(a.sigs[i] == b.sigs[j] and (i == 0 or got[a.parents[i]] == b.parents[j]) for i, j in got.items())
        # brothers keep their order
        assert all((i < k) == (got[i] < got[k]) for i in got for k in got if i != k and a.parents[i] == a.parents[k])
        few = H.align(a, b, limit=1)
        assert len(few) <= len(got) and all(a.sigs[i] == b.sigs[j] for i, j in few.items())


def test_wrapper_tells_template_from_slots():
    bare = lambda i: f"<body><div><p>Our paper since 1900</p></div><section><p>Story {i} " + "words " * 30 + f"</p><p>more {i}</p></section></body>"
    wrapper = H.induce([bare(i) for i in range(4)])
    assert H.extract(bare(9), wrapper) == "Story 9 " + "words " * 29 + "words\n\nmore 9"
    equal = H.induce([bare(1)] * 4)
    assert "Story 1" in H.extract(bare(1), equal)


def test_pages_of_a_rarer_layout_have_their_own_template(spark):
    common = lambda i: f"<body><div><p>Paper of record</p></div><section><p>Story {i} text</p></section></body>"
    rare = lambda i: f"<body><ul><li>Town edition</ul><table><tr><td>Report {i}</td></tr></table></body>"
    rows = [(i, "http://h/x", common(i) if i % 5 else rare(i), "n") for i in range(100)]
    got = {r.page_id: r.text for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert got == {i: f"Story {i} text" if i % 5 else f"Report {i}" for i in range(100)}


def test_wrappers_joined_by_host_are_the_same(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}/x", f"<div><p>Site {i % 3}</p></div><section><p>Story {i}</p></section>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(H.extract_pages(pages).collect())
    monkeypatch.setattr(H, "BROADCAST_BYTES", 0)
    assert sorted(H.extract_pages(pages).collect()) == want and want[0].text == "Story 0"


@pytest.mark.parametrize("html", ["<div>" * 50_000 + "deep", "<b>" * 50_000 + "deep" + "</i>" * 50_000, "deep" + "<a '" * 250_000, "deep" + "<a b='" * 170_000, "deep" + "<![CDATA[" * 100_000, "deep" + "<svg>" * 200_000, "deep" + "<!" * 500_000, "deep&#" + "9" * 6000 + ";", "<p>" * 200_000 + "<article>deep"])
def test_hostile_pages_end_quickly(html):
    began = time.process_time()
    wrapper = H.induce([html, "<p>x</p>"])
    assert "deep" in H.extract(html, wrapper) and time.process_time() - began < 20


def test_many_unlike_brothers():
    html = "".join(f'<div class="{c}"><p>t{i}</p></div>' for i, c in enumerate("ab" * 3000))
    wrapper = H.induce([html, html + "<p>end</p>"])
    assert H.extract(html, wrapper)


def test_quotes_and_odd_attributes():
    assert H.extract("<p title=it's>one</p><p title='a > b'>two</p><a data-id='ad'>three</a>") == "one\n\ntwo\n\nthree"
    assert H.extract("<table><tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"


def test_extract_pages(spark):
    rows = [(i, f"http://a.example/{i}", page(i, f"<p>Text {i}</p>")) for i in range(12)] + [(50, "https://www.b.example:80/", page(50, "<p>Own</p>")), (51, None, None), (52, "x", ""), (0, "http://a.example/0", page(0, "<p>Text 0</p>"))]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in H.extract_pages(pages).collect()}
    want = {(i, u): f"Title {i}\n\n" + (f"Text {i}" if i < 50 else "Own") if h else "" for i, u, h in rows}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    assert H.extract_pages(pages).count() == len(rows) and H.extract_pages(pages.limit(0)).count() == 0


PAGES = "/root/testdata/sf0.01/pages.parquet"


@pytest.mark.skipif(not os.path.isfile(PAGES), reason="no test tables here")
@pytest.mark.parametrize("plain_tags", [False, True])
def test_the_wrapper_alone_finds_the_articles(plain_tags):
    """Without any list of tags, roles and names, and even without article elements, on all pages of the table."""
    import pyarrow.parquet as pq

    bare = lambda h: h.replace("<article", '<div class="story"').replace("</article", "</div") if plain_tags else h
    hosts: dict[str, list[str]] = {}
    for row in pq.read_table(PAGES).to_pylist():
        hosts.setdefault(row["url"].split("//")[1].split("/")[0], []).append(row["html"])
    lost = kept = other = blocks = 0
    for pages in hosts.values():
        wrapper = H.induce([bare(p) for p in pages], lists=False)
        for p in pages:
            want = plain_article(p)
            got, every = H.extract(bare(p), wrapper, lists=False).split("\n\n"), []
            H._blocks(H.parse(bare(p), False, False), set(), every)
            blocks, other = blocks + len(want), other + sum(b not in want for b in every)
            lost, kept = lost + sum(b not in got for b in want), kept + sum(b not in want for b in got)
    assert blocks > 2000 and other > 1500 and lost == 0 and kept <= 0.005 * other


def plain_article(html):
    """Blocks of the only article element, by the standard library's parser."""
    from html.parser import HTMLParser

    block = set("article p div h1 h2 h3 h4 h5 h6 ul ol li blockquote pre table tr td th section dl dt dd figure figcaption hr".split())
    blocks, line = [], []

    class Reader(HTMLParser):
        inside, hidden = 0, 0

        def flush(self):
            text = " ".join("".join(line).split())
            blocks.extend([text] if text else [])
            line.clear()

        def handle_starttag(self, tag, attrs):
            names = " ".join(v or "" for k, v in attrs if k in ("id", "class"))
            if tag == "article":
                self.inside += 1
            elif self.inside and (tag in ("aside", "nav", "script", "style", "form") or H.NOT_MAIN.search(names)):
                self.hidden = self.hidden or len(self.stack) + 1
            if tag == "br":
                line.append(" ")
            elif tag not in H.VOID:
                self.stack.append(tag)
            if tag in block:
                self.flush()

        def handle_endtag(self, tag):
            if tag in self.stack:
                while self.stack.pop() != tag:
                    pass
                if self.hidden > len(self.stack):
                    self.hidden = 0
            if tag in block:
                self.flush()
            if tag == "article":
                self.inside -= 1

        def handle_data(self, data):
            if self.inside and not self.hidden:
                line.append(data)

        stack: list = []

    reader = Reader(convert_charrefs=True)
    reader.stack = []
    reader.feed(html)
    reader.close()
    return blocks


def test_equal_articles_of_a_host_stay():
    make = lambda day, text="The whole story " * 20: f"<body><div><p>{day} May</p></div><section><p>{text}</p><p>and its end</p></section></body>"
    for n in (2, 3, 6):
        pages = [make(d) for d in range(n)]
        wrapper = H.induce(pages)
        for d, p in enumerate(pages):
            assert H.extract(p, wrapper).endswith("The whole story " * 19 + "The whole story\n\nand its end")


def test_comments_and_teasers_that_are_articles_go():
    other = '<article class="comment"><p>First!</p></article><article class="related teaser"><p>More</p></article>'
    assert H.extract(f"<main><p>Story</p>{other}</main>") == "Story"
    assert H.extract(f"<article><p>Story</p>{other}</article>") == "Story"
    assert H.extract(f"<body><article><p>Story</p></article>{other}</body>") == "Story"
    assert H.extract(f"<body>{other}</body>") == "First!\n\nMore"  # there is nothing else


def test_headings_of_articles_stay():
    for head in ('<header class="entry-header"><h1>Title</h1></header>', '<div class="post-header"><h1>Title</h1></div>', "<header><h1>Title</h1></header>", '<header class="masthead"><h1>Title</h1></header>'):
        assert H.extract(f'<body><header class="site-header">Site</header><article>{head}<p>Text</p><div class="comments-header">Say</div></article></body>') == "Title\n\nText"


def test_names_alone_do_not_empty_a_page():
    assert H.extract('<section class="tags alert-story"><p>Whole story</p></section>') == "Whole story"
    assert H.extract('<div class="search-results legal"><p>Whole story</p></div><nav>Menu</nav>') == "Whole story"
    assert H.extract('<div class="ad">Buy</div><p>Text</p>') == "Text"


def test_menus_and_adverts_without_names_go():
    """A planted host with two layouts and no telling tag or class, against its parts."""
    rng = random.Random(11)
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta omega sigma kappa".split()) for _ in range(n))
    pages, want = [], []
    for i in range(60):
        menu = "".join(f'<li><a href="/{words(1)}">{words(2)}</a></li>' for _ in range(rng.randint(3, 7)))
        story = [f"Title {i} {words(3)}"] + [f"{words(rng.randint(15, 60))} {i}" for _ in range(rng.randint(1, 5))]
        inner = "".join(f"<p>{x}</p>" for x in story)
        if i % 6:
            pages.append(f'<body><div class="a"><ul>{menu}</ul></div><div class="b"><p>{words(6)}</p></div><div class="c">{inner}</div><div class="d"><p>House of papers</p><p>{words(4)}</p></div></body>')
        else:
            pages.append(f'<body><section class="x">{inner}</section><section class="y"><p>House of papers</p></section></body>')
        want.append("\n\n".join(story))
    wrapper = H.induce(pages)
    got = [H.extract(p, wrapper) for p in pages]
    assert [g == w for g, w in zip(got, want)].count(False) == 0
