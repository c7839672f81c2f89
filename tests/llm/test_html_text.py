"""Main text of pages: what goes by name, what goes as a template, and brute force without either's code."""

from collections import defaultdict
from html.parser import HTMLParser

import pytest

from rillet.llm.html_text import extract, main_text, names_dropped, parse

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def text(html):
    return main_text(parse(html))


@pytest.mark.parametrize("name, dropped", [
    ("site-footer", True), ("cookie_banner", True), ("ad-728x90", True), ("ad1", True), ("article-comments", True), ("main", False), ("", False),
    ("social-science", False), ("category-social", False), ("share-price-analysis", False), ("adverse", False), ("x sidebar", True), ("1", False),
])
def test_names(name, dropped):
    assert bool(names_dropped(name)) is dropped


def test_articles_that_are_no_story():
    assert text("<article>story</article><article class=comment>I agree</article>") == "story"
    assert text("<article id=comments><p>I agree</article><main>story</main>") == "story"
    assert text("<article>story<article class='comment odd'>no</article> goes on</article>") == "story\n\ngoes on"


def test_names_that_hold_a_story():
    assert text("<div class='social-science'><article>story</article></div>") == "story"
    assert text("<body class='single comment-open sidebar'><p>story") == "story"
    assert text("<main class=newsletter><p>story") == "story"


def test_headers():
    assert text("<header><h1>Site</h1></header><article><header><nav>m</nav><h1>T <i>x</i></h1><p>by A<div class=share><h2>Share</h2></div></header>b") == "T x\n\nb"
    assert text("<article><div class='entry-header'><h2>T</h2>1 May</div>b</article>") == "T\n\nb"
    assert text("<header><h1>Site</h1></header><p>b") == "b"


class Plain(HTMLParser):
    """Well-formed pages as nested lists [tag, attributes, children]."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.stack = [["", [], []]]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attributes):
        self.stack[-1][2].append([tag, attributes, []])
        if tag not in ("br", "meta"):
            self.stack.append(self.stack[-1][2][-1])

    def handle_endtag(self, tag):
        assert self.stack.pop()[0] == tag

    def handle_data(self, data):
        self.stack[-1][2].append(data)


def plain_extract(pages, containers):
    """Blocks that no subtree on four different pages of the host holds; plain Python, no hashes."""
    trees = [(host, html, Plain(html).stack[0]) for host, html in pages]

    def subtrees(node, path):
        for child in node[2]:
            if isinstance(child, list):
                if child[0] in containers:
                    yield path, repr(child), child
                yield from subtrees(child, (*path, child[0]))

    seen = defaultdict(set)
    for host, html, tree in trees:
        for path, shape, _ in subtrees(tree, ()):
            seen[host, path, shape].add(html)

    def blocks(node, gone):
        found = [""]
        for child in node[2]:
            if isinstance(child, str):
                found[-1] += child
            elif child[0] == "b":
                found[-1] += "".join(child[2])
            elif id(child) not in gone and child[0] != "title":
                found += [*blocks(child, gone), ""]
        return found

    for host, _, tree in trees:
        gone = {id(child) for path, shape, child in subtrees(tree, ()) if len(seen[host, path, shape]) >= 4}
        yield "\n\n".join(" ".join(x.split()) for x in blocks(tree, gone) if x.strip())


def nameless():
    """Pages made of unnamed boxes only, whose menus and notices recur on 1 to 9 pages of a host."""
    for n in range(120):
        host = f"h{n % 3}.org"
        menu = f"<ul><li>Home</li><li>Part {n // 30}</li></ul>"
        notice = f"<div><p>We &amp; you {n % 17}</p></div>"
        odd = f"<section><div><p>Same {n % 5}</p></div></section>" if n % 2 else f"<div><p>Same {n % 5}</p></div>"
        yield f"http://{host}/{n}", host, f"<html><head><title>T</title></head><body><div>{menu}{notice}</div><div><h1>H {n}</h1><p>Text <b>of</b> {n % 50}</p>{odd}</div></body></html>"


@pytest.mark.parametrize("most_keys", [1 << 21, 0])
def test_templates_against_plain_python(spark, most_keys):
    """Both ways to find a page's templates: known to all tasks, and joined."""
    rows = list(nameless())
    rows += [("http://h0.org/again", "h0.org", rows[0][2])] * 3
    frame = spark.createDataFrame([(n, url, html) for n, (url, _, html) in enumerate(rows)], PAGES).selectExpr("*", "1 AS key", "2 AS salt", "'x' AS host", "3 AS page", "4 AS templates")
    found = {r.page_id: r.text for r in extract(frame.repartition(5), most_keys=most_keys).collect()}
    expected = dict(enumerate(plain_extract([(host, html) for _, host, html in rows], {"div", "ul", "section", "p"})))
    assert found == expected
    assert sum(found[n] != text(html) for n, (_, _, html) in enumerate(rows)) > 100


@pytest.mark.parametrize("most_keys", [1 << 21, 0])
def test_given_pages_without_names(spark, most_keys):
    """The test pages with menu, advert, article and footer as unnamed boxes: the templates decide."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    rows, stories = [], {}
    for n, page in enumerate(pages[:60]):
        story = page.html.split("<article>")[1].split("</article>")[0]
        site = n % 5
        html = f"<body><div><ul><li>Menu of {site}</li></ul></div><div><p>Advert {site}</p></div><div>{story}</div><div>&copy; {site}</div></body>"
        rows.append((page.page_id, f"https://s{site}.org/{n}", html))
        stories[page.page_id] = text(f"<article>{story}</article>")
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES), most_keys=most_keys).collect()}
    assert found == stories


def test_nulls_and_empty(spark):
    rows = [(1, None, None), (2, "http://h.org", ""), (None, "http://h.org/a", "<p>x"), (4, "no url", "<div>x</div>"), (4, "no url", "<div>x</div>")]
    frame = spark.createDataFrame(rows, PAGES)
    for most_keys in (0, 9):
        assert sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(frame, most_keys=most_keys).collect()) == [
            (0, "x", 1), (1, "", 0), (2, "", 0), (4, "x", 1), (4, "x", 1)]
        assert extract(frame.limit(0), most_keys=most_keys).collect() == []
