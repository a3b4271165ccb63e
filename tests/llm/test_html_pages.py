"""Page text against a plain element tree on generated pages, and on markup that loses or drowns text."""

import random
import time
from html.parser import HTMLParser

import pytest
from rankline.llm import htmltext
from rankline.llm.htmltext import Page

VOID = {"br", "img", "hr"}
DROPPED = {"nav", "aside", "footer", "header", "button", "select"}
MARKED = ["sidebar", "cookie-banner", "site-nav", "ad-slot", "comments", "share-buttons", "user-comments", "related-posts", "newsletter_box"]
PLAIN = ["content", "no-sidebar", "with-header", "share-price", "post-header", "story", "content-sidebar-wrap", "shadow", "navy", "hide-comments", "entry-title"]
INLINE = {"b", "i", "a", "span", "em"}


class Tree(HTMLParser):
    """Elements as nested lists: [tag, class, children]."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.root = ["root", "", []]
        self.open = [self.root]
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs).get("class", ""), []]
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        assert self.open[-1][0] == tag
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][2].append(data)


def wanted(node):
    tag, name, _ = node
    return tag not in DROPPED and tag not in ("script", "style", "title", "textarea", "noscript", "form") and name not in MARKED


def collect(node, tag):
    if not wanted(node):
        return []
    if node[0] == tag:
        return [node]
    return [x for child in node[2] if isinstance(child, list) for x in collect(child, tag)]


def pieces(node, out):
    for child in node[2]:
        if isinstance(child, str):
            out.append(child)
        elif child[0] in VOID:
            out += ["\0"] if child[0] != "img" else []
        elif child[0] in INLINE:
            pieces(child, out)
        else:
            out.append("\0")
            if wanted(child):
                pieces(child, out)
            out.append("\0")
    return out


def plain_text(source):
    root = Tree(source).root
    regions = collect(root, "article") or collect(root, "main") or [root]
    joined = "\0".join("".join(pieces(r, [])) for r in regions)
    return "\n".join(line for line in (" ".join(part.split()) for part in joined.split("\0")) if line)


class Writer:
    def __init__(self, seed):
        self.rng = random.Random(seed)
        self.n = 0

    def words(self, least=3, most=12):
        self.n += 1
        sample = ["alpha", "beta", "&amp;", "&lt;tag&gt;", "été", "x &nbsp; y", "it's", "a\n b", "3 < 4", "&#8217;", "🎈"]
        return " ".join(self.rng.choice(sample) for _ in range(self.rng.randint(least, most))) + f" w{self.n}"

    def inline(self):
        text = self.words()
        kind = self.rng.random()
        if kind < 0.2:
            return f"{text} <b>{self.words(1, 3)}</b>{self.words(1, 2)}"
        if kind < 0.3:
            return f'{text}<a href="/x?a=1&b=2" title="p > q">{self.words(1, 2)}</a>'
        if kind < 0.4:
            return f"{text}<br>{self.words(1, 4)}<img alt='x > y'>"
        return text

    def noise(self):
        return self.rng.choice([
            '<script>document.write("<!-- ad");if(a<b){x="</div>"}</script>', "<!-- <article>gone</article> -->", "<!-->", "<!--->", "<style>p{color:red}</style>", "<textarea><!-- x </textarea>",
            f"<nav><ul><li>{self.words()}</li></ul></nav>", f"<aside><p>{self.words()}</p></aside>", f'<div class="{self.rng.choice(MARKED)}"><p>{self.words()}</p></div>', f"<footer>{self.words()}</footer>",
        ])

    def block(self, depth=0):
        kind = self.rng.random()
        name = self.rng.choice(PLAIN)
        if kind < 0.35 or depth > 3:
            return f'<p class="{name}">{self.inline()}</p>'
        if kind < 0.45:
            return f'<h2 class="{name}">{self.inline()}</h2>'
        if kind < 0.55:
            return "<ul>" + "".join(f"<li>{self.inline()}</li>" for _ in range(self.rng.randint(1, 4))) + "</ul>"
        if kind < 0.65:
            return self.noise()
        return f'<div class="{name}">' + "".join(self.block(depth + 1) for _ in range(self.rng.randint(1, 4))) + "</div>"

    def blocks(self, n):
        return "".join(self.block() for _ in range(n))

    def page(self):
        kind = self.rng.choice(["articles", "main", "plain", "wrapper", "form"])
        body = f"<p>{self.words(20, 30)}</p>" + self.blocks(self.rng.randint(2, 8))
        if kind == "articles":
            body = "".join(f"<article><p>{self.words(20, 30)}</p>{self.blocks(self.rng.randint(1, 5))}</article>{self.noise()}" for _ in range(self.rng.randint(1, 4)))
        elif kind == "main":
            body = f'<div class="content"><main><p>{self.words(40, 50)}</p>{body}</main></div>{self.noise()}'
        elif kind == "wrapper":
            body = f'<div class="{self.rng.choice(PLAIN)}">{body}</div>'
        page = f"<html><head><title>t</title></head><body><nav>{self.words()}</nav>{body}<footer>f</footer></body></html>"
        plain = page
        if kind == "form":
            page = page.replace("<body>", '<body><form action="/a">').replace("</body>", "</form></body>")
        return page, plain


@pytest.mark.parametrize("block", range(4))
def test_text_agrees_with_an_element_tree(block):
    for seed in range(block * 100, block * 100 + 100):
        page, plain = Writer(seed).page()
        for part in ("<!-->", "<!--->", "<title>t</title>", "<textarea><!-- x </textarea>"):  # html.parser reads comments in these
            plain = plain.replace(part, "")
        assert Page(page).text(set()) == plain_text(plain), page


@pytest.mark.parametrize("source, text", [
    ("<!-- a <article>y</article>", "y"),
    ('<div class="page with-header"><p>a</p></div>', "a"),
    ("<form><div><p>whole page</p></div></form>", "whole page"),
    ('<div class="sidebar"><article><p>a</p></article></div><p>b</p>', "a"),
    ('<article><p>text</p></article><div class="comments"><article class="comment">' + "bad " * 50 + "</article></div>", "text"),
    ("<article><p>text of the page</p></article><aside><article>other</article></aside>", "text of the page"),
    ("<p>lead</p><div><p>" + "body " * 60 + "</p></div><p>last</p>", "lead\n" + ("body " * 60).strip() + "\nlast"),
    ("<main><p>" + "long " * 60 + "</p><article class='teaser'>t</article><article>card</article></main>", ("long " * 60).strip() + "\ncard"),
    ("a<b", "a<b"), ("", ""), ("<", "<"), ("<p don't>it's</p>", "it's"), ("<title>never ends <p>x</p>", "never ends\nx"),
])
def test_pages_that_lose_no_text(source, text):
    assert Page(source).text(set()) == text


@pytest.mark.parametrize("source", [
    "<a " * 350_000, "<div>" * 200_000, "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, '<a "' * 250_000, '<a ="' * 250_000 + ">", "<!--" * 250_000,
    "<title>" * 150_000, "<p class='a" * 90_000, "<p>x" * 250_000, "<li><ul>" * 120_000, "<![CDATA[" * 100_000, "<a ='\"> " * 150_000, "&" * 1_000_000, "<script>" * 120_000,
])
def test_a_megabyte_of_broken_markup_takes_seconds(source):
    start = time.process_time()
    page = Page(source)
    page.text({0})
    assert time.process_time() - start < 8


def test_equal_subtrees_have_equal_hashes_wherever_they_stand():
    part = '<div class="x"><p>one</p>  <ul><li>two</li></ul></div>'
    first, second = Page(f"<main>{part}<p>a</p></main>"), Page(f"<section><p>b</p><div>{part}</div></section>")
    common = set(first.subtrees().values()) & set(second.subtrees().values())
    assert len(common) == 2
    assert not common & set(Page(part.replace("two", "three")).subtrees().values())


def test_template_is_cut(spark):
    rows = [(i, f"https://h.example/{i}", f'<body><div class="promo-x"><p>same on all</p></div><div><p>own text {i}</p></div></body>', "x") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    assert {r.page_id: r.text for r in htmltext.extract_text(df).collect()} == {i: f"own text {i}" for i in range(12)}
