import pytest

from tonality.llm import html_density as H


def p(n, s="Some words of prose here that say something."):
    return "<p>" + " ".join([s] * n) + "</p>"


ARTICLE = "<h1>Title &amp; more</h1>" + p(3) + p(1, "Second   para\n with <b>bold</b> and <a href='/x'>a link</a>.") + "<p>Short.</p>"
TEXT = ("Title & more\n\n" + " ".join(["Some words of prose here that say something."] * 3)
        + "\n\nSecond para with bold and a link.\n\nShort.")
FURNITURE = ('<nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><header>Site</header>'
             '<div class="cookie-notice">We use cookies and other things that need a long explanation here.</div>')
AFTER = ('<aside>Also read this</aside><div id="comments"><p>' + "I think so too. " * 40 + "</p></div>"
         '<form><p>Sign up</p><input type=text></form><footer>&copy; someone</footer><script>var t="</p>";</script>')


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div>{}</div></main>", "<div class='post'>{}</div>",
                                  "<div id=page><div class='content'>{}</div></div>", "<section><div><div>{}</div></div></section>"])
def test_article_without_furniture(wrap):
    page = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{FURNITURE}{wrap.format(ARTICLE)}{AFTER}</body></html>"
    assert H.main_text(page) == TEXT


def test_article_straight_in_body():
    assert H.main_text(f"<body>{FURNITURE}{ARTICLE}{AFTER}</body>") == TEXT


def test_parts_of_an_article_side_by_side():
    page = f"<body><div id=w><div class=a>{p(6) * 4}</div><div class=b>{p(5) * 3}</div></div></body>"
    assert H.main_text(page).count("\n\n") == 6


@pytest.mark.parametrize("page, text", [
    ("", ""), ("   ", ""), ("<html><body></body></html>", ""), ("just text &lt;b&gt;", "just text <b>"),
    ("<article><p>one<p>two<b>bold<p>three", "one\n\ntwobold\n\nthree"), ("<article><p>cut <a href=\"x", "cut"),
    ("<article><p>a<br>b</p><ul><li>x<li>y</ul>", "a b\n\nx\n\ny"), ("<article><p>a<!-- no --> b</p><!-- open", "a b"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"), ("<nav><div>x</nav><article><p>z</p>", "z"),
    ("<article><p hidden>no</p><p aria-hidden='true'>no</p><p>yes</p>", "yes"), ("<article><p>5 < 6 &am", "5 < 6 &am"),
    ("<article><p>q &quot;&#233;&#x41;&nbsp;end</p>", 'q "éA end'), ("<script>only();</script>", ""),
    ("<article><a title='a>b' href=x>t</a> u</article>", "t u"), ("</p></div>stray<p>ok</p>", "stray\n\nok"),
])
def test_small_pages(page, text):
    assert H.main_text(page) == text


def test_link_lists_are_not_the_article():
    links = "<div>" + "".join(f"<p><a href=/{i}>A headline about thing number {i}</a></p>" for i in range(30)) + "</div>"
    assert H.main_text(f"<body><div>{links}</div><div class=x>{p(4) * 3}</div></body>") == "\n\n".join(
        [" ".join(["Some words of prose here that say something."] * 4)] * 3)


def test_nested_and_long_pages():
    deep = "<div>" * 3000 + "<p>inner</p>" + "</div>" * 3000
    assert H.main_text(deep) == "inner"
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    assert H.main_text(long).count("word") == 30_000


def test_table(spark):
    rows = [(1, "u", None, 5, "t"), (2, None, "<article><p>x</p>", 6, "t"), (2, None, "<article><p>x</p>", 6, "t"), (None, "v", "", 7, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, c0 int, text string")
    got = sorted((str(r.page_id), str(r.url), r.text) for r in H.extract(pages).collect())
    assert got == [("1", "u", ""), ("2", "None", "x"), ("2", "None", "x"), ("None", "v", "")]
    assert H.extract(pages.limit(0)).count() == 0


def plain(n, chars=200):
    """``n`` paragraphs of so many letters."""
    return "".join(f"<p>{'abcdefghij' * (chars // 10)}</p>" for _ in range(n))


@pytest.mark.parametrize("outer", ["{}", "<main>{}</main>", "<div>{}</div>"])
def test_every_article_that_reaches_the_threshold_stays(outer):
    page = "<body>" + outer.format(f"<article>{plain(6)}</article><article>{plain(5)}</article>") + "</body>"
    assert H.main_text(page).count("\n\n") == 10


def test_paragraphs_outside_the_article_stay():
    page = f"<body><article>{plain(6)}</article><div>{plain(5)}</div></body>"
    assert len(H.main_text(page).split("\n\n")) == 11
    assert H.main_text(f"<body><h1>The headline</h1><article>{plain(4)}</article></body>").startswith("The headline\n\nabc")


def test_an_article_takes_no_link_lists_from_outside():
    links = "<div>" + "".join(f"<p><a href=/{i}>A headline about thing number {i}</a></p>" for i in range(30)) + "</div>"
    assert H.main_text(f"<body>{links}<article>{plain(3)}</article>{links}</body>").count("\n\n") == 2


def test_sibling_sections_straight_in_body():
    page = f"<body><section>{plain(6)}</section><section>{plain(5)}</section></body>"
    assert H.main_text(page).count("\n\n") == 10


def test_bare_text_beside_the_core_stays():
    page = f"<body><div>Bare words<br>of the <b>article</b>.<div>{plain(6)}</div>And an end.</div></body>"
    lines = H.main_text(page).split("\n\n")
    assert lines[0] == "Bare words of the article." and lines[-1] == "And an end." and len(lines) == 8


@pytest.mark.parametrize("page, text", [
    ('<article><p class="byline">By X<p>text</article>', "text"),
    ('<article><ul><li class="social">a<li>b</ul><p>c</p></article>', "b\n\nc"),
    ('<article><div class="share"><span>x</div><p>c</p></article>', "c"),
    ('<article><div><p class="share">x</div><p>c</p></article>', "c"),
    ("<html><head><title>T</title><body><p>b</p>", "b"), ("<head><meta charset=x><p>b</p>", "b"),
])
def test_furniture_without_end_tags(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'data-href="/hidden-gems"', 'data-id="ad-7"', 'class="no-comments"',
                                   'class="layout has-sidebar"', 'title="a hidden thing"', 'class="widget"', 'id="login"'])
def test_attributes_and_wrappers_that_are_no_furniture(attrs):
    for inner in ("<article>{}</article>", "<div>{}</div>", "{}"):
        assert H.main_text(f"<body><div {attrs}>{inner.format(ARTICLE)}</div></body>") == TEXT
    assert H.main_text(f"<article><p {attrs}>some prose</p></article>") == "some prose"


def test_links_and_formulas_stay():
    page = '<article><p>A <a href="/hidden-gems">link</a> and <math><mi>x</mi><mspace/><mo>=</mo><mn>1</mn></math>.</p></article>'
    assert H.main_text(page) == "A link and x=1."


@pytest.mark.parametrize("attrs", ["class=ad", "id='ad-7'", "hidden", 'class="x cookie_banner"', "ROLE=navigation", "id=comment-12"])
def test_furniture_by_whole_names(attrs):
    assert H.main_text(f"<article>{ARTICLE}<div {attrs}><p>Not this.</p></div></article>") == TEXT


@pytest.mark.parametrize("wrap", ["<form id=aspnetForm>{}</form>", "<div><form><input type=hidden><div>{}</div></form></div>",
                                  "<noscript>{}</noscript>", "<header>{}</header>", "<div role=form>{}</div>"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div class=post>{}</div>", "{}"])
def test_forms_headers_and_noscript_round_the_article(wrap, inner):
    page = f"<head><noscript><img src=x></noscript></head><body>{wrap.format(FURNITURE + inner.format(ARTICLE) + AFTER)}</body>"
    assert H.main_text(page) == TEXT


def test_noscript_inside_a_paragraph_is_nothing():
    page = "<article><p>One <noscript><p>no</p><img src=x></noscript>line.</p><noscript><article><p>no</p></article></noscript></article>"
    assert H.main_text(page) == "One line."


def test_a_wrapper_with_the_only_article_stays_whatever_its_share():
    page = f"<body><div>{'<p><a href=/x>Another headline of another page</a></p>' * 60}</div><form><article>{ARTICLE}</article></form></body>"
    assert H.main_text(page) == TEXT


def test_header_of_an_article_holds_its_headline():
    page = f"<body><header><h1>Site</h1><p>Motto</p></header><article><header><h1>The headline</h1></header>{p(3)}</article></body>"
    assert H.main_text(page).split("\n\n")[0] == "The headline" and "Site" not in H.main_text(page)
    assert H.main_text(f"<article><header>Monday <a href=/x>News</a></header>{p(2)}</article>").startswith("Some words")


COMMENT = "<p>I quite agree with all that was said and would like to add this.</p>"


@pytest.mark.parametrize("comments", [
    "<section><h2>3 comments</h2><ol><li>{0}<li>{0}<li>{0}</ol></section>", "<h2>Comments (3)</h2><ol><li>{0}<li>{0}</ol>",
    "<div><div><h3>1 Comment</h3></div><div><div>{0}</div></div></div>", "<h3>Leave a reply</h3><div>{0}</div>",
    "<section><header><h2>Readers' comments</h2></header><article>{0}</article><article>{0}</article></section>"])
@pytest.mark.parametrize("where", ["<article>{}</article>{}", "<article>{}{}</article>", "<div class=post>{}{}</div>", "{}{}"])
def test_parts_headed_as_comments_go(comments, where):
    assert H.main_text(f"<body>{where.format(ARTICLE, comments.format(COMMENT))}</body>") == TEXT


@pytest.mark.parametrize("heading", ["Comments on the new law", "No comment from the ministry", "The discussion", "3 replies to a critic of ours"])
def test_headings_that_only_speak_of_comments_stay(heading):
    assert heading in H.main_text(f"<article>{ARTICLE}<h2>{heading}</h2>{p(3)}<ol><li>One</ol></article>")


def test_time_grows_with_the_page():
    import time
    for page in ("<div>" * 60_000 + "</b>" * 60_000, "<b>" * 40_000 + "<div></div>" * 40_000,
                 "<ul><li><ul>" + "<div>" * 40_000 + "<li></li>" * 40_000, "<h2>" * 40_000 + "x", "<h2>3 comments</h2>" * 20_000):
        start = time.perf_counter()
        H.main_text(page + "<p>end</p>")
        assert time.perf_counter() - start < 6


def by_definition(tree, share):
    """(chars, link chars, tags, link tags, density, density sum) of a generated tree, each from all it holds."""
    import math

    def texts(t, linked):
        return [(x, linked) for part in t[1] for x in ([part] if isinstance(part, str) else [])] + [
            y for part in t[1] if not isinstance(part, str) for y in texts(part, linked or part[0] == "a")]

    def below(t):
        return [x for part in t[1] if not isinstance(part, str) for x in [part, *below(part)]]

    def one(t):
        held = texts(t, t[0] == "a")
        chars, linked = sum(len(x) for x, _ in held), sum(len(x) for x, a in held if a)
        tags, link_tags = len(below(t)), sum(x[0] == "a" for x in below(t))
        if not chars:
            return chars, linked, tags, link_tags, 0.0
        inner = chars * linked / max(1, chars - linked) + share * chars + math.e ** 2
        return (chars, linked, tags, link_tags, chars / max(1, tags)
                * math.log(chars * max(1, tags) / (max(1, linked) * max(1, link_tags))) / math.log(math.log(inner)))

    children = [x for x in tree[1] if not isinstance(x, str)]
    return *one(tree), sum(one(x)[4] for x in children) if children else one(tree)[4]


@pytest.mark.parametrize("seed", range(40))
def test_densities_by_definition(seed):
    import random
    rng = random.Random(seed)

    def grow(tag, depth):
        parts = ["abcdefghijklmnopqrst"[:rng.randint(1, 20)] for _ in range(rng.randint(0, 2))]
        for _ in range(rng.randint(0, 4) if depth else 0):
            inner = "a" if rng.random() < 0.3 else "div" if tag != "a" else "span"
            parts.append(grow(inner, depth - 1 if inner != "a" else 0))
        rng.shuffle(parts)
        return tag, parts

    def written(t):
        return f"<{t[0]}>" + "".join(x if isinstance(x, str) else written(x) for x in t[1]) + f"</{t[0]}>"

    tree = grow("div", 4)
    root = H.parse("<body>" + written(tree))
    order = [n for n in H.measure(root) if n.tag not in ("html", "body")]
    share = root.link_chars / max(1, root.chars)
    todo, wanted = [tree], []
    while todo:
        t = todo.pop()
        wanted.append(t)
        todo += [x for x in reversed(t[1]) if not isinstance(x, str)]
    assert [n.tag for n in order] == [t[0] for t in wanted]
    for n, t in zip(order, wanted):
        assert (n.chars, n.link_chars, n.tags, n.link_tags, n.density, n.total) == pytest.approx(by_definition(t, share))
