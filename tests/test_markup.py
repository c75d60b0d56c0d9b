import sys
import time

import pytest

from newsloom.functions import markup


def body(source):
    page = markup.read_page(source)
    return markup.inner_markup(page.children[-1])


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<p><b>a<br><p>c</p><p>d", "<p><b>a<br/></b></p><p><b>c</b></p><p><b>d</b></p>"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "<ul><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ul>"),
        ("<table><tr><td>1<td>2<tr><td>3</table>x",
         "<table><tbody><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></tbody></table>x"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
        ("<p>a</div>b</p>c</p>", "<p>ab</p>c<p></p>"),
        ("<h1>a<h2>b</h1>", "<h1>a</h1><h2>b</h2>"),
        ("<b>x<i>y</b>z</i>", "<b>x<i>y</i></b><i>z</i>"),
        ("<a href=1>x<a href=2>y", '<a href="1">x</a><a href="2">y</a>'),
        ("<div><script>var t='</div>';</script>x</div>", "<div><script>var t='</div>';</script>x</div>"),
        ("<textarea><b>&amp;</textarea>", "<textarea>&lt;b&gt;&amp;</textarea>"),
        ("<!-- a --><div><!-- b -->x", "<div><!-- b -->x</div>"),
        ("it's \"q\" &amp; &copy; &#233; &lt;", "it&#39;s &#34;q&#34; &amp; © é &lt;"),
        ("<a href='?a=1&copy=2&amp;b&lt;'>x</a>", '<a href="?a=1&amp;copy=2&amp;b&lt;">x</a>'),
        ("<P CLASS=a Class=b>x", '<p class="a">x</p>'),
        ("a < b <3 </ x> <!x> <?y>", "a &lt; b &lt;3   "),
        ("x<a \"cut", "x"),
        ("<select><option>1<option>2</select>", "<select><option>1</option><option>2</option></select>"),
        ("<pre>\nx</pre>", "<pre>x</pre>"),
        ("a\r\nb\rc", "a\nb\nc"),
        ("", ""),
    ],
)
def test_tree_rules(source, expected):
    assert body(source) == expected


def test_head_and_body_are_implied():
    page = markup.Page("<title>a &amp; b</title><meta charset=x><p>x")
    assert [n.tag for n in page.elements] == ["html", "head", "title", "meta", "body", "p"]
    assert page.select("title")[0].children == ["a & b"]


PAGE = (
    '<div id=main-article class="a b"><h1>T</h1><p class=x>1</p><p>2</p>'
    '<span data-k="v1 v2" lang=en>s</span></div><p id=é>3</p>'
)


@pytest.mark.parametrize(
    "selector, count",
    [
        ("#main-article h1", 1), ("div.a.b > p", 2), ("p + span", 1), ("h1 ~ p", 2), ("p", 3),
        ("p:first-child", 0), ("h1:first-child", 1), ("p:nth-child(3)", 1), ("[data-k]", 1),
        ("[data-k~=v2]", 1), ("span[data-k^='v1']", 1), ('span[data-k$="v2"]', 1),
        ("span[data-k*=' ']", 1), ("span[lang=en]", 1), ("span[lang=e]", 0), ("h1, span", 2),
        ("*", 9), ("p.x", 1), ("body > div", 1), ("DIV P", 2), ("div > div", 0), ("#é", 1),
        ("html body div h1", 1), (".b.a", 1), ("h1 > p", 0), ("div#main-article.a", 1),
        ("p, p.x", 3),
    ],
)
def test_selectors(selector, count):
    assert len(markup.Page(PAGE).select(selector)) == count


@pytest.mark.parametrize("bad", ["p:hover", "", "p >", "> p", "p,,q", "p[", "a::before", ", p", "p:not(a)"])
def test_unsupported_selectors_are_refused(bad):
    with pytest.raises(ValueError):
        markup.compile_selector(bad)


def test_any_depth_is_read():
    deep = markup.Page("<div>" * 100_000 + "<h1>T</h1>")
    assert len(deep.select("div div h1")) == 1 and len(deep.select("div")) == 100_000
    assert markup.inner_markup(deep.root).count("<div>") == 100_000


def test_formatting_that_is_never_closed_is_kept():
    fonts = lambda n: "".join(f"<p><font color=c{i}>x" for i in range(n)) + "<p id=last>y"
    page = markup.Page(fonts(70))
    assert len(page.select("p")) == 71 and len(page.select("font")) == 70 * 71 // 2 + 70
    (last,) = page.select("#last")
    assert [n.attrs["color"] for n in last.walk()] == [f"c{i}" for i in range(70)]
    assert markup.inner_markup(last).startswith('<font color="c0"><font color="c1">')
    with pytest.raises(ValueError):
        markup.Page(fonts(5000))


def test_reopened_formatting_is_expanded_where_it_is_looked_at():
    source = "<h1>T</h1>" + "".join(f"<p><font color=c{i}>x" for i in range(1_300)) + "<p><b id=last>y</b>"
    page = markup.Page(source)
    assert [n.tag for n in page.select("body > h1")] == ["h1"] and len(page.select("p")) == 1_301
    assert len(page.elements) < 6_000
    (last,) = page.select("p font font b")
    assert last.attrs["id"] == "last" and last.parent.attrs["color"] == "c1299"
    assert len(page.elements) < 6_000 and len(page.tagged("font")) == 1_300 * 1_301 // 2 + 1_300
    # A link that is never closed is a link of every paragraph, and closing a copy ends what is in it only.
    page = markup.Page("<p><a href=1><b>x<p>y</a>z<p>w")
    assert len(page.tagged("a")) == 2
    assert markup.inner_markup(page.root.children[-1]) == (
        '<p><a href="1"><b>x</b></a></p><p><a href="1"><b>y</b></a><b>z</b></p><p><b>w</b></p>'
    )


@pytest.mark.parametrize(
    "source, selector, count",
    [
        ("<h1></h1>" + "<p>x</p>" * 20_000, "h1 ~ p", 20_000),
        ("<p>x</p>" * 20_000, "p:nth-child(7)", 1),
        ("<p>x</p>" * 20_000, "p + p", 19_999),
        ("<div>" * 2_000 + "<p>x", "span div div p", 0),
        ("<div>" * 2_000 + "<p>x", "div div > div p", 1),
    ],
)
def test_selecting_time_is_linear(source, selector, count):
    page, start = markup.Page(source), time.perf_counter()
    assert len(page.select(selector)) == count
    assert time.perf_counter() - start < 2


@pytest.mark.parametrize("piece", ["<", "<a ", "<a b='", "<!--", "</", "&", "<p><b>", "<![CDATA[", "<td>", "=\"'"])
def test_reading_time_is_linear(piece):
    start = time.perf_counter()
    try:
        markup.read_page(piece * (400_000 // len(piece)))
    except ValueError:
        pass
    assert time.perf_counter() - start < 20


def test_an_end_tag_looks_no_list_of_scopes_through():
    """Calls made for a page: before, each end tag asked for the place of every tag that ends a scope."""
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    source = "<div>" + "<span>x</span><p>y" * 200
    sys.setprofile(count)
    try:
        found = markup.Page(source).select("span")
    finally:
        sys.setprofile(None)
    assert len(found) == 200 and calls < 100 * 200


@pytest.mark.parametrize(
    "source, split",
    [
        ("<title>t</title><p id=a>x<table><td>1</table><h1>y<ul><li>z", False),
        ("<p><b><i><u>a<p>b<p>c", False),
        ("<p><b><i><u>a<p>b</i>c<p>d", True),
    ],
)
def test_elements_are_listed_as_they_are_made(source, split):
    built = markup._build(source)
    assert built.split == split
    if not split:
        assert built.elements == [built.root, *built.root.walk()]
    page = markup.Page(source)
    assert page.elements == [page.root, *page.root.walk()]
