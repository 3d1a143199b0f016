import re
import time
from html.parser import HTMLParser

import pytest
from conftest import SF

from veriledger.llm import html_text as h


@pytest.mark.parametrize("page,text", [
    ("<p>one<p>two <b>bold</b> x<div>d</div>tail", "one\n\ntwo bold x\n\nd\ntail"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li>y<li value=9>z</ol>", "3. x\n4. y\n9. z"),
    ("<ol reversed><li>x<li>y</ol>", "2. x\n1. y"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td>x<td>10</table>",
     "Name       Qty\napple pie  3\nx          10"),
    ("<table><tr><td colspan=2>wide cell here</td></tr><tr><td rowspan=2>a<td>b<tr><td>c</table>after",
     "wide cell here\na  b\n   c\n\nafter"),
    ("<table>before<tr><td>漢字<td>b<tr><td>abcde<td>c</table>", "before\n\n漢字   b\nabcde  c"),
    ("<table><tr><td><table><tr><td>n1<td>n2</table><td>o</table>", "n1  n2  o"),
    ("<table><tfoot><tr><td>f</tfoot><tbody><tr><td>b<thead><tr><td>h</table>", "h\nb\nf"),
    ("<style>.ad,#z, p.no{display:none}</style><p class='x ad'>1</p><p class=no>2<p>3 <i id=z>4</i>", "3"),
    ("<div style='visibility:hidden'>h<i style='visibility: visible'>v</i></div><div hidden>n</div>", "v"),
    ("<pre>\n a  b\n   c</pre>x<br>y<hr>z &amp; &lt;q&gt; &copy;&nbsp;k", " a  b\n   c\n\nx\ny\n\n---\n\nz & <q> © k"),
    ("<details><summary>S</summary>hid</details><select><option>1<option selected>2</select>", "S\n2"),
    ("a<!-- <p>x --><script>if(a<b){'</p>'}</script>c<blockquote>q</blockquote>", "ac\n\n  q"),
    ("<head><title>t</title><meta></head>x<noscript>n</noscript><template>t</template>", "x"),
    ("1 < 2 <a href='x>y'>l</a> <", "1 < 2 l <"),
    ("<td>stray<tr>cells", "straycells"),
    ("</p>x</br>y</div>", "x\ny"),
    ("", ""),
    (None, ""),
])
def test_layout(page, text):
    assert h.rendered(page) == text


@pytest.mark.parametrize("page,text", [
    ("<style>@media print{.nav{display:none}}</style><p class=nav>n", "n"),
    ("<style>@media (max-width:600px){.side{display:none}} .no{display:none}</style><p class=side>s<p class=no>x", "s"),
    ("<style>@media screen and (min-width: 40em){.x{display:none}}</style><p class=x>x<p>y", "y"),
    ("<style>@keyframes k{from{visibility:hidden}p{display:none}}@import 'a;b{';</style><p>y", "y"),
    ("<style>.tab{display:none} .tab.active{display:block}</style><p class=tab>a<p class='tab active'>b", "b"),
    ("<style>.tab.active{display:block} .tab{display:none}</style><p class=tab>a<p class='tab active'>b", "b"),
    ("<style>.a{display:none}.a{display:block}</style><p class=a>a", "a"),
    ("<style>.a{display:none!important}.a{display:block}</style><p class=a>a<p class=a style='display:block'>b<p>c", "c"),
    ("<style>.t{display:none}#w > .t{display:block} .t[data-on='1']{display:block}</style>"
     "<div id=w><p class=t>a</p><div><p class=t>b</p></div></div><p class=t data-on=1>c", "a\n\nc"),
    ("<style>.m{visibility:hidden}.m .v{visibility:visible}</style><div class=m>h<i class=v>v</i></div>", "v"),
    ("<style>.h{display:block}</style><p hidden class=h>a<p hidden>b", "a"),
    ("<body hidden>zz</body>", ""),
    ("<html hidden><body>zz", ""),
    ("<body hidden style='display:block'>zz", "zz"),
    ("<style>body{display:block}</style><body hidden>zz", "zz"),
    ("<body style='display:none'>zz", ""),
    ("<p title=it's>one</p><p>it's two", "one\n\nit's two"),
    ("<img alt=\"5\" tall\">one<p>two", "5one\n\ntwo"),
    ("<a href=x\"y>one</a> <a href='p>q' title=\"r>s\">two</a> <b \">three", "one two three"),
])
def test_shown_by_rules_and_stray_quotes(page, text):
    assert h.rendered(page) == text


def page_of(rng):
    """Random nested elements with classes, ids and attributes, under random rules."""
    def compound():
        return rng.choice(["", "p", "div", "i", "*"]) + rng.choice([".a", ".b", ".a.b", "#x", "[t]", "[t='1']"])

    def selector():
        return rng.choice([" ", ">", " > "]).join(compound() for _ in range(rng.randint(1, 3)))

    rules = "".join(f"{selector()},{selector()}{{{rng.choice(['display:none', 'display:block', 'visibility:hidden', 'visibility:visible'])}"
                    f"{rng.choice(['', '!important'])}}}" for _ in range(12))

    def element(depth):
        attrs = rng.choice(["", " class=a", " class='b a'", " class=b", " id=x", " id=y t", " t=1", " t=2 class=a", " style='display:block'"])
        inner = "".join(element(depth + 1) for _ in range(rng.randint(0, 3))) if depth < 5 else ""
        return f"<div{attrs}>{rng.randint(0, 999)}{inner}</div>"

    return f"<style>{rules}</style><body{rng.choice(['', ' class=a', ' id=x'])}>" + "".join(element(0) for _ in range(4))


def test_styles_against_every_rule_for_every_element(rng):
    """Elements that look alike are styled once; that changes nothing."""
    def each(tree):
        found, open_ = {}, [(tree.root, h.Node("body", tree.root.attrs), ("html", tree.root.attrs, None))]
        while open_:
            node, look, above = open_.pop()
            rules = [r for r in tree.rules if h._applies(r[0], look, above)]
            found[id(node)] = h.cascaded(h.weighed(rules), node)
            own = (look.tag, node.attrs, above)
            open_ += [(c, c, own) for c in node.children if isinstance(c, h.Node)]
        return found

    for _ in range(60):
        tree = h.Tree(page_of(rng))
        assert tree.rules and h.styles(tree) == each(tree)


def test_many_rules_for_many_elements():
    """Rules are not held against every element anew."""
    def seconds(n):
        page = "<style>" + "".join(f"p{{display:{'none' if i % 2 else 'block'}}}" for i in range(n)) + "</style>"
        page += "".join(f"<div title={i}><p title={i}>x</p></div>" for i in range(n))
        start = time.perf_counter()
        h.rendered(page)
        return time.perf_counter() - start

    seconds(200)
    assert seconds(4000) < 12 * max(seconds(1000), 0.05)


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_pages_keep_all_their_text(spark):
    """The pages have no tables and hide nothing but their heads, so another parser gives the same words."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in h.pages(pages).collect()}
    for r in pages.collect():
        plain = Plain()
        plain.feed(r["html"])
        plain.close()
        lines = [re.sub(r"^- ", "", x) for x in found[r["page_id"]].split("\n")]
        assert "".join("".join(lines).split()) == "".join("".join(plain.out).split())


def test_broken_markup_never_fails(rng):
    tags = "p div b ul li ol table tr td th a br h1 span tbody select option dl dt dd script pre button".split()
    for _ in range(1500):
        parts = [rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "txt ", " <", "&amp;", "<td colspan=3 rowspan=2>"])
                 for _ in range(rng.randint(0, 60))]
        h.rendered("".join(parts))
    assert h.rendered("<div>" * 20_000 + "x") == "x"
    assert "x" in h.rendered("<table><tr><td>" * 2_000 + "x")
    h.rendered("<a " * 20_000)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "t"), (None, None, "<p>x", "t"), (1, "u", "", "t")],
                                  "page_id long, url string, html string, text string")
    assert sorted((str(r["page_id"]), r["text"]) for r in h.pages(pages).collect()) == [("1", ""), ("1", ""), ("None", "x")]
    assert h.texts(pages).columns == ["page_id", "url", "html", "text"]
    assert h.pages(pages.limit(0)).collect() == []
