from html.parser import HTMLParser

import pytest

from rollcall.llm.html_text import extract, parse, text_of


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain", "plain"), ("a<b", "a"), ("<", "<"), ("1 < 2 & 3", "1 < 2 & 3"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a\n  b\t<b> c</b>d", "a b cd"), ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>a<li>b<ol start=9><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  9. c\n  10. d\n- e"),
    ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n    d1\n    d2"),
    ("<table><tr><th>a<th>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td colspan=2>w</table>", "r  1\n   2\nw"),
    ("<td>x<td>y", "x\ny"), ("<table><td>x<td>y</table>", "x  y"),
    ("<table><tr><td>a<table><tr><td>i<td>j</table><td>b</table>", "a     b\n\ni  j"),
    ("<pre>\n a\n  b </pre>c", " a\n  b\n\nc"), ("<textarea>a <b></textarea>", "a <b>"),
    ("<title>t</title><style>p{}</style><script>'</p>'</script>x", "x"),
    ("<head>early text<p>b", "early text\n\nb"), ("<noscript>n</noscript>", "n"),
    ("<p hidden>a</p><p style='color:red; DISPLAY : none'>b</p><p style='x-display:none'>c", "c"),
    ("<span style=visibility:hidden>a</span>b", "b"), ("<body hidden>a", ""),
    ("<details><summary>s</summary>d</details>", "s"), ("<dialog>a</dialog>b", "b"),
    ("<details open><summary>s</summary>d</details>", "s\nd"),
    ("<!-- a > b -->c<!-->d<!x>e<?y>f</1>g", "cdefg"), ("<!-- open", ""),
    ("<a title='x>y'>l</a>", "l"), ("<a title=\"x>y", "y"), ("&copy;&#65;&am;&nbsp;x", "©A&am;\xa0x"),
    ("</p>a</div></b>b", "ab"), ("a</p>b", "a\n\nb"), ("<b><p>x</b>y<p>z", "xy\n\nz"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<script>never closed", ""),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("<h1>a<h2>b</h1>c", "a\n\nb\n\nc"),
])
def test_rules(html, text):
    assert text_of(html) == text


def test_implied_tags():
    table = parse("<table><td>x").children[0]
    assert [table.tag, table.children[0].tag, table.children[0].children[0].tag] == \
        ["table", "tbody", "tr"]


def test_long_and_deep_pages_end():
    assert text_of("<b>" * 30000 + "x") == "x"
    assert text_of("<table><tr><td>" * 2000 + "x").strip() == "x"
    assert text_of("<p>" + "word " * 50000).count("word") == 50000
    assert text_of("<div " + "a='" * 5000) == ""
    wide = "<table><tr><td>" + "y" * 5000 + "<td>b" + "<tr><td>c<td>d" * 500 + "</table>"
    assert len(text_of(wide)) < 60000


class Plain(HTMLParser):
    """A second reading of pages made of few elements: words between line-making tags."""

    def __init__(self):
        super().__init__()
        self.lines, self.mute = [[]], 0

    def handle_starttag(self, tag, attributes):
        if tag in ("script", "style", "title"):
            self.mute += 1
        if tag not in ("a", "b", "meta", "script", "style", "title"):
            self.lines.append([])
            if tag == "li":
                self.lines[-1].append("-")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.mute -= 1
        elif tag not in ("a", "b"):
            self.lines.append([])

    def handle_data(self, data):
        if not self.mute:
            self.lines[-1] += data.split()


def test_pages_equal_a_second_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in extract(pages).collect():
        plain = Plain()
        plain.feed(row["html"])
        plain.close()
        want = [" ".join(x) for x in plain.lines if x]
        assert [" ".join(x.split()) for x in row["text"].split("\n") if x.strip()] == want


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "old"), (1, None, "old"), (None, "<p>a", None), (2, "", "x")]
    got = extract(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert got.columns == ["page_id", "html", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, None, None), (1, None, None), (None, "<p>a", "a"), (2, "", "")], key=str)
    assert extract(spark.createDataFrame([], "html string")).collect() == []


@pytest.mark.parametrize("html, text", [
    ("<table><form><tr><td>x</table>", "x"), ("<table><font><tr><td>x</table>", "x"),
    ("<table><tr><form><td>x</td></form></tr></table>", "x"),
    ("<table><colgroup><col><tr><td>x</table>", "x"), ("<table><caption>c<tr><td>x</table>", "c\nx"),
    ("<table><colgroup><col><td>x<td>y</table>", "x  y"),
    ("<table><div>a</div><tr><b>b</b><td>x</table>", "a\nb\n\nx"),
    ("<table>a<tbody>b<tr>c<td>x</table>d", "abc\n\nx\n\nd"), ("<table><colgroup>a<tr><td>x</table>", "a\n\nx"),
    ("<table><tr><td>x<tr><caption>c</caption><tr><td>y</table>", "c\nx\ny"),
    ("<table><tr><table><tr><td>y</table>z", "y\n\nz"), ("<b><table><p>a</b>b<td>x</table>", "ab\n\nx"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>t</annotation></math> y", "x=1 y"),
    ("<svg><defs/><title>t</title>no<text>a</text><path/><text>b</text><desc>d</desc></svg>c", "a bc"),
])
def test_no_visible_word_of_misnested_tables_is_lost(html, text):
    assert text_of(html) == text


def test_words_of_random_tables_stay():
    import random
    r = random.Random(5)
    tags = "table tr td th tbody thead caption colgroup col form div b font p li ul span".split()
    for _ in range(3000):
        parts, want = [], []
        for k in range(r.randrange(3, 25)):
            parts.append(f"<{r.choice(['', '', '/'])}{r.choice(tags)}>")
            if r.random() < .5:
                parts.append(f" w{k} ")
                want.append(f"w{k}")
        assert sorted(text_of("".join(parts)).replace("-", " ").split()) == sorted(want), parts
