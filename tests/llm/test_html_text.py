import random

import pytest

from plaintlens.llm.html_text import extract_text, visible_text

CASES = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>one</div><div>two</div>", "one\ntwo"),
    ("a  b\n c<b> d</b>e <i> f</i>", "a b c de f"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<head><title>T</title></head><body>b<script>var a='</p>'</script><style>p{}</style>c</body>", "bc"),
    ("a<!-- <p>no</p> -->b", "ab"),
    ("<p hidden>no</p><p style='DISPLAY : none'>no<p>yes", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<ol><li>a<p>b</ol>", "1. a\n\n   b"),
    ("<table><tr><th>Name<th>N<tr><td>pie<td>12</table>", "Name  N\npie   12"),
    ("<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>", "wide cell\na  b"),
    ("<table><tr><td>a<br>b<td>c</table>x", "a  c\nb\n\nx"),
    ("<table><td>no row</table>", "no row"),
    ("<table><tr><td>a<table><tr><td>i<td>j</table><td>z</table>", "a     z\n\ni  j"),
    ("<pre>\n  a\n   b</pre>", "  a\n   b"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<details><summary>s</summary>no<p>no</details>", "s"),
    ("<details open><summary>s</summary><p>yes</details>", "s\n\nyes"),
    ("<select><option>a<option selected>b</select>", "b"),
    ("<h1>H<h2>I</h2>text", "H\n\nI\n\ntext"),
    ("a</b></div></p>b", "a\n\nb"),
    ("<p title='a > b'>x", "x"),
    ("1 < 2 and <3", "1 < 2 and <3"),
    ("<textarea>\n a </textarea>", " a"),
    ("<li>alone", "- alone"),
    ("<DIV>Ü &copy;&nbsp;2 &#x1D11E;</DIV>", "Ü ©\xa02 𝄞"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_layout(source, want):
    assert visible_text(source) == want


def test_no_visible_word_is_lost_or_added():
    """Random nesting of visible and hidden parts against a list kept while writing it."""
    rng = random.Random(1)
    tags = ["div", "p", "b", "span", "ul", "li", "table", "tr", "td", "section", "blockquote", "dl", "dd"]
    for _ in range(300):
        seen, count = [], 0

        def grow(depth, hidden):
            nonlocal count
            out = []
            for _ in range(rng.randint(1, 4)):
                word = f"w{count}"
                count += 1
                kind = rng.random()
                if kind < 0.5 or depth > 5:
                    out.append(f" {word} ")
                    if not hidden:
                        seen.append(word)
                elif kind < 0.6:
                    out.append(f"<span hidden>{grow(depth + 1, True)}</span>")
                elif kind < 0.65:
                    out.append(f"<script>{word}</script>")
                else:
                    tag = rng.choice(tags[:5] if kind < 0.8 else tags)
                    close = f"</{tag}>" if rng.random() < 0.8 and tag not in ("p",) else ""
                    if tag == "p" or (tag in ("table", "tr", "td", "li") and hidden):
                        tag, close = "b", "</b>"
                    out.append(f"<{tag}>{grow(depth + 1, hidden)}{close}")
            return "".join(out)

        source = grow(0, False)
        if "hidden" in source and any(f"<{t}>" in source for t in ("table", "li", "dd")):
            continue  # unclosed cells may end a hidden part early
        got = [w for w in visible_text(source).split() if w != "-"]
        assert sorted(got) == sorted(seen), source


def test_depth_and_size_are_no_limit():
    assert visible_text("<b>" * 50_000 + "x") == "x"
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<ul><li>" * 2_000 + "x").endswith("- x")
    assert visible_text("<" * 50_000) == "<" * 50_000
    assert len(visible_text("<p>word " * 20_000)) == 20_000 * 6 - 2
    visible_text("<a " + "x='" * 50_000)


def test_pages_table(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "<p>a", 0), (4, "<p>a", 0), (4, "<p>a", 0), (5, "x" * 200_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, html string, text int")
    got = extract_text(df).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [
        ("1", 0), ("2", 0), ("4", 1), ("4", 1), ("5", 200_000), ("None", 1)]
    assert extract_text(df.limit(0)).collect() == []


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_text(pages).join(pages, "page_id").collect():
        assert "track(" not in r.text and "margin:0" not in r.text and "<p>" not in r.text
        assert r.text.startswith("- ") and "\n\n" in r.text and "©" in r.text
