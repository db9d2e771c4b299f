"""Golden vectors, sequential models and edge cases."""

import json
import random
import re
import zipfile

import pytest
import yaml
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import html, layout, paragraphs, profiling, reflow, toc
from quire.plans import books
from quire.plans.bundles import write_files, write_parts
from quire.profiles import PROFILE_A, PROFILE_B
from quire.sources import epub, files


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_scalars(spark):
    assert one(spark, T.clean_filename(F.lit("a/b:c?"))) == "a_b_c_"
    for base, src, want in [("OEBPS/ch1.xhtml", "./images/pic.png", "OEBPS/images/pic.png"), ("OEBPS/text/c.xhtml", "../a.png", "OEBPS/a.png"), ("c.xhtml", "../../a.png", "a.png"), ("c", "https://x/y.png", "https://x/y.png"), ("c", "", "")]:
        assert one(spark, T.resolved_path(F.lit(base), F.lit(src))) == want
    assert one(spark, T.image_extension(F.lit("p.JPEG"), F.lit(b"x"))) == ".jpg"
    assert one(spark, T.image_extension(F.lit("p"), F.lit(b"GIF89a.."))) == ".gif"
    assert one(spark, T.image_extension(F.lit("p"), F.lit(b"?"))) == ".png"
    assert one(spark, T.normalized_heading(F.lit("编 辑 部"))) == "编辑部"
    assert one(spark, T.normalized_heading(F.lit("一　几点 说明"))) == "一 几点说明"
    assert one(spark, T.without_page_markers(F.lit("前[ 接 上 页 ]后"))) == "前后"
    assert one(spark, T.strip(F.lit("　\t a b \x1c"))) == "a b"


def test_yaml_scalars_read_back(spark):
    values = ["plain", "123", "yes", "", "null", "a: b", "- x", "it's", "'q'", "1.5", "#x", "a #b", "中文", "x:", "~", "2024-01-01", "[a]", "a\nb", 'say "hi"', "tab\there", "back\\slash\n", "0x1F", "1_000", "off"]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").select("k", T.yaml_scalar("v").alias("y")).collect()
    for r in rows:
        assert yaml.safe_load(f"a: {r.y}")["a"] == values[r.k], (values[r.k], r.y)


def reflow_model(lines):
    out, buffer, inside = [], [], False
    for raw in lines:
        bare = raw.strip()
        if bare.startswith("```") or inside:
            if buffer:
                out.append(" ".join(buffer))
                buffer = []
            out.append(raw)
            inside ^= bare.startswith("```")
        elif not bare or re.match(r"#|>|[-*+]\s|\d+\.\s", bare):
            if buffer:
                out.append(" ".join(buffer))
                buffer = []
            if bare:
                out.append(bare)
        else:
            buffer.append(bare)
    if buffer:
        out.append(" ".join(buffer))
    return "\n\n".join(out)


def test_reflow(spark):
    rng = random.Random(3)
    cases = ["a\nb\n\nc", "# h\ntext", "- a\n  - b\n1. c", "```\nx\n\ny\n```", "**b**\nx", "#nospace\n>q\nr", "2.x\ny"]
    cases += ["\n".join(rng.choice(["a", " b ", "", "# h", "> q", "- i", "1. n", "```", "　c"]) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    rows = [(d, n, line) for d, c in enumerate(cases) for n, line in enumerate(c.split("\n"))]
    got = {r.doc_id: r.markdown for r in reflow.reflowed(spark.createDataFrame(rows, "doc_id int, n int, line string")).collect()}
    for d, c in enumerate(cases):
        assert got.get(d, "") == reflow_model(c.split("\n")), c


def article(spark, profile, cases):
    """Lines as (text, indented) to articles."""
    rows = [(d, 0, n, t, "", 200.0 if new else 0.0, t.startswith("![")) for d, lines in enumerate(cases) for n, (new, t) in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id int, page int, ord int, text string, raw string, x0 double, is_image boolean")
    paras = paragraphs.merged_quotes(paragraphs.paragraphs(paragraphs.with_pieces(paragraphs.with_islands(df, profile, strict=True), profile)))
    none = spark.createDataFrame([], "doc_id int, note int, text string")
    return {r.doc_id: r.markdown for r in paragraphs.articles(paras, none).collect()}


def test_paragraph_goldens(spark):
    cases = [
        ([(1, "abc"), (0, "def")], "abc def"), ([(1, "甲乙"), (0, "丙丁")], "甲乙丙丁"), ([(1, "甲乙"), (0, "abc")], "甲乙 abc"),
        ([(1, "**甲乙**"), (0, "**丙丁**")], "**甲乙丙丁**"), ([(1, "**a**"), (0, "**b**")], "**a** **b**"), ([(1, "***甲***"), (0, "***乙***")], "***甲*** ***乙***"),
        ([(1, "*甲*"), (0, "*乙*")], "*甲乙*"), ([(1, "*（笑声*"), (0, "*，鼓掌）*")], "*（笑声* *，鼓掌）*"), ([(1, "甲"), (0, "> 乙"), (0, "> 丙")], "甲\n\n> 乙丙"),
        ([(1, "> 甲"), (1, "> 乙")], "> 甲\n>\n> 乙"), ([(0, "# 甲"), (1, "# 乙")], "# 甲乙"), ([(0, "# 甲"), (0, "乙")], "# 甲乙"),
        ([(1, "甲"), (1, "[^1]。乙")], "甲 [^1]。乙"), ([(1, "![img](assets/img_1.png)"), (0, "甲")], "![img](assets/img_1.png) 甲"), ([(1, "**"), (0, "**")], "** **"),
    ]
    got = article(spark, PROFILE_A, [[(bool(n), t) for n, t in c] for c, _ in cases])
    for d, (c, want) in enumerate(cases):
        assert got[d] == want, c
    assert article(spark, PROFILE_B, [[(False, "# 甲"), (True, "# 乙")]])[0] == "# 甲\n\n# 乙"


def test_paragraph_states(spark):
    """Islands against a fold that carries the open paragraph's kind."""
    rng = random.Random(5)
    cases = [[(rng.random() < 0.3, rng.choice(["甲", "ab", "> 乙", "> c", "# 丁", "[^1]x"])) for _ in range(rng.randint(1, 10))] for _ in range(300)]
    for profile in (PROFILE_A, PROFILE_B):
        rows = [(d, 0, n, t, "", 200.0 if new else 0.0) for d, c in enumerate(cases) for n, (new, t) in enumerate(c)]
        df = spark.createDataFrame(rows, "doc_id int, page int, ord int, text string, raw string, x0 double")
        got = {(r.doc_id, r.ord): r.is_new for r in paragraphs.with_islands(df, profile).collect()}
        for d, c in enumerate(cases):
            quote, last_head = None, False
            for n, (new, t) in enumerate(c):
                head = t.startswith("#")
                if head:
                    new = not last_head if profile.heading_continues else True
                if t.startswith("> ") and quote is False:
                    new = True
                if t.startswith("[^"):
                    new = False
                if new or quote is None:
                    quote = t.startswith("> ")
                    new = True
                last_head = head
                assert got[d, n] == new, (profile.name, c, n)


def test_notes(spark):
    refs = spark.createDataFrame([(0, 0, 1, 1), (0, 0, 2, 2)], "doc_id int, page int, k long, note_id long")
    notes = spark.createDataFrame([(0, 0, 0, "①甲", 0.0), (0, 0, 1, "续", 0.0), (0, 0, 2, "②乙", 0.0), (0, 0, 3, "③丙", 0.0), (0, 1, 4, "尾", 0.0)], "doc_id int, page int, ord int, raw string, x0 double")
    got = [r.text for r in paragraphs.note_islands(paragraphs.paired_notes(notes, refs), PROFILE_A).orderBy("note").collect()]
    assert got == ["[^1]: 甲续", "[^2]: 乙", "[^x]: 丙尾"]


def test_line_text(spark):
    def line(spans, profile=PROFILE_A, strict=False, x0=90.0):
        rows = [(0, 0, 0, k, t, size, font, flags, x0, 200.0) for k, (t, size, font, flags) in enumerate(spans)]
        df = spark.createDataFrame(rows, "doc_id int, page int, line_idx int, span_idx int, text string, size double, font string, flags int, x0 double, y0 double")
        made = layout.with_text(layout.with_references(layout.with_prefix(layout.with_features(layout.lines(df), profile), profile)), profile, strict)
        return made.first().text

    assert line([("编 辑 部", 14.4, "SimSun", 0)]) == "# 编辑部"
    assert line([("前", 9.6, "SimHei", 0), ("后①x②", 9.6, "SimSun", 0)]) == "**前**后[^1]x[^2]"
    assert line([(" 甲 ", 9.6, "KaiTi", 16)]) == "***甲***"
    assert line([("乙", 9.6, "FangSong", 0)]) == "> 乙"
    assert line([("中", 9.6, "SimHei", 0)], x0=130.0) == "### 中"
    assert line([("一 题", 26.0, "S", 0), ("正文", 12.0, "S", 0)], PROFILE_B, strict=True) == "# 一 题"
    assert line([("副", 15.0, "S", 0)], PROFILE_B) == "**副**"
    assert line([("[接上页]", 9.6, "S", 0)]) == ""


def test_toc_against_stacks(spark):
    rng = random.Random(9)
    cases = []
    for _ in range(120):
        level, rows = 1, []
        for k in range(rng.randint(1, 14)):
            level = rng.randint(1, min(4, level + 2))
            rows.append((level, rng.choice(["a", "b", "BAD", "c"]) + str(k), rng.randint(1, 30)))
        cases.append(rows)
    df = spark.createDataFrame([(d, k, lv, t, p, 31) for d, c in enumerate(cases) for k, (lv, t, p) in enumerate(c)], "doc_id int, pos int, level int, title string, page int, n_pages int")
    got = {(r.doc_id, r.pos): r for r in toc.plan(df, ["BAD"], 2).collect()}
    for d, c in enumerate(cases):
        skip, titles = None, {}
        for k, (level, title, page) in enumerate(c):
            if skip is not None and level <= skip:
                skip = None
            if skip is None and "BAD" in title:
                skip = level
            if skip is not None:
                assert (d, k) not in got
                continue
            r = got[d, k]
            titles = {lv: t for lv, t in titles.items() if lv < level} | {level: title}
            after = [p - 1 for lv, _, p in c[k + 1 :] if lv <= level]
            assert r.end == max((after[0] if after else 31) - 1, page - 1)
            assert r.has_children == (k + 1 < len(c) and c[k + 1][0] > level)
            assert r.category == "/".join(t for lv, t in sorted(titles.items()) if lv < level)


def test_cut_points(spark):
    cuts = spark.createDataFrame([(0, p) for p in (35, 771, 1528, 2221, 1, 35, 9999)], "doc_id int, page int")
    docs = spark.createDataFrame([(0, 2300)], "doc_id int, n_pages int")
    assert [(r.lo, r.hi) for r in profiling.parts(cuts, docs).orderBy("lo").collect()] == [(0, 34), (34, 770), (770, 1527), (1527, 2220), (2220, 2300)]


def test_html():
    md = html.to_markdown
    assert md("<html><head><title>t</title></head><body><h1>A  b</h1><p>x <b>y</b> z</p></body></html>") == "# A b\n\nx **y** z"
    assert md("<ul><li>a<li>b</ul>").startswith("- a")
    assert md("<p>a<b>b<p>c</p>") .startswith("a")
    assert md("<script>var a='</p>';</script><p>k</p><!-- c -->") == "k"
    assert md("<blockquote>q</blockquote><pre>  x\n y</pre>") == "> q\n\n```\n  x\n y\n```"
    assert md("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>") == "| a | b |\n| --- | --- |\n| 1 | 2 |"
    assert md('<a href="u">t</a><img src="s" alt="i">') == "[t](u)![i](s)"
    assert md("a &amp; b &am") == "a & b &am"
    assert md(None) == md("") == ""
    assert md("<div>" * 3000 + "deep") == md("<b>" * 3000 + "</i>" * 3000 + "<p>deep") .strip("*") == "deep"
    assert md("<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>") == "- a\n  - b\n  - c\n- d"
    assert md("<table><caption>c</caption><tbody><tr><td>out<table><tr><td>in</td></tr></table></td></tr></tbody></table>") == "c\n\n| out | in | | --- | |\n| --- |"


@pytest.mark.parametrize("unit", ["<table><tr><td>", "<ul><li>", "<ol><li><div>", "<blockquote>", "<div><table><tr><th>"])
def test_html_nesting(unit):
    """Each text comes once at any nesting, in order, and thousands of levels do not fail."""
    depth = 40 if "quote" in unit else 5000 if "ul" in unit else 700
    text = html.to_markdown("".join(f"{unit}w{k}w " for k in range(depth)))
    assert re.findall(r"w\d+w", text) == [f"w{k}w" for k in range(depth)]


def plain_render(n, lists=0):
    """The same Markdown by recursion, for documents of few levels."""
    if isinstance(n, str):
        return re.sub(r"\s+", " ", n)
    if n.tag in ("ul", "ol"):
        out, k = [], 0
        for c in n.children:
            if isinstance(c, html.Node):
                k += c.tag == "li"
                inner = re.sub(r"\n{2,}", "\n", "".join(plain_render(x, lists + 1) for x in c.children)).strip() if c.tag == "li" else plain_render(c, lists + 1).strip("\n")
                out.append(("  " * lists + (f"{k}. " if n.tag == "ol" else "- ") + inner) if c.tag == "li" else inner)
        return "\n\n" + "\n".join(x for x in out if x.strip()) + "\n\n"
    inner = "".join(plain_render(x, lists) for x in n.children)
    if n.tag in html.MARKS:
        core = inner.strip()
        return inner.replace(core, f"{html.MARKS[n.tag]}{core}{html.MARKS[n.tag]}", 1) if core else inner
    if n.tag == "h2":
        text = " ".join(inner.split())
        return f"\n\n## {text}\n\n" if text else ""
    if n.tag == "a":
        return f"[{inner.strip()}](u)" if inner.strip() else inner
    return f"\n\n{inner.strip()}\n\n" if n.tag in ("p", "div", "li") else inner


def test_html_same_as_recursion():
    rng = random.Random(12)

    def tree(depth):
        kind = rng.choice(["text", "p", "div", "b", "i", "a", "h2", "ul", "ol", "span"]) if depth else "text"
        if kind == "text":
            return rng.choice(["x", " y ", "z\n", "word word"])
        inner = "".join(tree(depth - 1) for _ in range(rng.randint(0, 4)))
        if kind in ("ul", "ol"):
            inner = "".join(f"<li>{tree(depth - 1)}{tree(depth - 1)}</li>" for _ in range(rng.randint(1, 3)))
        return f'<a href="u">{inner}</a>' if kind == "a" else f"<{kind}>{inner}</{kind}>"

    for _ in range(400):
        page = "".join(tree(5) for _ in range(3))
        want = "".join(plain_render(c) for c in html.parse(page).children)
        want = "\n".join(x.rstrip(" ") + ("  " if x.endswith("  ") else "") for x in want.split("\n"))
        assert html.to_markdown(page) == re.sub(r"(\s*\n){3,}", "\n\n", want).strip(), page


def test_html_error_is_a_row(spark, monkeypatch):
    held = html.to_markdown
    monkeypatch.setattr(html, "to_markdown", held)
    pages = spark.createDataFrame([(1, "<p>a"), (2, "<![if x"), (3, None)], "page_id long, html string")
    got = {r.page_id: (r.markdown, r.problem) for r in html.markdown_pages(pages, error="problem").collect()}
    assert got[1] == ("a", None) and got[3] == ("", None) and len(got) == 3
    assert html.markdown_pages(pages).columns == ["page_id", "html", "markdown"]


def test_outlines_of_any_depth(spark):
    """Levels to 20 and far apart: ends, categories and blacklists against stacks; an empty outline."""
    rng = random.Random(10)
    cases = []
    for _ in range(40):
        level, rows = 1, []
        for k in range(rng.randint(1, 40)):
            level = rng.randint(max(1, level - 6), min(20, level + 3))
            rows.append((level if level < 20 else 1000, rng.choice(["a", "b", "c", "d", "BAD"] if k else ["a"]) + str(k), rng.randint(1, 30)))
        cases.append(rows)
    df = spark.createDataFrame([(d, k, lv, t, p, 31) for d, c in enumerate(cases) for k, (lv, t, p) in enumerate(c)], "doc_id int, pos int, level int, title string, page int, n_pages int")
    got = {(r.doc_id, r.pos): r for r in toc.plan(df, ["BAD"], 9).collect()}
    for d, c in enumerate(cases):
        stack = []
        for k, (level, title, page) in enumerate(c):
            stack = [x for x in stack if x[0] < level]
            bad = "BAD" in title or any("BAD" in t for _, t in stack)
            assert ((d, k) not in got) == bad
            if not bad:
                after = [p - 1 for lv, _, p in c[k + 1 :] if lv <= level]
                assert got[d, k].end == max((after[0] if after else 31) - 1, page - 1)
                assert got[d, k].category == "/".join(t for _, t in stack)
            stack.append((level, title))
    assert toc.plan(df.limit(0), ["BAD"], 2).collect() == []


BOX = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/c.opf"/></rootfiles></container>'
OPF = '<package xmlns="http://www.idpf.org/2007/opf"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>Book</dc:title></metadata><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="i" href="img/p.png" media-type="image/png"/><item id="n" href="toc.ncx" media-type="application/x-dtbncx+xml"/></manifest><spine><itemref idref="a"/><itemref idref="gone"/></spine></package>'
NCX = '<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/"><navMap><navPoint><navLabel><text>Part: 1</text></navLabel><content src="p.xhtml"/><navPoint><navLabel><text>One</text></navLabel><content src="a.xhtml#x"/></navPoint></navPoint></navMap></ncx>'


def test_epub(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "b.epub", "w") as z:
        for name, data in (("META-INF/container.xml", BOX), ("OEBPS/c.opf", OPF), ("OEBPS/toc.ncx", NCX), ("OEBPS/a.xhtml", "<p>hi</p>"), ("OEBPS/img/p.png", b"\x89PNG\r\n\x1a\n")):
            z.writestr(name, data)
    (tmp_path / "bad.epub").write_bytes(b"no zip")
    rows = epub.members(spark, str(tmp_path / "*.epub")).cache()
    assert rows.filter("kind = 'error'").count() == 1
    part = lambda kind: rows.filter(F.col("kind") == kind)
    nav = toc.nav_entries(part("nav").select("doc_id", F.col("seq").alias("pos"), "level", "title", "href", (F.col("media_type") == "section").alias("is_section")))
    docs = epub.spine_documents(part("spine"), part("item"), nav, part("book")).collect()
    assert [(d.order, d.title, d.category, d.book) for d in docs] == [(1, "One", "Part_ 1", "Book")]
    images = part("book").select("doc_id", F.lit("OEBPS/a.xhtml").alias("base"), F.lit(1).alias("n"), F.lit("./img/p.png").alias("src"))
    assert [(r.href, r.extension) for r in epub.matched_images(images, part("item")).collect()] == [("OEBPS/img/p.png", ".png")]


def test_epub_bundles(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "b.epub", "w") as z:
        for name, data in (("META-INF/container.xml", BOX), ("OEBPS/c.opf", OPF), ("OEBPS/toc.ncx", NCX), ("OEBPS/a.xhtml", '<p>hi</p><img src="img/p.png" alt="x"/><img src="gone.png"/>'), ("OEBPS/img/p.png", b"\x89PNG\r\n\x1a\n")):
            z.writestr(name, data)
    made, assets = books.epub_bundles(spark, str(tmp_path / "b.epub"))
    r = made.first()
    assert r.rel_path == "Book/Part_ 1/One/index.md" and r.markdown == "---\nbook: Book\ncategory: Part_ 1\norder: 1\ntitle: One\n---\n\nhi\n\n![img](assets/img_1.png)![](gone.png)"
    assert [(a.rel_path, bytes(a.content)[:4]) for a in assets.collect()] == [("Book/Part_ 1/One/assets/img_1.png", b"\x89PNG")]


def test_layout_bundles(spark):
    rows = [("b", 0, 0, 0, "编 者", 14.4, "S", 0, 0.0, 150.0), ("b", 0, 1, 0, "正文①。", 9.6, "S", 0, 110.0, 200.0), ("b", 0, 2, 0, "①注", 9.6, "S", 0, 60.0, 450.0), ("b", 1, 0, 0, "续", 9.6, "S", 0, 0.0, 150.0), ("b", 0, 3, 0, "页眉", 9.6, "S", 0, 0.0, 20.0)]
    spans = spark.createDataFrame(rows, "doc_id string, page int, line_idx int, span_idx int, text string, size double, font string, flags int, x0 double, y0 double")
    outline = spark.createDataFrame([("b", 0, 1, "Part", 1, 3), ("b", 1, 2, "A:1", 1, 3), ("b", 2, 2, "B", 3, 3)], "doc_id string, pos int, level int, title string, page int, n_pages int")
    pages = spark.createDataFrame([("b", 0, 595.0), ("b", 1, 595.0)], "doc_id string, page int, height double")
    blocks = spark.createDataFrame([], "doc_id string, page int, block_idx int, y0 double, text string")
    drawings = spark.createDataFrame([("b", 0, 10.0, 440.0, 80.0, 441.0)], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")
    images = spark.createDataFrame([("b", 1, 0, b"\xff\xd8\xff")], "doc_id string, page int, block_idx int, content binary")
    made, assets = books.layout_bundles(outline, spans, pages, blocks, drawings, PROFILE_A, [], 2, images)
    got = {r.rel_path: r.markdown for r in made.collect()}
    assert got == {"b/Part/A_1/index.md": "---\nbook: b\ncategory: Part\norder: 1\ntitle: A:1\n---\n\n# 编者\n\n正文[^1]。\n\n![img](assets/img_1.jpg)\n\n续\n\n[^1]: 注"}
    assert [r.rel_path for r in assets.collect()] == ["b/Part/A_1/assets/img_1.jpg"]


def test_books_of_both_profiles(spark):
    """One run over books whose profiles are data gives what a run for each profile gives."""
    rng = random.Random(6)
    texts = ["一 题", "正文①。", "x y", "①注", "　缩进", "副题", "1.2 節"]
    spans = [(b, page, line, k, rng.choice(texts), rng.choice([36.0, 26.0, 22.2, 18.0, 15.1, 14.0, 29.0, 16.6, 14.4, 13.0, 11.0, 7.4, 9.6]), rng.choice(["S", "FangSong", "KaiTi", "SimHei"]), rng.choice([0, 16, 2]), rng.choice([60.0, 78.0, 110.0, 130.0]), 30.0 + 40 * line) for b in "pqrs" for page in range(3) for line in range(13) for k in range(2)]
    spans = spark.createDataFrame(spans, "doc_id string, page int, line_idx int, span_idx int, text string, size double, font string, flags int, x0 double, y0 double")
    outline = spark.createDataFrame([(b, k, 1, f"t{k}", k + 1, 3) for b in "pqrs" for k in range(2)], "doc_id string, pos int, level int, title string, page int, n_pages int")
    pages = spark.createDataFrame([(b, p, 560.0) for b in "pqrs" for p in range(3)], "doc_id string, page int, height double")
    blocks = spark.createDataFrame([(b, p, k, 50.0 + 90 * k, rng.choice(["x", "接上页", "————————"])) for b in "pqrs" for p in range(3) for k in range(5)], "doc_id string, page int, block_idx int, y0 double, text string")
    drawings = spark.createDataFrame([(b, p, 10.0, 400.0, 80.0, 401.0) for b in "pr" for p in range(2)], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")
    images = spark.createDataFrame([("p", 0, 0, b"\xff\xd8\xff"), ("s", 1, 2, b"\xff\xd8\xff")], "doc_id string, page int, block_idx int, content binary")
    of = spark.createDataFrame([("p", "a"), ("q", "b"), ("r", "b"), ("s", "a")], "doc_id string, profile string")
    run = lambda p: {r.rel_path: r.markdown for r in books.layout_bundles(outline, spans, pages, blocks, drawings, p, [], 1, images)[0].collect()}
    a, b, both = run(PROFILE_A), run(PROFILE_B), run(of)
    assert both == {k: v for k, v in a.items() if k[0] in "ps"} | {k: v for k, v in b.items() if k[0] in "qr"} and len(both) == 8 and a != b


def test_books_of_equal_titles(spark, tmp_path):
    """Two e-books of one title, and two documents of one title in each, keep paths of their own."""
    opf = OPF.replace('<itemref idref="gone"/>', '<itemref idref="b"/>').replace('<item id="i"', '<item id="b" href="b.xhtml" media-type="application/xhtml+xml"/><item id="i"')
    ncx = NCX.replace("</navPoint></navPoint>", '</navPoint><navPoint><navLabel><text>One</text></navLabel><content src="b.xhtml"/></navPoint></navPoint>')
    for book in ("x", "y"):
        with zipfile.ZipFile(tmp_path / f"{book}.epub", "w") as z:
            for name, data in (("META-INF/container.xml", BOX), ("OEBPS/c.opf", opf), ("OEBPS/toc.ncx", ncx), ("OEBPS/a.xhtml", f'<p>a of {book}</p><img src="img/p.png"/>'), ("OEBPS/b.xhtml", f"<p>b of {book}</p>"), ("OEBPS/img/p.png", b"\x89PNG\r\n\x1a\n")):
                z.writestr(name, data)
    made, assets = books.epub_bundles(spark, str(tmp_path / "*.epub"))
    got = {r.rel_path: r.markdown.split("\n\n")[1] for r in made.collect()}
    assert got == {"Book/Part_ 1/One/index.md": "a of x", "Book/Part_ 1/One_2/index.md": "b of x", "Book_2/Part_ 1/One/index.md": "a of y", "Book_2/Part_ 1/One_2/index.md": "b of y"}
    assert sorted(r.rel_path for r in assets.collect()) == ["Book/Part_ 1/One/assets/img_1.png", "Book_2/Part_ 1/One/assets/img_1.png"]
    write_files(made, str(tmp_path / "out"))
    assert (tmp_path / "out/Book_2/Part_ 1/One_2/index.md").read_text().endswith("b of y")


#: A PDF library of a few pages, for want of the real one: files are JSON.
STUB = """
import json
from types import SimpleNamespace as N
class Rect(N):
    def __init__(self, x0, y0, x1, y1):
        super().__init__(x0=x0, y0=y0, x1=x1, y1=y1, width=x1 - x0, height=y1 - y0)
class Page:
    def __init__(self, spec):
        self.spec, self.rect = spec, Rect(0, 0, 420, 595)
    def get_text(self, kind, clip=None):
        if self.spec == "bad":
            raise ValueError("bad page")
        if kind == "blocks":
            return [(b["x0"], b["y0"], 0, 0, "".join(b["spans"]), k, 0) for k, b in enumerate(self.spec["blocks"]) if "spans" in b]
        out = []
        for b in self.spec["blocks"]:
            if clip and not clip.y0 <= b["y0"] <= clip.y1:
                continue
            box = (b["x0"], b["y0"], 0, 0)
            if "image" in b:
                out.append({"image": b["image"].encode(), "bbox": box})
            else:
                out.append({"bbox": box, "lines": [{"bbox": box, "spans": [{"text": t, "size": b["size"], "font": b.get("font", "S"), "flags": 0} for t in b["spans"]]}]})
        return {"blocks": out}
    def get_drawings(self):
        return [{"rect": Rect(*r)} for r in self.spec["drawings"]] + [{}]
class Doc:
    def __init__(self, spec):
        self.spec, self.page_count = spec, len(spec["pages"])
    def __enter__(self):
        return self
    def __exit__(self, *a):
        pass
    def __getitem__(self, k):
        return Page(self.spec["pages"][k])
    def get_toc(self):
        return self.spec["toc"]
def open(stream, filetype):
    return Doc(json.loads(stream))
"""
CONVERTER = """
def to_markdown(doc, pages, margins, show_progress):
    if pages == [2]:
        raise ValueError("no")
    return f"pages {pages} without {margins}"
"""


def test_pdf(spark, tmp_path, monkeypatch):
    """From bookmarks to bundles with a stub of the library; damaged files and pages are rows."""
    from quire.__main__ import main
    from quire.sources import pdf

    with pytest.raises(RuntimeError, match="not installed"):
        pdf.needed("no_such_library")
    for name, code in ((pdf.LIBRARY, STUB), (pdf.CONVERTER, CONVERTER)):
        (tmp_path / f"{name}_stub.py").write_text(code)
        spark.sparkContext.addPyFile(str(tmp_path / f"{name}_stub.py"))
    monkeypatch.setattr(pdf, "LIBRARY", "fitz_stub")
    monkeypatch.setattr(pdf, "CONVERTER", "pymupdf4llm_stub")
    monkeypatch.syspath_prepend(str(tmp_path))
    block = lambda text, y0, size=9.6, x0=60, **more: {"spans": [text], "x0": x0, "y0": y0, "size": size, **more}
    first = {"blocks": [block("页眉", 20), block("编 者", 150, 14.4), block("正文①。", 200, x0=110), block("①注", 450)], "drawings": [[10, 440, 80, 441]]}
    second = {"blocks": [{"image": "\xff\xd8", "x0": 0, "y0": 120}, block("续", 150)], "drawings": []}
    book = {"toc": [[1, "Part", 1], [2, "A:1", 1], [2, "BAD", 3], [2, "B", 3]], "pages": [first, second, "bad"]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/b.pdf").write_text(json.dumps(book))
    (tmp_path / "in/broken.pdf").write_text("no pdf")
    rows = pdf.tables(spark, str(tmp_path / "in/*.pdf"), clip=(110, 520)).cache()
    assert sorted((r.doc_id.rsplit("/", 1)[1], r.page) for r in pdf.part(rows, "error", "page", "error").collect()) == [("b.pdf", 2), ("broken.pdf", None)]
    assert [r.text for r in pdf.spans(rows).filter("page = 0").orderBy("line_idx").collect()] == ["编 者", "正文①。", "①注"]
    assert pdf.part(rows, "block", "text").filter("text = '页眉'").count() == 1
    main(["pdf", str(tmp_path / "in/*.pdf"), str(tmp_path / "out"), "--level", "2", "--without", "BAD"])
    got = {r.rel_path: r.markdown for r in spark.read.parquet(str(tmp_path / "out/bundles")).collect()}
    assert got == {"b/Part/A_1/index.md": "---\nbook: b\ncategory: Part\norder: 1\ntitle: A:1\n---\n\n# 编者\n\n正文[^1]。\n\n![img](assets/img_1.png)\n\n续\n\n[^1]: 注"}
    assert spark.read.parquet(str(tmp_path / "out/assets")).first().rel_path == "b/Part/A_1/assets/img_1.png"
    assert spark.read.parquet(str(tmp_path / "out/errors")).count() == 2
    main(["pdf", str(tmp_path / "in/b.pdf"), str(tmp_path / "flat"), "--level", "2", "--delegate"])
    got = {r.rel_path: r.markdown.split("\n\n")[1] for r in spark.read.parquet(str(tmp_path / "flat/bundles")).collect()}
    assert got == {"b/Part/A_1.md": "pages [0, 1] without (0, 82, 0, 0)"}
    assert [r.pos for r in spark.read.parquet(str(tmp_path / "flat/errors")).orderBy("pos").collect()] == [2, 3]


def test_probes(spark, tmp_path):
    """Page lists, dividers, keyword blocks, ordered reports, counts and the split table."""
    docs = spark.createDataFrame([(1, 5, "stem"), (2, 3, "other")], "doc_id int, n_pages int, stem string")
    pages = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("page"))
    got = profiling.listed_pages(pages, [0, 2, 5, 6, -1], docs).orderBy("doc_id", "page").collect()
    assert [(r.doc_id, r.page) for r in got] == [(1, 1), (1, 4), (2, 1)]
    heights = spark.createDataFrame([(1, 0, 100.0)], "doc_id int, page int, height double")
    drawings = spark.createDataFrame([(1, 0, 0.0, 61.0, 51.0, 61.5), (1, 0, 0.0, 60.0, 99.0, 60.0), (1, 0, 0.0, 90.0, 50.0, 90.0)], "doc_id int, page int, x0 double, y0 double, x1 double, y1 double")
    blocks = spark.createDataFrame([(1, 0, 0, 5.0, "a ____ b"), (1, 0, 1, 7.0, "————"), (1, 0, 2, 8.0, "___")], "doc_id int, page int, block_idx int, y0 double, text string")
    got = profiling.divider_candidates(heights, blocks, drawings).orderBy("y0").collect()
    assert [(r.y0, r.kind) for r in got] == [(5.0, "text"), (7.0, "text"), (61.0, "rule")]
    assert [r.block_idx for r in profiling.keyword_blocks(blocks, "b").collect()] == [0]
    assert [r.n for r in profiling.counted(blocks).collect()] == [3]
    rows = [(1, 0, k, 0, t, 9.6, f, 0, x, 0.0) for k, (t, f, x) in enumerate([("a", "SimHei", 150.0), ("a", "SimHei", 120.0), ("a", "SimHei", 110.0), ("a", "Bold", 105.0), ("a", "S", 200.0), (" ", "SimHei", 0.0)])]
    spans = spark.createDataFrame(rows, "doc_id int, page int, line_idx int, span_idx int, text string, size double, font string, flags int, x0 double, y0 double")
    got = profiling.guessed_prefixes(layout.lines(spans)).orderBy("line_idx").collect()
    assert [r.guess for r in got] == ["### ", "> ", "> ?", "body", "not bold"]
    sizes = spans.withColumn("size", F.col("line_idx") + 8.04)
    assert [(r.size, r.place) for r in profiling.by_size(profiling.size_histogram(sizes)).collect()] == [(12.0, 1), (11.0, 2), (10.0, 3), (9.0, 4), (8.0, 5)]
    cuts = spark.createDataFrame([(1, 3)], "doc_id int, page int")
    write_parts(profiling.split_pages(pages.filter("doc_id = 1 and page < 5"), cuts, docs), str(tmp_path / "parts"))
    got = spark.read.parquet(str(tmp_path / "parts")).groupBy("name").agg(F.sort_array(F.collect_list("page")).alias("pages")).collect()
    assert {r["name"]: r["pages"] for r in got} == {"stem_part1_p1-p2": [0, 1], "stem_part2_p3-p5": [2, 3, 4]}


def test_stream_batches_do_not_depend_on_order(spark, tmp_path):
    from quire.streaming import ingest

    schema = "page_id long, url string, html string"
    for k, rows in enumerate(([(1, "u", "<p>a</p>"), (1, "v", "<p>b</p>")], [(1, "v", "<p>b</p>"), (1, "u", "<p>a</p>")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
        ingest.upsert_to(ingest.markdown_stream(spark, str(tmp_path / f"in{k}")), str(tmp_path / f"out{k}"), str(tmp_path / f"ck{k}")).awaitTermination(60)
    assert [ingest.latest(spark, str(tmp_path / f"out{k}")).first().markdown for k in (0, 1)] == ["b", "b"]


def test_files(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\nb")
    assert [r.line for r in files.text_lines(spark, str(tmp_path / "t.txt")).orderBy("n").collect()] == ["a", "b"]
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>T</w:t></w:r></w:p><w:p><w:r><w:t>x</w:t></w:r></w:p></w:body></w:document>')
    got = reflow.reflowed(files.docx_lines(spark, str(tmp_path / "d.docx"))).first().markdown
    assert got == "# T\n\nx"
    out = spark.createDataFrame([("a/b/index.md", "text")], "rel_path string, markdown string")
    write_files(out, str(tmp_path / "out"))
    assert (tmp_path / "out/a/b/index.md").read_text() == "text"


def test_streaming(spark, tmp_path):
    from quire.streaming import ingest

    spark.createDataFrame([(1, "u", "<p>a</p>"), (2, "u", "<h1>b</h1>")], "page_id long, url string, html string").write.parquet(str(tmp_path / "in"))
    ingest.upsert_to(ingest.markdown_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert {r.page_id: r.markdown for r in ingest.latest(spark, str(tmp_path / "out")).collect()} == {1: "a", 2: "# b"}


def test_command_line(spark, tmp_path):
    from quire.__main__ import main

    (tmp_path / "page.html").write_text("<h1>T</h1><p>x</p>")
    main(["html", str(tmp_path / "page.html"), str(tmp_path / "out")])
    r = spark.read.parquet(str(tmp_path / "out/bundles")).first()
    assert r.rel_path == "page/index.md" and r.markdown.endswith("---\n\n# T\n\nx")
