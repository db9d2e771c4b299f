"""Addresses, depth and damage of e-books and word-processor files; what the command line says of it."""

import zipfile

from pyspark.sql import functions as F

from quire import __main__ as command
from quire.operators import layout
from quire.plans import books
from quire.profiles import PROFILE_A, PROFILE_B
from quire.sources import epub, epub_format, files, pdf

BOX = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/c.opf"/></rootfiles></container>'
WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def book(path, ncx, members, manifest, spine):
    opf = f"<package><metadata><title>Book</title></metadata><manifest>{manifest}<item id='n' href='toc.ncx' media-type='application/x-dtbncx+xml'/></manifest><spine>{spine}</spine></package>"
    with zipfile.ZipFile(path, "w") as z:
        for name, data in {"META-INF/container.xml": BOX, "OEBPS/c.opf": opf, "OEBPS/toc.ncx": ncx, **members}.items():
            z.writestr(name, data)


def test_encoded_addresses(spark, tmp_path):
    point = lambda t, src: f"<navPoint><navLabel><text>{t}</text></navLabel><content src='{src}'/></navPoint>"
    book(
        tmp_path / "a.epub", "<ncx><navMap>" + point("One", "ch%201.xhtml#x") + point("Two", "b%25c.xhtml") + point("Three", "d%2Ae.xhtml") + "</navMap></ncx>",
        {"OEBPS/ch 1.xhtml": '<p>first</p><img src="p%C3%A9+%20q.png"/>', "OEBPS/b%25c.xhtml": "<p>second</p>", "OEBPS/d*e.xhtml": "<p>third</p>", "OEBPS/pé+ q.png": b"\x89PNG\r\n\x1a\n"},
        "<item id='a' href='ch%201.xhtml' media-type='application/xhtml+xml'/><item id='b' href='b%25c.xhtml' media-type='application/xhtml+xml'/><item id='c' href='d%2Ae.xhtml' media-type='application/xhtml+xml'/><item id='i' href='p%C3%A9+%20q.png' media-type='image/png'/>",
        "<itemref idref='a'/><itemref idref='b'/><itemref idref='c'/>",
    )
    made, assets = books.epub_bundles(spark, str(tmp_path / "*.epub"))
    got = {r.rel_path: r.markdown.split("---\n\n")[1] for r in made.collect()}
    assert sorted(got) == ["Book/Book/One/index.md", "Book/Book/Three/index.md", "Book/Book/Two/index.md"] and got["Book/Book/Two/index.md"] == "second" and got["Book/Book/Three/index.md"] == "third"
    assert got["Book/Book/One/index.md"].startswith("first") and "assets/img_1.png" in got["Book/Book/One/index.md"]
    assert [r.rel_path for r in assets.collect()] == ["Book/Book/One/assets/img_1.png"]


def test_navigation_of_two_thousand_levels(spark, tmp_path):
    n = 2000
    ncx = "<ncx><navMap>" + "".join(f"<navPoint><navLabel><text>t{k}</text></navLabel><content src='{k}.xhtml'/>" for k in range(n)) + "</navPoint>" * n + "</navMap></ncx>"
    book(tmp_path / "deep.epub", ncx, {}, "", "")
    rows = epub.members(spark, str(tmp_path / "deep.epub"))
    assert epub.errors(rows).count() == 0
    nav = epub.parts(rows)[2].collect()
    assert [(r.href, r.title) for r in nav] == [(f"OEBPS/{n - 1}.xhtml", f"t{n - 1}")] and nav[0].category.startswith("t0/t1/") and nav[0].category.count("/") == n - 2


def docx(path, body, numbering=None):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {WORD}><w:body>{body}</w:body></w:document>")
        if numbering:
            z.writestr("word/numbering.xml", f"<w:numbering {WORD}>{numbering}</w:numbering>")


def test_word_processor_files(spark, tmp_path):
    run = lambda t, p="": f"<w:r><w:rPr>{p}</w:rPr><w:t>{t}</w:t></w:r>"
    entry = lambda t, n, level: f"<w:p><w:pPr><w:numPr><w:ilvl w:val='{level}'/><w:numId w:val='{n}'/></w:numPr></w:pPr>{run(t)}</w:p>"
    cell = lambda t: f"<w:tc><w:p>{run(t)}</w:p></w:tc>"
    body = (
        f"<w:p><w:pPr><w:pStyle w:val='Heading2'/></w:pPr>{run('Title')}</w:p>"
        f"<w:p>{run('plain ')}{run('bold ', '<w:b/>')}{run('too', '<w:b/>')}{run(' off', '<w:b w:val=' + chr(39) + '0' + chr(39) + '/>')}{run('x', '<w:b/><w:i/>')}<w:r><w:tab/><w:t>y</w:t><w:br/><w:t>z</w:t></w:r></w:p>"
        + entry("one", 1, 0) + entry("inner", 2, 1) + entry("two", 1, 0)
        + f"<w:tbl><w:tr>{cell('a|b')}{cell('c')}</w:tr><w:tr>{cell('d')}</w:tr></w:tbl>"
    )
    numbering = "<w:abstractNum w:abstractNumId='7'><w:lvl w:ilvl='0'><w:numFmt w:val='decimal'/></w:lvl></w:abstractNum><w:num w:numId='1'><w:abstractNumId w:val='7'/></w:num>"
    docx(tmp_path / "a.docx", body, numbering)
    lines = [r.line for r in files.docx_lines(spark, str(tmp_path / "a.docx")).orderBy("n").collect()]
    assert lines == ["## Title", "", "plain **bold too** off***x***\ty", "z", "", "1. one", "", "   - inner", "", "2. two", "", "| a\\|b | c |", "| --- | --- |", "| d |  |", ""]


def test_errors_reach_the_output(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/bad.epub").write_bytes(b"no archive")
    (tmp_path / "in/bad.docx").write_bytes(b"no archive")
    docx(tmp_path / "in/good.docx", "<w:p><w:r><w:t>fine</w:t></w:r></w:p>")
    (tmp_path / "in/page.html").write_text("<p>fine</p>")
    (tmp_path / "in/other.html").write_text("<p>breaks</p>")
    monkeypatch.setattr(command.SparkSession.builder, "getOrCreate", lambda: spark)
    for kind, name in (("epub", "*.epub"), ("docx", "*.docx"), ("html", "*.html")):
        command.main([kind, str(tmp_path / "in" / name), str(tmp_path / kind)])
    read = lambda t: spark.read.parquet(str(tmp_path / t)).collect()
    assert [(r.doc_id.rsplit("/")[-1], r.error.split(":")[0]) for r in read("epub/errors")] == [("bad.epub", "BadZipFile")] and read("epub/bundles") == []
    assert [(r.doc_id.rsplit("/")[-1], r.error.split(":")[0]) for r in read("docx/errors")] == [("bad.docx", "BadZipFile")] and [r.markdown.endswith("fine") for r in read("docx/bundles")] == [True]
    assert read("html/errors") == [] and len(read("html/bundles")) == 2


def test_format(spark, tmp_path):
    """The rows of the members, in several tasks a book; filters, damage, no files."""
    point = lambda t, src: f"<navPoint><navLabel><text>{t}</text></navLabel><content src='{src}'/></navPoint>"
    for b in range(3):
        members = {f"OEBPS/{k}.xhtml": f"<p>{b}-{k} {'x' * 500}</p>" for k in range(20)}
        manifest = "".join(f"<item id='p{k}' href='{k}.xhtml' media-type='application/xhtml+xml'/>" for k in range(21))  # one is not there
        book(tmp_path / f"{b}.epub", "<ncx><navMap>" + "".join(point(f"t{k}", f"{k}.xhtml") for k in range(20)) + "</navMap></ncx>", members, manifest, "".join(f"<itemref idref='p{k}'/>" for k in range(20)))
    (tmp_path / "bad.epub").write_bytes(b"no archive")
    epub_format.register(spark)
    rows = spark.read.format("epub").option("partition_bytes", 3000).load(str(tmp_path / "*.epub"))
    names = [c for c in rows.columns if c != "doc_id"]
    plain = lambda df: sorted((r.doc_id.rsplit("/")[-1], *(str(r[c]) for c in names)) for r in df.collect())
    assert plain(rows) == plain(epub.members(spark, str(tmp_path / "*.epub")))
    assert rows.rdd.getNumPartitions() > 12
    some = spark.read.format("epub").option("kinds", "spine").load(str(tmp_path / "*.epub"))
    assert some.count() == 60 and some.rdd.getNumPartitions() == 4  # a task for each file: members are not read
    assert rows.filter(F.col("kind").isin("error", "book")).count() == 4
    spine, items, nav, titles = epub.parts(rows)
    assert epub.spine_documents(spine, items, nav, titles).filter("title like 't%'").count() == 60
    assert spark.read.format("epub").load(str(tmp_path / "none*.epub")).count() == 0


def test_clip_same_as_regions(spark):
    """What is read of a page begins and ends where its regions do."""
    pages = [
        ([(0, 30.0, "接上页"), (1, 200.0, "x")], [(300.0, 370.0, 90.0, 91.0)], 595.0), ([(0, 30.0, "x"), (1, 300.0, "————————")], [], 500.0),
        ([(0, 20.0, "接上页"), (1, 60.0, "a 接上页")], [], 595.0), ([], [(10.0, 80.0, 440.0, 441.0), (10.0, 72.0, 400.0, 404.0)], 595.0), ([], [], 400.0),
    ]
    blocks = spark.createDataFrame([(k, 0, i, y, t) for k, (b, _, _) in enumerate(pages) for i, y, t in b], "doc_id int, page int, block_idx int, y0 double, text string")
    drawings = spark.createDataFrame([(k, 0, *d) for k, (_, ds, _) in enumerate(pages) for d in ds], "doc_id int, page int, x0 double, x1 double, y0 double, y1 double")
    heights = spark.createDataFrame([(k, 0, h) for k, (_, _, h) in enumerate(pages)], "doc_id int, page int, height double")
    for p in (PROFILE_A, PROFILE_B):
        split = {r.doc_id: r.split_y for r in layout.split_lines(heights, blocks, drawings, p).collect()}
        for k, (b, ds, h) in enumerate(pages):
            got = pdf.page_clip([{"y0": y, "text": t} for _, y, t in b], [{"x0": x0, "x1": x1, "y0": y0, "y1": y1} for x0, x1, y0, y1 in ds], h, p)
            assert got == (min(p.top, split[k]), min(p.bottom or h, h))
