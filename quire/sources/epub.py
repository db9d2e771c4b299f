"""E-books: spine, navigation and members from the ZIP container, and their joins.

``members`` opens each file of a ``binaryFile`` scan once and emits a row per
member; a file that cannot be read gives one row with ``error`` and stops
nothing else.
"""

from __future__ import annotations

import posixpath
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Container, Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.toc import nav_entries
from quire.functions.text import file_stem, first_text, image_extension, resolved_path, strip, without_fragment

SCHEMA = "doc_id string, kind string, seq int, level int, item_id string, href string, media_type string, title string, content binary, error string"
#: What a task holds of a book's rows: their number, and the bytes of their contents (or one member's, if that is more).
ROWS, BYTES = 1000, 4 << 20


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _member(folder: str, address: str, names: Container[str]) -> str:
    """Path and fragment of the member that an address names: as it is written, or with its percent signs decoded."""
    path, sign, fragment = address.partition("#")
    if not path:
        return ""
    raw = posixpath.normpath(posixpath.join(folder, path))
    decoded = posixpath.normpath(posixpath.join(folder, unquote(path)))
    return (raw if raw in names else decoded) + sign + fragment


def _point(n: ET.Element) -> tuple[str, str, list[ET.Element]]:
    """Title, address and children of an entry of an NCX or navigation document."""
    if _local(n.tag) == "navPoint":
        text, src = n.find("{*}navLabel/{*}text"), n.find("{*}content")
        return (text.text or "") if text is not None else "", src.get("src", "") if src is not None else "", [c for c in n if _local(c.tag) == "navPoint"]
    label = next((c for c in n if _local(c.tag) in ("a", "span")), None)
    children = [li for o in n if _local(o.tag) == "ol" for li in o if _local(li.tag) == "li"]
    return "".join(label.itertext()) if label is not None else "", label.get("href", "") if label is not None else "", children


def _nav(root: ET.Element, folder: str, names: Container[str]) -> Iterator[tuple[int, str, str, bool]]:
    """(level, title, href, is section) of an NCX or navigation document of any depth, in preorder."""
    if _local(root.tag) == "ncx":
        top = root.find(".//{*}navMap")
    else:
        top = next((n for n in root.iter() if _local(n.tag) == "nav" and any("toc" in v for v in n.attrib.values())), None)
    if top is None:
        return
    tops = [c for c in top if _local(c.tag) == "navPoint"] or [li for o in top if _local(o.tag) == "ol" for li in o if _local(li.tag) == "li"]
    open_ = [(c, 1) for c in reversed(tops)]
    while open_:
        n, level = open_.pop()
        title, address, children = _point(n)
        yield level, title.strip(), _member(folder, address, names), bool(children)
        open_ += [(c, level + 1) for c in reversed(children)]


def package(z: zipfile.ZipFile) -> Iterator[dict]:
    """Rows of an e-book's package and navigation, and of its items without their contents."""
    box = ET.fromstring(z.read("META-INF/container.xml"))
    opf = next(e.get("full-path") for e in box.iter() if _local(e.tag) == "rootfile")
    folder = posixpath.dirname(opf)
    root = ET.fromstring(z.read(opf))
    title = next((e.text for e in root.iter() if _local(e.tag) == "title" and (e.text or "").strip()), None)
    yield {"kind": "book", "title": (title or "unknown").strip()}
    navs: dict[str | None, str | None] = {}  # by item: its address if it is the navigation
    names = z.NameToInfo
    for e in root.iter():
        if _local(e.tag) == "item":
            href, media = _member(folder, e.get("href", ""), names), e.get("media-type", "")
            navs[e.get("id")] = href if "nav" in e.get("properties", "").split() or media == "application/x-dtbncx+xml" else None
            yield {"kind": "item", "item_id": e.get("id"), "href": href, "media_type": e.get("media-type")}
    for k, e in enumerate((e for e in root.iter() if _local(e.tag) == "itemref"), 1):
        yield {"kind": "spine", "seq": k, "item_id": e.get("idref")}
    nav = next((h for h in navs.values() if h is not None), None)
    del root, navs  # before the navigation is read
    if nav in names:
        for k, (level, t, href, section) in enumerate(_nav(ET.fromstring(z.read(nav)), posixpath.dirname(nav), names)):
            yield {"kind": "nav", "seq": k, "level": level, "title": t, "href": href, "media_type": "section" if section else ""}


def _check(z: zipfile.ZipFile) -> None:
    """Reads all that ``read_book`` reads, and keeps the addresses only."""
    for href in [r["href"] for r in package(z) if r["kind"] == "item" and r["href"] in z.NameToInfo]:
        with z.open(href) as member:
            while member.read(1 << 20):
                pass


def read_book(file: BinaryIO) -> Iterator[dict]:
    """Rows of an e-book, one member at a time; a damaged book fails before its first row."""
    with zipfile.ZipFile(file) as z:
        _check(z)
        for r in package(z):
            yield r | {"content": z.read(r["href"])} if r["kind"] == "item" and r["href"] in z.NameToInfo else r


def members(spark: SparkSession, path: str) -> DataFrame:
    return members_of(spark.read.format("binaryFile").load(path))


def members_of(files: DataFrame) -> DataFrame:
    """Rows of the members of ``files`` (path, content)."""
    types = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(name, types[kind]) for name, kind in map(str.split, SCHEMA.split(", "))])

    def rows_of(path: str, content: pa.BinaryScalar) -> Iterator[dict]:
        try:
            for r in read_book(pa.BufferReader(content.as_buffer())):  # no copy is made
                yield {"doc_id": path} | r
        except Exception as e:  # a damaged file is a row, not the end of the job
            yield {"doc_id": path, "kind": "error", "error": f"{type(e).__name__}: {e}"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                some, held = [], 0
                for r in rows_of(path.as_py(), content):
                    some.append(r)
                    held += len(r.get("content") or b"")
                    if len(some) == ROWS or held >= BYTES:
                        yield pa.RecordBatch.from_pylist(some, schema)
                        some, held = [], 0
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def parts(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Spine, items, flat navigation and books of ``members``."""
    of = lambda kind: rows.filter(F.col("kind") == kind)
    nav = of("nav").select("doc_id", F.col("seq").alias("pos"), "level", "title", "href", (F.col("media_type") == "section").alias("is_section"))
    return of("spine"), of("item"), nav_entries(nav), of("book")


def errors(rows: DataFrame) -> DataFrame:
    """(doc_id, error) of the files of ``members`` that could not be read."""
    return rows.filter("kind = 'error'").select("doc_id", "error")


def is_document(href: str = "href"):
    return F.lower(F.col(href)).rlike(r"\.(html|xhtml|htm)$")


def spine_documents(spine: DataFrame, items: DataFrame, nav: DataFrame, books: DataFrame) -> DataFrame:
    """Spine entries that are documents, with title and category: own, from navigation, or by name."""
    docs = spine.select("doc_id", F.col("seq").alias("order"), "item_id").join(items.select("doc_id", "item_id", "href", F.col("title").alias("own_title"), "content"), ["doc_id", "item_id"]).filter(is_document())
    found = docs.join(nav.select("doc_id", "href", F.col("title").alias("nav_title"), "category"), ["doc_id", "href"], "left").join(books.select("doc_id", F.col("title").alias("book")), "doc_id", "left")
    title = first_text(strip("own_title"), strip("nav_title"), file_stem("href"), F.concat(F.lit("章节_"), F.col("order")))
    return found.select("doc_id", "order", "href", "book", title.alias("title"), first_text("category", "book").alias("category"), "content")


def matched_images(images: DataFrame, items: DataFrame) -> DataFrame:
    """Images (doc_id, base, n, src) with the item that the first fitting form of their address names; n by order of found ones."""
    local = images.filter("src <> ''").filter(~F.col("src").rlike("^(data:|https?://)")).withColumn("path", resolved_path("base", "src"))
    forms = F.array("path", F.regexp_replace("path", r"^\./", ""), F.regexp_replace("path", "^/+", ""), F.concat(F.lit("OEBPS/"), "path"), F.regexp_replace("path", r"\\", "/"), F.try_url_decode(F.regexp_replace("path", r"\+", "%2B")))
    each = local.select("*", F.posexplode(forms).alias("rank", "href"))
    hit = each.join(items.select("doc_id", "href", "content"), ["doc_id", "href"]).filter("content is not null and length(content) > 0")
    best = hit.groupBy("doc_id", "base", "n", "src").agg(F.min_by(F.struct("href", "content"), "rank").alias("x"))
    return best.select("doc_id", "base", "n", "src", "x.href", image_extension("x.href", "x.content").alias("extension"), "x.content")


__all__ = ["errors", "is_document", "matched_images", "members", "members_of", "parts", "read_book", "spine_documents", "without_fragment"]
