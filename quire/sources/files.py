"""Other inputs: web pages, plain text, word-processor files."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n, line) of plain text files, whole files in order."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value"))
    return files.select("doc_id", F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("page_id"), F.col("path").alias("url"), F.col("content").cast("string").alias("html"))


def _is_on(properties: ET.Element | None, name: str) -> bool:
    """Whether a run's property is there and not switched off."""
    found = properties.find(f"{W}{name}") if properties is not None else None
    return found is not None and found.get(f"{W}val", "true") not in ("0", "false", "off", "none")


def _run_text(paragraph: ET.Element) -> str:
    """Text of a paragraph with emphasis, tabs and line breaks; neighbouring runs of one style are one."""
    runs: list[tuple[str, str]] = []
    for r in paragraph.iter(f"{W}r"):
        properties = r.find(f"{W}rPr")
        mark = "**" * _is_on(properties, "b") + "*" * _is_on(properties, "i")
        parts = {f"{W}tab": "\t", f"{W}br": "\n", f"{W}cr": "\n", f"{W}noBreakHyphen": "-"}
        text = "".join((c.text or "") if c.tag == f"{W}t" else parts.get(c.tag, "") for c in r)
        if runs and runs[-1][0] == mark:
            runs[-1] = mark, runs[-1][1] + text
        elif text:
            runs.append((mark, text))
    # Emphasis stays on a line and off the blanks around it.
    styled = lambda mark, text: re.sub(r"[^\s](?:[^\n]*[^\s])?", lambda m: f"{mark}{m[0]}{mark[::-1]}", text) if mark else text
    return "".join(styled(*r) for r in runs)


def _numbered(z: zipfile.ZipFile) -> dict[tuple[str, str], bool]:
    """Whether a list (number, level) counts its entries."""
    if "word/numbering.xml" not in z.namelist():
        return {}
    root = ET.fromstring(z.read("word/numbering.xml"))
    kinds = {(a.get(f"{W}abstractNumId"), v.get(f"{W}ilvl")): v.find(f"{W}numFmt") for a in root.iter(f"{W}abstractNum") for v in a.iter(f"{W}lvl")}
    of = {n.get(f"{W}numId"): n.find(f"{W}abstractNumId").get(f"{W}val") for n in root.iter(f"{W}num")}
    return {(n, level): kind is not None and kind.get(f"{W}val") not in ("bullet", "none") for n, a in of.items() for (b, level), kind in kinds.items() if a == b}


def _paragraph(p: ET.Element, counted: dict[tuple[str, str], bool], places: dict[tuple[str, int], int]) -> tuple[int, str]:
    style, listed = p.find(f"{W}pPr/{W}pStyle"), p.find(f"{W}pPr/{W}numPr")
    level = re.fullmatch(r"(?i)heading ?([1-6])", style.get(f"{W}val", "")) if style is not None else None
    text = _run_text(p)
    if listed is None or level:
        return int(level[1]) if level else 0, text
    value = lambda name: (e.get(f"{W}val", "0") if (e := listed.find(f"{W}{name}")) is not None else "0")
    number, depth = value("numId"), int(value("ilvl"))
    for k in [k for k in places if k[0] == number and k[1] > depth]:
        del places[k]
    places[number, depth] = places.get((number, depth), 0) + 1
    mark = f"{places[number, depth]}. " if counted.get((number, str(depth))) else "- "
    return 0, "   " * depth + mark + text.replace("\n", " ")


def docx_paragraphs(data: bytes) -> list[tuple[int, str]]:
    """(heading level or 0, text) of what a word-processor file has: paragraphs with emphasis, list entries, tables."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root, counted = ET.fromstring(z.read("word/document.xml")), _numbered(z)
    out: list[tuple[int, str]] = []
    places: dict[tuple[str, int], int] = {}
    body = root.find(f"{W}body")
    for e in body if body is not None else root:
        if e.tag == f"{W}p":
            out.append(_paragraph(e, counted, places))
        elif e.tag == f"{W}tbl":
            cell = lambda c: "<br>".join(t for p in c.iter(f"{W}p") if (t := _run_text(p).strip())).replace("\n", "<br>").replace("|", "\\|")
            rows = [[cell(c) for c in r.findall(f"{W}tc")] for r in e.findall(f"{W}tr")]
            width = max(map(len, rows), default=0)
            shown = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
            if shown and width:
                out.append((0, "\n".join([shown[0], "|" + " --- |" * width, *shown[1:]])))
        else:
            out += [_paragraph(p, counted, places) for p in e.iter(f"{W}p")]
    return out


def docx_rows(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n, line, error): lines with headings marked; a file that cannot be read is one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = docx_paragraphs(bytes(content))
                except Exception as e:  # a damaged file is a row, not the end of the job
                    yield pd.DataFrame({"doc_id": [name], "n": [None], "line": [None], "error": [f"{type(e).__name__}: {e}"]})
                    continue
                lines = [x for level, text in rows for x in (*(("#" * level + " " if level else "") + text).split("\n"), "")]
                yield pd.DataFrame({"doc_id": name, "n": range(len(lines)), "line": lines, "error": None})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "doc_id string, n int, line string, error string")


def docx_lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n, line) of the files that can be read."""
    return docx_rows(spark, path).filter("error is null").drop("error")
