"""PDF files as tables: outline, pages, text blocks, drawings, laid-out spans, images.

Needs PyMuPDF, which is imported where files are read.  ``tables`` opens each
file of a ``binaryFile`` scan once; a file that cannot be read, or a page of it,
gives a row with ``error`` and stops nothing else.
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import PAGE_MARKS
from quire.operators.layout import DIVIDER
from quire.profiles import Profile

LIBRARY, CONVERTER = "fitz", "pymupdf4llm"
SCHEMA = (
    "doc_id string, kind string, page int, pos int, level int, n_pages int, block_idx int, line_idx int, span_idx int, text string, size double, font string, flags int,"
    " x0 double, y0 double, x1 double, y1 double, width double, height double, content binary, error string"
)
NAMES = [c.split()[0] for c in SCHEMA.split(",")]
#: Left, top, right and bottom that the delegated conversion leaves out.  Fixed values.
MARGINS = (0, 82, 0, 0)


def needed(name: str):
    try:
        return importlib.import_module(name)
    except ImportError as e:
        raise RuntimeError(f"reading PDF files needs {name}, which is not installed") from e


def page_clip(blocks: list[dict], drawings: list[dict], height: float, profile: Profile) -> tuple[float, float]:
    """Top and bottom of what an article takes from a page: from the profile's top, or from the notes where they begin above it."""
    rules = [d["y0"] for d in drawings if d["y1"] - d["y0"] < 5 and 60 <= d["x1"] - d["x0"] <= 75]
    dividers = [b["y0"] for b in blocks if b["y0"] > profile.top and re.search(DIVIDER, b["text"])]
    marks = [b["y0"] for b in [b for b in blocks if b["y0"] > profile.detect][:5] if PAGE_MARKS[0] in b["text"]]
    if profile.rule_divides and rules:
        split = max(rules) - 2
    elif not profile.rule_divides and dividers:
        split = dividers[0] - 2
    else:
        split = marks[0] - 1 if marks else height
    return min(profile.top, split), min(profile.bottom or height, height)


def page_rows(page, number: int, rect, clip: tuple[float, float] | Profile | None) -> Iterator[dict]:
    """Rows of one page; ``clip`` (top, bottom, or the profile that they follow from) is what text and images are read from, blocks and drawings are read whole."""
    width, height = float(page.rect.width), float(page.rect.height)
    yield {"kind": "page", "width": width, "height": height}
    blocks = [{"kind": "block", "block_idx": k, "x0": b[0], "y0": b[1], "x1": b[2], "y1": b[3], "text": b[4]} for k, b in enumerate(page.get_text("blocks"))]
    drawings = [{"kind": "drawing", "pos": k, "x0": r.x0, "y0": r.y0, "x1": r.x1, "y1": r.y1} for k, d in enumerate(page.get_drawings()) if (r := d.get("rect"))]
    yield from blocks
    yield from drawings
    if isinstance(clip, Profile):
        clip = page_clip(blocks, drawings, height, clip)
    inside = {"clip": rect(0, clip[0], width, min(clip[1], height))} if clip else {}
    line = 0
    for k, block in enumerate(page.get_text("dict", **inside)["blocks"]):
        if "image" in block:
            yield {"kind": "image", "block_idx": k, "content": bytes(block["image"])}
        for row in block.get("lines", []):
            for n, s in enumerate(row["spans"]):
                yield {"kind": "span", "block_idx": k, "line_idx": line, "span_idx": n, "text": s["text"], "size": s["size"], "font": s["font"], "flags": s["flags"], "x0": row["bbox"][0], "y0": block["bbox"][1]}
            line += 1


def file_rows(library, data: bytes, clip: tuple[float, float] | Profile | None) -> Iterator[dict]:
    with library.open(stream=data, filetype="pdf") as doc:
        yield {"kind": "book", "n_pages": doc.page_count}
        for k, (level, title, page, *_) in enumerate(doc.get_toc()):
            yield {"kind": "toc", "pos": k, "level": level, "text": title, "page": page}
        for number in range(doc.page_count):
            try:
                for row in page_rows(doc[number], number, library.Rect, clip):
                    yield {"page": number} | row
            except Exception as e:  # the other pages still are rows
                yield {"kind": "error", "page": number, "error": f"{type(e).__name__}: {e}"}


def tables(spark: SparkSession, path: str, clip: tuple[float, float] | Profile | None = None) -> DataFrame:
    """All rows of the files at ``path``; ``kind`` says which table a row belongs to."""
    name_of_library = LIBRARY
    needed(name_of_library)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        library = needed(name_of_library)
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows: list[dict] = []
                try:
                    for row in file_rows(library, bytes(content), clip):
                        rows.append({"doc_id": name} | row)
                        if len(rows) == 10_000:
                            yield framed(rows)
                            rows = []
                except Exception as e:  # a damaged file is a row, not the end of the job
                    rows.append({"doc_id": name, "kind": "error", "error": f"{type(e).__name__}: {e}"})
                yield framed(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, SCHEMA)


def framed(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in NAMES})


def part(rows: DataFrame, kind: str, *columns: str) -> DataFrame:
    return rows.filter(F.col("kind") == kind).select("doc_id", *columns)


def outline(rows: DataFrame) -> DataFrame:
    """(doc_id, pos, level, title, page, n_pages)."""
    return part(rows, "toc", "pos", "level", F.col("text").alias("title"), "page").join(part(rows, "book", "n_pages"), "doc_id")


def spans(rows: DataFrame) -> DataFrame:
    return part(rows, "span", "page", "line_idx", "span_idx", "text", "size", "font", "flags", "x0", "y0")


def delegated(spark: SparkSession, path: str, articles: DataFrame, margins: tuple[float, float, float, float] = MARGINS) -> DataFrame:
    """(doc_id, pos, markdown, error) of ``articles`` (doc_id, pos, start, end; 0-based pages), converted by the library's own converter."""
    names = LIBRARY, CONVERTER
    needed(CONVERTER)
    wanted = articles.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "start", "end")).alias("of"))
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("doc_id"), "content").join(wanted, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        library, converter = map(needed, names)
        for batch in batches:
            for name, content, of in zip(batch["doc_id"], batch["content"], batch["of"], strict=True):
                out = []
                for a in of:
                    made, error = None, None
                    try:
                        with library.open(stream=bytes(content), filetype="pdf") as doc:
                            made = converter.to_markdown(doc, pages=list(range(a["start"], a["end"] + 1)), margins=margins, show_progress=False)
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                    out.append((name, a["pos"], made, error))
                yield pd.DataFrame(out, columns=["doc_id", "pos", "markdown", "error"], dtype=object)

    return files.mapInPandas(run, "doc_id string, pos int, markdown string, error string")
