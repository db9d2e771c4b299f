"""Text functions with one definition of white space: that of Python's ``str.strip``."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a character class that Java's and RE2's engines read alike.
BLANK = r"[\t-\r\x1c-\x20\x85\p{Z}]"
CJK = "[一-鿿]"
# Circled digits one to ten, the reference marks of notes; what file names cannot hold; the number of a
# numbered heading and what follows it; the marks of a note that goes over pages.
GLYPHS = "①②③④⑤⑥⑦⑧⑨⑩"
REFUSED = r'[\\/:*?"<>|]'
NUMBERED = r"^([0-9.]+|[一二三四五六七八九十百]+[、.]?)[ \t]+(.*)$"
PAGE_MARKS = ("接上页", "转下页")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    return F.regexp_replace(col(c), f"^{BLANK}+|{BLANK}+$", "")


def rstrip(c: str | Column) -> Column:
    return F.regexp_replace(col(c), f"{BLANK}+$", "")


def clean_filename(c: str | Column) -> Column:
    """Characters that file systems refuse become underscores."""
    return strip(F.regexp_replace(col(c), REFUSED, "_"))


def is_cjk(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(f"^{CJK}$"), F.lit(False))


def contains_any(c: str | Column, needles: list[str]) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.contains(col(c), F.lit(n)) for n in needles], F.lit(False))


def without_page_markers(c: str | Column) -> Column:
    """Without "continued from" and "continued on" marks, however they are spaced."""
    for mark in PAGE_MARKS:
        c = F.regexp_replace(col(c), r"\[" + f"{BLANK}*" + f"{BLANK}*".join(mark) + f"{BLANK}*" + r"\]", "")
    return c


def normalized_heading(c: str | Column) -> Column:
    """Heading text without inner blanks, but for one after its number."""
    t = strip(F.regexp_replace(col(c), "　", " "))
    number, rest = F.regexp_extract(t, NUMBERED, 1), F.regexp_extract(t, NUMBERED, 2)
    tight = lambda x: F.regexp_replace(x, "[ 　]", "")
    return F.when(number != "", F.concat(number, F.lit(" "), tight(rest))).otherwise(tight(t))


def file_stem(c: str | Column) -> Column:
    """Last path part without its last suffix; a leading dot is no suffix."""
    name = F.regexp_extract(col(c), r"([^/]*)/*$", 1)
    return F.regexp_replace(name, r"(?<=[^/])\.[^.]*$", "")


def without_fragment(c: str | Column) -> Column:
    return strip(F.substring_index(col(c), "#", 1))


def resolved_path(base: str | Column, src: str | Column) -> Column:
    """``src`` relative to the folder of ``base``; absolute addresses, data and empty ones as they are."""
    folder = F.regexp_replace(col(base), r"[^/]*$", "")
    parts = F.split(F.regexp_replace(F.concat(folder, col(src)), r"\\", "/"), "/")
    step = lambda acc, p: F.when((p == "") | (p == "."), acc).when(p == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)).otherwise(F.concat(acc, F.array(p)))
    joined = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    return F.when((col(src) == "") | col(src).rlike("^(data:|https?://)"), col(src)).otherwise(joined)


def image_extension(href: str | Column, content: str | Column) -> Column:
    """By the name, else by the magic bytes, else ``.png``."""
    h, magic = F.lower(col(href)), F.hex(F.substring(col(content), 1, 8))
    return (
        F.when(F.contains(h, F.lit("png")), ".png").when(F.contains(h, F.lit("jpg")) | F.contains(h, F.lit("jpeg")), ".jpg").when(F.contains(h, F.lit("gif")), ".gif").when(F.contains(h, F.lit("webp")), ".webp")
        .when(F.startswith(magic, F.lit("89504E470D0A1A0A")), ".png").when(F.startswith(magic, F.lit("FFD8")), ".jpg").when(F.startswith(magic, F.lit("474946383961")) | F.startswith(magic, F.lit("474946383761")), ".gif").otherwise(".png")
    )


def shortened(c: str | Column, n: int, mark: str = "…") -> Column:
    return F.when(F.length(col(c)) > n, F.concat(F.substring(col(c), 1, n), F.lit(mark))).otherwise(col(c))


def first_text(*columns: str | Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in columns])


def yaml_scalar(c: str | Column) -> Column:
    """A string as a YAML scalar: plain where that reads back as the same string, else quoted."""
    t = col(c)
    word = r"(?i)^(y|n|yes|no|true|false|on|off|null|~|)$"
    number = r"^[-+]?0[xX][0-9A-Fa-f_]+$|^[-+]?(0[ob])?[0-9][0-9_,:.]*([eE][-+]?[0-9]+)?$|^[-+]?\.[0-9]+$|^[-+]?\.(inf|Inf|INF)$|^\.(nan|NaN|NAN)$|^[0-9]{4}-[0-9]"
    sign = r"^[-?:,\[\]{}#&*!|>'\"%@`=<]|^\.\.\.|: |:$| #|^[\s]|[\s]$"
    double = r"[\x00-\x1f\x7f]"
    escaped = t
    for raw, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(code))
    return F.when(t.rlike(double), F.concat(F.lit('"'), escaped, F.lit('"'))).when(t.rlike(word) | t.rlike(number) | t.rlike(sign), F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(t)


def front_matter(book: Column, category: Column, order: Column, title: Column) -> Column:
    """YAML block with its keys in alphabetical order."""
    return F.concat(F.lit("---\nbook: "), yaml_scalar(book), F.lit("\ncategory: "), yaml_scalar(category), F.lit("\norder: "), order.cast("string"), F.lit("\ntitle: "), yaml_scalar(title), F.lit("\n---\n\n"))
