"""HTML to Markdown with the standard library's parser, and the parts that regular expressions do safely.

Nesting follows a parser that closes nothing by itself: an unclosed element
holds all that follows up to its parent's end.  Elements are read and written
with explicit stacks, so any depth of nesting does.  Quotes and the indents of
lists are marks in the text until it is whole; then each line gets them once, so
the work grows with the output.  The marks are noncharacters of Unicode, which
pages lose.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "article", "section", "header", "footer", "nav", "main", "aside", "ul", "ol", "table", "blockquote", "pre", "figure", "dl", "form", "body", "html", "h1", "h2", "h3", "h4", "h5", "h6", "li"}
#: A quote's begin and end; before and after the number of a line's indents.
OPEN, CLOSE, INDENT, INDENTED = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
_INDENTS = re.compile(f"{INDENT}([0-9]+){INDENTED}")
_NONE = str.maketrans("", "", OPEN + CLOSE + INDENT + INDENTED)
#: Element and its mark on both sides.
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "del": "~~", "s": "~~"}


def without_scripts(html: str | Column) -> Column:
    return F.regexp_replace(F.col(html) if isinstance(html, str) else html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.count: Counter[str] = Counter()  # of open elements

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v or "").translate(_NONE) for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: (v or "").translate(_NONE) for k, v in attrs}))

    def handle_endtag(self, tag):
        while self.count[tag]:  # what is open inside ends too
            closed = self.open.pop().tag
            self.count[closed] -= 1
            if closed == tag:
                break

    def handle_data(self, data):
        self.open[-1].children.append(data.translate(_NONE))


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack += [c for c in reversed(n.children) if isinstance(c, Node)]


def _bare(text: str) -> str:
    """Without blanks around it, and without the indents of its first line."""
    text = text.strip()
    return _INDENTS.sub("", text, count=1).lstrip() if text.startswith(INDENT) else text


def _whole(text: str) -> str:
    """``text`` with the quotes and indents that its marks stand for."""
    if INDENT in text:
        text = _INDENTS.sub(lambda m: "  " * int(m[1]), text)
    if OPEN not in text:
        return text
    out, depth = [], 0
    for line in text.split("\n"):
        opened, closed = line.count(OPEN), line.count(CLOSE)
        if depth or opened:
            line = ("> " * depth + line.replace(OPEN, "> ").replace(CLOSE, "")).rstrip()
        out.append(line)
        depth += opened - closed
    return "\n".join(out)


def _emphasised(mark: str, text: str, pad: str = "") -> str:
    core = text.strip()
    if not core:
        return text
    lead, tail = text[: len(text) - len(text.lstrip())], text[len(text.rstrip()) :]
    return f"{lead}{mark}{pad}{core}{pad}{mark}{tail}"


def _rows(table: Node) -> tuple[list, list[list[Node]]]:
    """What of a table is in no cell, and its own rows' cells; inner tables keep theirs."""
    holds: set[int] = set()  # elements between the table and its rows
    way, stack = {}, [table]
    while stack:
        n = stack.pop()
        for c in n.children:
            if isinstance(c, Node) and c.tag != "table":
                way[id(c)] = n
                if c.tag == "tr":
                    up = n
                    while up is not table and id(up) not in holds:
                        holds.add(id(up))
                        up = way[id(up)]
                stack.append(c)
    loose: list = []
    rows: list[list[Node]] = []
    stack = list(reversed(table.children))
    while stack:
        c = stack.pop()
        if isinstance(c, Node) and c.tag == "tr":
            cells = [x for x in c.children if isinstance(x, Node) and x.tag in ("td", "th")]
            stack += [x for x in reversed(c.children) if not (isinstance(x, Node) and x.tag in ("td", "th"))]
            rows.append(cells)
        elif isinstance(c, Node) and id(c) in holds:
            stack += reversed(c.children)
        else:
            loose.append(c)
    return loose, [r for r in rows if r]


def _table_lines(rows: list[list[str]]) -> str:
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])


class _Frame:
    """An element that is being written: what is left of its children, and the texts of the others."""

    def __init__(self, node: Node, lists: int):
        self.node, self.lists, self.texts, self.rows = node, lists, [], None
        self.todo = node.children
        if node.tag == "table":
            loose, self.rows = _rows(node)
            self.todo = [Node("", {}, loose), *(Node("", {}, cell.children) for row in self.rows for cell in row)]
        elif node.tag in ("ul", "ol"):
            self.todo = [c for c in node.children if isinstance(c, Node) or c.strip()]
        self.next = 0


def _without_blank_lines(text: str) -> str:
    """Blank lines stay in fences and quotes."""
    out, fence, depth = [], "", 0
    for line in text.split("\n"):
        if line or fence or depth:
            out.append(line)
        depth += line.count(OPEN) - line.count(CLOSE)
        ticks = re.match("`{3,}", line)
        if ticks and (not fence or line == fence):
            fence = "" if fence else ticks[0]
    return "\n".join(out)


def _list_lines(frame: _Frame) -> str:
    start = frame.node.attrs.get("start", "")
    out, n = [], int(start) - 1 if re.fullmatch("[0-9]{1,9}", start) else 0
    indent = f"{INDENT}{frame.lists}{INDENTED}" if frame.lists else ""
    for c, text in zip(frame.todo, frame.texts, strict=True):
        if isinstance(c, str):
            out.append(indent + text.strip())
        elif c.tag == "li":
            n += 1
            out.append(indent + (f"{n}. " if frame.node.tag == "ol" else "- ") + _bare(_without_blank_lines(text)))
        else:
            out.append(text.strip("\n"))
    return "\n".join(x for x in out if x.strip())


def _titled(address: str, node: Node) -> str:
    """An address with the title that the element has."""
    title = node.attrs.get("title", "").replace('"', '\\"')
    return f'{address} "{title}"' if title else address


def _ticked(text: str) -> str:
    """Code between more backticks than stand together in it."""
    longest = max(map(len, re.findall("`+", text)), default=0)
    return _emphasised("`" * (longest + 1), text, " " if longest else "")


def _closed(frame: _Frame) -> str:
    """An element's text from its children's."""
    node, tag = frame.node, frame.node.tag
    if tag == "table":
        cells = iter(frame.texts[1:])
        rows = [[" ".join(_whole(next(cells)).split()) for _ in row] for row in frame.rows]
        return f"\n\n{_bare(frame.texts[0])}\n\n" + (_table_lines(rows) + "\n\n" if rows else "")
    if tag in ("ul", "ol"):
        return "\n\n" + _list_lines(frame) + "\n\n"
    inner = "".join(frame.texts)
    if tag == "blockquote":
        return f"\n\n{OPEN}{_bare(inner)}{CLOSE}\n\n"
    if tag == "code":
        return _ticked(_whole(inner))
    if tag in MARKS:
        return _emphasised(MARKS[tag], _whole(inner))
    if tag == "a":
        inner, href = _whole(inner), node.attrs.get("href", "")
        return f"[{inner.strip()}]({_titled(href, node)})" if inner.strip() and href else inner
    if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
        text = re.sub(r"\s+", " ", _whole(inner)).strip()
        return f"\n\n{'#' * int(tag[1])} {text}\n\n" if text else ""
    if tag == "dt":
        text = re.sub(r"\s+", " ", _whole(inner)).strip()
        return f"\n\n{text}\n" if text else ""
    if tag == "dd":
        lines = _whole(inner).strip().split("\n")
        return "\n" + "\n".join([f":   {lines[0]}", *(f"    {x}".rstrip() for x in lines[1:])]) + "\n" if lines[0] else ""
    if tag in BLOCKS:
        return f"\n\n{_bare(inner)}\n\n"
    return inner


def _leaf(node: Node) -> str | None:
    """The text of an element that needs no look at its children's; None for others."""
    tag = node.tag
    if tag in ("script", "style"):
        return ""
    if tag == "br":
        return "  \n"
    if tag == "hr":
        return "\n\n---\n\n"
    if tag == "img":
        return f"![{node.attrs.get('alt', '')}]({_titled(node.attrs.get('src', ''), node)})"
    if tag == "pre":
        text = "".join(walk_texts(node))
        fence = "`" * max(3, 1 + max(map(len, re.findall("`{3,}", text)), default=0))
        return f"\n\n{fence}\n{text.strip(chr(10))}\n{fence}\n\n"
    return None


def walk_texts(node: Node) -> Iterator[str]:
    """All text inside, in order."""
    stack = list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            yield c
        else:
            stack += reversed(c.children)


def _render(root: Node) -> str:
    """The children of ``root`` as text."""
    top = _Frame(Node("", {}, root.children), 0)
    stack = [top]
    while True:
        frame = stack[-1]
        if frame.next == len(frame.todo):
            if frame is top:
                return "".join(top.texts)
            stack.pop()
            stack[-1].texts.append(_closed(frame))
            continue
        c = frame.todo[frame.next]
        frame.next += 1
        if isinstance(c, str):
            frame.texts.append(re.sub(r"\s+", " ", c))
        elif (text := _leaf(c)) is not None:
            frame.texts.append(text)
        else:
            stack.append(_Frame(c, frame.lists + (frame.node.tag in ("ul", "ol"))))


def to_markdown(html: str | None, images: dict[str, str] | None = None) -> str:
    """The body (or the whole document without one) as Markdown, blocks apart by one blank line.

    ``images`` gives the stored files of image addresses; other images stay as they are.
    """
    if not html:
        return ""
    root = parse(html)
    for n in walk(root) if images else ():
        if n.tag == "img" and n.attrs.get("src") in images:
            n.attrs = {"src": images[n.attrs["src"]], "alt": "img"}
    body = next((n for n in walk(root) if n.tag == "body"), root)
    text = "\n".join(x.rstrip(" ") if not x.endswith("  ") else x.rstrip(" ") + "  " for x in _whole(_render(body)).split("\n"))
    # Blanks with three line ends or more become one blank line, and what indents the line after them stays.
    return re.sub(r"(?<!\s)[^\S\n]*\n\s*", lambda m: m[0] if m[0].count("\n") < 3 else "\n\n" + m[0][m[0].rindex("\n") + 1 :], text).strip()


def image_sources(html: str | None) -> list[str]:
    return [n.attrs["src"] for n in walk(parse(html or "")) if n.tag == "img" and n.attrs.get("src")]


def markdown_pages(pages: DataFrame, html: str = "html", output: str = "markdown", error: str | None = None) -> DataFrame:
    """``output``: the page as Markdown, null for one that cannot be read; ``error`` names a column that says why."""

    # Rows, not Arrow: a worker then holds a hundred pages at a time, where a batch has ten thousand.
    @F.udf("markdown string, error string", useArrow=False)
    def convert(page: str | None) -> tuple[str | None, str | None]:
        try:
            return to_markdown(page), None
        except Exception as e:  # a page that the parser refuses is a row, not the end of the job
            return None, f"{type(e).__name__}: {e}"

    made = pages.withColumn("_made", convert(F.col(html))).withColumn(output, F.col("_made.markdown"))
    return (made.withColumn(error, F.col("_made.error")) if error else made).drop("_made")


def image_list(html: str = "html") -> Column:
    """Addresses of a page's images in order."""
    return F.udf(image_sources, "array<string>", useArrow=False)(F.col(html))


def markdown_with_images(html: str, images: str) -> Column:
    """Markdown of ``html`` with the files that ``images`` (array of structs src, file) names."""

    @F.udf("string", useArrow=False)
    def convert(page: str | None, found: list | None) -> str:
        return to_markdown(page, {i["src"]: i["file"] for i in found} if found is not None else None)

    return convert(F.col(html), F.col(images))


def headings(pages: DataFrame) -> DataFrame:
    """(page_id, n, level, title) of closed headings."""
    text = F.regexp_extract_all(without_scripts("html"), F.lit(r"(?is)<h([1-6])\b[^>]*>(.*?)</h\1\s*>"), F.lit(0))
    each = pages.select("page_id", F.posexplode(text).alias("n", "h"))
    title = F.trim(F.regexp_replace(F.regexp_replace("h", "(?s)<[^>]*>", ""), r"\s+", " "))
    return each.select("page_id", "n", F.substring("h", 3, 1).cast("int").alias("level"), title.alias("title"))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, n, href) of anchors with a double-quoted address."""
    found = F.regexp_extract_all(without_scripts("html"), F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select("page_id", F.posexplode(found).alias("n", "href"))
