"""Articles from pages as they come, in any order and batching: paragraphs and notes leave as soon as they are closed.

A row of the stream is a page: article, ``seq`` (its place in the article, from
0), ``is_last``, and ``content``, the JSON of its body lines (text, raw or its first
two characters, x0 and is_image, in order), its note lines (raw, x0, in order) and its number of
references; ``pages`` makes such rows of the tables of ``operators.paragraphs``.

The state of an article is what a reader between two pages knows: the open
paragraph and block, the open note, the number of references so far, and pages
that came before their turn.  Closed blocks and notes are rows of the output, so
a state does not grow with its article.  An article ends with its last page, or,
where a timeout is given, when no page came for so long: what waits then is read
over the gaps.  Pages that come again, or after the end, change nothing.
The rules are those of the windows in ``operators.paragraphs``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quire.functions.text import GLYPHS, PAGE_MARKS
from quire.operators import paragraphs
from quire.operators.layout import DIVIDER
from quire.profiles import PROFILES, Profile

PAGE_SCHEMA = "doc_id string, seq int, is_last boolean, content string"
OUT_SCHEMA = "doc_id string, part string, n long, text string"
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_DIVIDER, _NOTE, _HEADING = re.compile(DIVIDER), re.compile(r"\s*\[\^[0-9]+\]"), re.compile(r"#+\s")
_MARKS = re.compile("|".join(r"\[\s*" + r"\s*".join(m) + r"\s*\]" for m in PAGE_MARKS))


def pages(body: DataFrame, notes: DataFrame, references: DataFrame) -> DataFrame:
    """Page rows of body lines and note lines (doc_id, page, ord, ...) and the references of pages (doc_id, page, k).

    The three are dealt once, by article; of a body line's ``raw`` a reader needs the blanks that it begins with.
    """
    key = ["doc_id", "page"]
    image = F.when(F.col("is_image"), True) if "is_image" in body.columns else F.lit(None).cast("boolean")
    own = body.select(*key, F.struct("ord", "text", F.substring("raw", 1, 2).alias("raw"), "x0", image.alias("is_image")).alias("body"))
    foot = notes.select(*key, F.struct("ord", "raw", "x0").alias("notes"))
    count = references.select(*key, F.lit(1).alias("references"))
    return page_rows(own.unionByName(foot, allowMissingColumns=True).unionByName(count, allowMissingColumns=True).repartition("doc_id"))


def page_rows(every: DataFrame) -> DataFrame:
    """Page rows of one table of lines: doc_id, page, ``body`` or ``notes`` (a line, null for others) and ``references``, a number; dealt by article if it is not."""
    key = ["doc_id", "page"]
    lines = lambda name: F.transform(F.array_sort(F.collect_list(name)), lambda line: line.dropFields("ord")).alias(name)
    w = paragraphs.Window.partitionBy("doc_id").orderBy("page")
    found = every.withColumn("seq", F.dense_rank().over(w) - 1).groupBy(*key, "seq").agg(lines("body"), lines("notes"), F.coalesce(F.sum("references"), F.lit(0)).alias("references"))
    rows = found.select(*key, "seq", F.to_json(F.struct("body", "notes", "references")).alias("content"))
    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), "seq", F.lead("page").over(w).isNull().alias("is_last"), "content")


def is_cjk(c: str) -> bool:
    return len(c) == 1 and "一" <= c <= "鿿"


def seam(a: str | None, b: str) -> int:
    """How many emphasis marks each side of the seam of two lines loses."""
    if a is None:
        return 0
    inner = lambda n: len(a) > n and is_cjk(a[-n - 1 : -n]) and is_cjk(b[n : n + 1])
    if a.endswith("**") and b.startswith("**"):
        return 2 if inner(2) else 0
    thin = a.endswith("*") and b.startswith("*") and not a.endswith("**") and not b.startswith("**")
    return 1 if thin and inner(1) else 0


class Reader:
    """Reads an article's pages in order; ``state`` is all that it keeps, as plain values."""

    START = {
        "next": 0, "references": 0, "blocks": 0, "notes": 0, "any": False, "heading_page": None, "image": False, "quote": False,
        "lead": None, "held": None, "paragraph": None, "block": None, "note": None,
    }

    def __init__(self, profile: Profile, state: dict | None = None):
        self.profile = profile
        self.state = dict(self.START) | (state or {})
        self.out: list[tuple[str, int, str]] = []

    def page(self, content: str) -> None:
        s, page = self.state, json.loads(content)
        number = s["next"]
        for line in page.get("body") or []:
            self._line(line, number)
        marks, first = 0, s["references"]
        for line in page.get("notes") or []:
            marks += self._note(line, marks, first, page["references"])
        s["references"] += page["references"]
        s["next"] += 1

    def end(self) -> None:
        self._close_paragraph()
        self._close_block()
        if self.state["note"] is not None:
            self._emit("note", "notes", self.state["note"])
            self.state["note"] = None

    def _emit(self, part: str, counter: str, text: str) -> None:
        self.state[counter] += 1
        self.out.append((part, self.state[counter], text))

    def _line(self, line: dict, page: int) -> None:
        s, p = self.state, self.profile
        text, raw = line.get("text") or "", line.get("raw") or ""
        if text == "" or _DIVIDER.search(text):
            return
        image = bool(line.get("is_image"))
        heading, quote = text.startswith("#") and not image, text.startswith("> ")
        if image:
            base = True
        elif _NOTE.match(text):
            base = False
        elif heading:
            base = not (p.heading_continues and s["heading_page"] == page)
        else:
            base = (line.get("x0") or 0) > p.indent or raw.startswith(("　", "  "))
        base = base or s["image"]
        first = not s["any"]
        new = first or base or (quote and not s["quote"])
        if first or base or quote:
            s["quote"] = quote
        s.update(any=True, image=image, heading_page=page if heading else None)
        if new:
            self._close_paragraph()
            s.update(lead=text, paragraph="", held=text)
            return
        bare = text
        if quote and s["lead"].startswith("> "):
            bare = text[2:]
        elif p.heading_continues and _HEADING.match(text) and _HEADING.match(s["lead"]):
            bare = text.lstrip("#").lstrip()
        lost = seam(s["held"], bare)
        close = lost > 0 or (is_cjk(s["held"][-1:]) and is_cjk(bare[:1]))
        self._add(lost)
        s["paragraph"] += "" if close else " "
        s.update(held=bare, cut=lost)

    def _add(self, tail: int) -> None:
        """The held line goes to the paragraph, without the marks that its seams lose."""
        s = self.state
        held, head = s["held"], s.get("cut") or 0
        s["paragraph"] += held[head : max(head, len(held) - tail)]
        s.update(held=None, cut=0)

    def _close_paragraph(self) -> None:
        s = self.state
        if s["held"] is None:
            return
        self._add(0)
        text = s["paragraph"]
        s["paragraph"] = None
        if s["block"] is not None and s["block"].startswith("> ") and text.startswith("> "):
            s["block"] += "\n>\n" + text
        else:
            self._close_block()
            s["block"] = text

    def _close_block(self) -> None:
        if self.state["block"] is not None:
            self._emit("body", "blocks", self.state["block"])
            self.state["block"] = None

    def _note(self, line: dict, marks: int, first: int, references: int) -> int:
        """1 if the line has a mark; a mark without a reference on its page has no number."""
        s, p, raw = self.state, self.profile, line.get("raw") or ""
        text = _MARKS.sub("", raw).strip()
        if text == "" or _DIVIDER.search(text):
            return 0
        mark = text[0] in GLYPHS
        new = mark or (p.indent_opens_note and ((line.get("x0") or 0) > p.indent or raw.startswith("　")))
        if mark:
            text = f"[^{first + marks + 1 if marks < references else 'x'}]: {text[1:]}"
        if new or s["note"] is None:
            if s["note"] is not None:
                self._emit("note", "notes", s["note"])
            s["note"] = text
        else:
            s["note"] += text
        return int(mark)


class Articles(StatefulProcessor):
    def __init__(self, profile: str, timeout_ms: int | None):
        self.profile, self.timeout = profile, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "state string")
        self.early = handle.getMapState("early", "seq int", "is_last boolean, content string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._state()
        if state.get("ended"):
            for _ in rows:
                pass
            return
        reader, ended, early = Reader(PROFILES[self.profile], state), False, self.early.exists()
        for frame in rows:
            frame = frame.sort_values("seq", kind="stable")
            for seq, last, content in zip(frame["seq"].tolist(), frame["is_last"].tolist(), frame["content"], strict=True):
                if ended or seq < reader.state["next"]:
                    continue
                if seq > reader.state["next"]:  # before its turn
                    self.early.updateValue((seq,), (bool(last), content))
                    early = True
                    continue
                reader.page(content)
                ended = bool(last)
                while early and not ended and self.early.containsKey((reader.state["next"],)):
                    ended = self._next(reader)
            if reader.out and not ended:  # what is closed does not wait for the article's end
                yield self._closed(key, reader)
        yield from self._leave(key, reader, ended)
        if self.timeout:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not ended:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._state()
        if not state.get("ended"):
            reader = Reader(PROFILES[self.profile], state)
            for seq in sorted(k[0] for k in self.early.keys()):
                reader.state["next"] = seq
                if self._next(reader):
                    break
            yield from self._leave(key, reader, True)

    def close(self) -> None:
        pass

    def _state(self) -> dict:
        return json.loads(self.open.get()[0]) if self.open.exists() else {}

    def _next(self, reader: Reader) -> bool:
        """Reads the waiting page whose turn it is; whether it is the last."""
        turn = (reader.state["next"],)
        last, content = self.early.getValue(turn)
        self.early.removeKey(turn)
        reader.page(content)
        return last

    def _closed(self, key, reader: Reader) -> pd.DataFrame:
        out, reader.out = reader.out, []
        return pd.DataFrame([(key[0], *r) for r in out], columns=["doc_id", "part", "n", "text"])

    def _leave(self, key, reader: Reader, ended: bool) -> Iterator[pd.DataFrame]:
        if ended:
            reader.end()
            self.early.clear()
        self.open.update((json.dumps({"ended": True} if ended else reader.state),))
        if reader.out:
            yield self._closed(key, reader)


def blocks(page_rows: DataFrame, profile: str = "a", timeout_ms: int | None = None) -> DataFrame:
    """Closed blocks and notes (doc_id, part, n, text) of a stream of page rows."""
    mode = "ProcessingTime" if timeout_ms else "None"
    return page_rows.groupBy("doc_id").transformWithStateInPandas(Articles(profile, timeout_ms), OUT_SCHEMA, "Append", mode)


def run_to(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Writes what there is and ends; a later call goes on from the checkpoint.  Each row is written once."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        return stream.writeStream.format("parquet").option("compression", "zstd").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER[0])
        else:
            spark.conf.set(PROVIDER[0], before)


def assembled(rows: DataFrame) -> DataFrame:
    """(doc_id, markdown) of the blocks and notes that came so far."""
    of = lambda part, number, text: rows.filter(F.col("part") == part).select("doc_id", F.col("n").alias(number), F.col("text").alias(text))
    return paragraphs.articles(of("body", "block", "paragraph"), of("note", "note", "text"))


def streamed(spark: SparkSession, page_table: str, folder: str, profile: str = "a", files: int = 1000) -> DataFrame:
    """The articles of a table of page rows, read as a stream of at most ``files`` files a batch."""
    stream = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files).parquet(page_table)
    run_to(blocks(stream, profile), f"{folder}/blocks", f"{folder}/checkpoint").awaitTermination()
    return assembled(spark.read.schema(OUT_SCHEMA).parquet(f"{folder}/blocks"))
