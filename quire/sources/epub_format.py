"""E-books as a Spark format: ``spark.read.format("epub").load(path)`` has the rows of ``epub.members``.

``path`` is a pattern on folders that all executors mount.  A task reads some
members of one book: books are cut by the sizes that their directories name, so
a large book is several tasks, and none holds more than it reads.  A book that
cannot be read is one row with its error, a member that cannot is a row of its
item with the error.

Options: ``partition_bytes``, the bytes of members, unpacked, that one task
reads; ``kinds``, the kinds of rows to read (all, if not given): without ``item``
no member is opened.  Filters are not pushed down: Spark keeps one reader for all
uses of a loaded table, so what one of them filters would be lost for the others.
"""

from __future__ import annotations

import glob
import os
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.sources import epub

NAMES = [c.split()[0] for c in epub.SCHEMA.split(", ")]
KINDS = ("book", "item", "spine", "nav", "error")


@dataclass
class Part(InputPartition):
    """Items ``first`` to ``last`` (exclusive) of a book; the first part has the rows of the package too."""

    path: str
    first: int
    last: int
    package: bool
    error: str | None = None

    def __post_init__(self):
        super().__init__(None)


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.pattern, self.most = options["path"], int(options.get("partition_bytes", 64 << 20))
        self.kinds = {k.strip() for k in options["kinds"].split(",")} if options.get("kinds") else set(KINDS)
        if self.kinds - set(KINDS):
            raise ValueError(f"kinds of rows are {', '.join(KINDS)}")

    def partitions(self) -> list[Part]:
        out: list[Part] = []
        for path in sorted(glob.glob(self.pattern)):
            try:
                with zipfile.ZipFile(path) as z:
                    rows = epub.package(z)
                    sizes = [z.getinfo(r["href"]).file_size if r["href"] in z.NameToInfo else 0 for r in rows if r["kind"] == "item"]
            except Exception as e:  # a damaged file is a row, not the end of the job
                out.append(Part(path, 0, 0, True, f"{type(e).__name__}: {e}"))
                continue
            first = held = 0
            for k, size in enumerate(sizes if "item" in self.kinds else []):
                if held and held + size > self.most:
                    out.append(Part(path, first, k, first == 0))
                    first, held = k, 0
                held += size
            out.append(Part(path, first, len(sizes), first == 0))
        return out or [Part("", 0, 0, False)]

    def read(self, part: Part) -> Iterator[tuple]:
        row = lambda r: tuple(({"doc_id": part.path} | r).get(n) for n in NAMES)
        if part.error:
            if "error" in self.kinds:
                yield row({"kind": "error", "error": part.error})
            return
        if not part.path:
            return
        with zipfile.ZipFile(part.path) as z:
            rows = list(epub.package(z))
            if part.package:
                yield from (row(r) for r in rows if r["kind"] != "item" and r["kind"] in self.kinds)
            if "item" not in self.kinds:
                return
            for r in [r for r in rows if r["kind"] == "item"][part.first : part.last]:
                try:
                    yield row(r | {"content": z.read(r["href"]) if r["href"] in z.NameToInfo else None})
                except Exception as e:
                    yield row(r | {"error": f"{type(e).__name__}: {e}"})


class Epub(DataSource):
    @classmethod
    def name(cls) -> str:
        return "epub"

    def schema(self) -> str:
        return epub.SCHEMA

    def reader(self, schema) -> Reader:
        if not os.path.isabs(self.options.get("path", "").removeprefix("file:")):
            raise ValueError("the path of e-books must be absolute, on a folder that all executors mount")
        return Reader({**self.options, "path": self.options["path"].removeprefix("file://").removeprefix("file:")})


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.dataSource.register(Epub)
