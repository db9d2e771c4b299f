"""Order-preserving packing by dynamic programming over cut places.

Documents keep their input order.  Their ids, each followed by ``end_id``, form
one stream; windows of at most ``length`` ids are cut from it at document ends
or sentence ends.  With c the places where a cut may be and w what a cut there
costs (nothing at a document's end, more inside one), the least cost up to a
place is

    f(j) = w(j) + min over i with c(j) - c(i) <= length of f(i) + opening + padding(c(j) - c(i))

where padding is ``length`` less the window, or nothing if the window's size is
a power of two.  All but the powers of two need the minimum of f(i) + c(i) over
a sliding window, which a monotone queue gives in constant time for each place.

Each input partition is packed alone, in blocks of BLOCK_IDS ids or one document:
the last window of a block is carried into the next, so memory is bounded by a
block and one document, and the least cost is that of a block's cuts, not of the
whole corpus's.  A
sentence longer than a window is cut where a window fills.  What is left at a
partition's end is cut into powers of two, so nothing there is padded.  Null
texts are empty and give one piece of one id; repeated rows, and rows without an
id, are packed once for each; of equally cheap cuts the earliest window's longest
one is taken; an empty table gives no rows.  Very long texts are packed whole.
Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from quire.llm.bpe import VOCABULARY, shared
from quire.llm.common import table

LENGTH, END_ID = 2048, 1
#: Costs in ids: a cut at a sentence's end, a cut elsewhere, and each window.
SENTENCE_CUT, FORCED_CUT, OPENING = 4, 48, 16
BLOCK_IDS, SLICE_BYTES = 1 << 18, 2 << 20

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_cuts(places: np.ndarray, costs: np.ndarray, length: int = LENGTH, opening: float = OPENING) -> list[int]:
    """Indexes of ``places`` (ascending, the first 0, no gap over ``length``) where the cheapest windows end."""
    c, w = places.tolist(), costs.tolist()
    n = len(c)
    f, came = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    index = {0: 0}
    powers = [1 << k for k in range(6, length.bit_length()) if 1 << k < length]
    for j in range(1, n):
        at = c[j]
        while c[queue[0][1]] < at - length:
            queue.popleft()
        g, i = queue[0]
        best = g + length - at
        for p in powers:
            k = index.get(at - p)
            if k is not None and f[k] < best:
                best, i = f[k], k
        f[j], came[j] = best + w[j] + opening, i
        g = f[j] + at
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, j))
        index[at] = j
    out, j = [], n - 1
    while j > 0:
        out.append(j)
        j = came[j]
    return out[::-1]


def with_forced(places: np.ndarray, costs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds a place wherever the next one would be over ``length`` away."""
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > length)
    if not len(wide):
        return places, costs
    extra = np.concatenate([np.arange(places[k] + length, places[k + 1], length) for k in wide])
    everything = np.concatenate([places, extra])
    order = np.argsort(everything, kind="stable")
    return everything[order], np.concatenate([costs, np.full(len(extra), float(FORCED_CUT))])[order]


class Packer:
    """Takes documents one by one; yields (document index, start, length, ids, sequence, offset) pieces."""

    def __init__(self, length: int = LENGTH, block_ids: int = BLOCK_IDS):
        self.length, self.block_ids = length, block_ids
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int]] = []  # key, where its first id is (negative: cut before), ids in all
        self.places: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.size, self.sequence = 0, 0

    def add(self, key: object, ids: np.ndarray, sentence_ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append((key, self.size, len(ids)))
        inner = sentence_ends[(sentence_ends > 0) & (sentence_ends < len(ids) - 1)]
        self.ids.append(ids)
        self.places.append(np.append(inner, len(ids)) + self.size)
        self.costs.append(np.append(np.full(len(inner), float(SENTENCE_CUT)), 0.0))
        self.size += len(ids)
        if self.size >= self.block_ids:
            yield from self._cut(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.size:
            yield from self._cut(last=True)

    def _cut(self, last: bool) -> Iterator[tuple]:
        ids = np.concatenate(self.ids)
        places, costs = np.unique(np.concatenate([[0], *self.places]), return_index=True)
        costs = np.concatenate([[0.0], *self.costs])[costs]
        places, costs = with_forced(places.astype(np.int64), costs, self.length)
        ends = [int(places[j]) for j in best_cuts(places, costs, self.length)]
        if last:
            at = ends[-2] if len(ends) > 1 else 0
            tail, ends = ends[-1] - at, ends[:-1]
            if tail == self.length:
                ends.append(at + tail)
            else:
                while tail:
                    p = 1 << (tail.bit_length() - 1)
                    at, tail = at + p, tail - p
                    ends.append(at)
        elif len(ends) > 1:
            ends.pop()
        keep = ends[-1]
        d, at = 0, 0
        for end in ends:
            offset = 0
            while at < end:
                key, first, n = self.docs[d]
                stop = min(end, first + n)
                yield key, at - first, ids[at:stop], n, self.sequence, offset
                offset += stop - at
                at = stop
                if at == first + n:
                    d += 1
            self.sequence += 1
        self.docs = [(key, first - keep, n) for key, first, n in self.docs[d:]]
        self.ids = [ids[keep:].copy()]
        later = places > keep
        self.places, self.costs = [places[later] - keep], [costs[later]]
        self.size -= keep


def pack(docs: DataFrame, path: str = VOCABULARY, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` ids; ``with_ids`` adds the ids themselves.

    ``sequence_id`` is the partition's number times 2**40 plus the sequence's number in it.
    """
    out_type = StructType.fromDDL(SCHEMA + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, end = shared(path), Packer(length), np.array([end_id], np.uint32)
        base = TaskContext.get().partitionId() << 40
        arrow = to_arrow_schema(out_type)
        rows: list[tuple] = []

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
            rows.clear()
            return made

        def take(pieces: Iterator[tuple]):
            for key, start, ids, n, sequence, offset in pieces:
                row = (key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, base + sequence, offset)
                rows.append((*row, ids.tolist()) if with_ids else row)

        for batch in batches:
            step = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                for key, (ids, ends) in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    take(packer.add(key, np.concatenate([ids, end]), ends))
                    if len(rows) > 4096:
                        yield flush()
        take(packer.finish())
        if rows:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, out_type)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
