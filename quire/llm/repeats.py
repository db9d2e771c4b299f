"""Suffix-array deduplication by prefix-free parsing: removal of every repeated 100-byte string.

Parsing.  A rolling hash runs over all K-byte strings of a text.  The trigger of
a window (a string of LENGTH bytes) is its K-byte string of least hash, so every
window has one, and equal windows have equal triggers at the same place: what is
inside decides it.  Neighbouring windows mostly share a trigger; the bytes that
such a run of windows covers are a phrase.  Equal passages give equal phrases
wherever they stand, so highly repetitive text has few different ones.

Dictionary and parse.  Documents are dealt into blocks.  Each block reports its
triggers; only those that more than one phrase has, anywhere, go on.  The
dictionary is the set of different phrases under such triggers, and the parse
says which documents have which phrase where.  A window lies in one phrase, so
neither order needs more: the parse's suffixes, cut at one phrase, are sorted by
phrase and then by place in the corpus (doc_id, row, start), which is its suffix
array as far as a window reaches; the dictionary's suffixes, cut at LENGTH
bytes, are sorted within their trigger by their bytes, word after word, and
those that are alone leave the sort as soon as they are.  Every phrase but the
first of its kind is repeated as a whole, by the parse alone.  For the rest the
two arrays combine: equal neighbours of the dictionary's array are put in the
order of the parse, and all but the first of them are repeated.

Triggers with more than HOT phrases would make one task's group too large.  For
them there is an exact second way: their windows are sent singly under a 128-bit
digest, once for each block, so a window that a third of all documents has costs
a row for each block.

Elsewhere hashes only bring phrases together: the same phrase under the same
trigger means equal bytes, which are compared.  Windows of such frequent triggers
are told apart by their digests alone.

Null texts are empty; texts under LENGTH bytes have no windows and keep all.
Rows without an id come before all others.  Rows with one doc_id are ordered by
a hash of their text; an equal second row is a copy of the first (equal rows
share a block, as nothing tells them apart).  Very long texts are in one block
each.  Other columns are not looked at.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.llm.common import aside, give_back, mix, table

LENGTH, K = 100, 50
SPAN = LENGTH - K + 1  # K-byte strings of a window
CHUNK = 1 << 15
#: Most phrases of a trigger that one task compares.
HOT = 4096
#: Bytes of text in a block, bytes of text for a shuffle partition, triggers for a bucket.
BLOCK_BYTES, PARTITION_BYTES, BUCKET_TRIGGERS = 4 << 20, 24 << 20, 1 << 18
#: What a row counts for besides its text.
ROW_BYTES = 32
#: Rows of the dictionary that a task sorts at once.
SORT_ROWS = 6000
#: Where the eight-byte words of a suffix begin, in the order of its bytes.
WORDS = (*range(0, LENGTH - 8, 8), LENGTH - 8)
#: Rows without an id.
NO_ID = -(1 << 63)

_B = 0x9E3779B97F4A7C15
_SIZE = CHUNK + LENGTH + 1
with np.errstate(over="ignore"):
    _POWER = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_SIZE, _B, np.uint64))])
    _INVERSE = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_SIZE, pow(_B, -1, 1 << 64), np.uint64))])
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_B))


class Runs:
    """Runs of neighbouring windows with one trigger, over texts laid end to end."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, self.ends = data, ends
        found: list[list[np.ndarray]] = [[], [], [], [], []]
        if len(data) >= LENGTH:
            bad = np.zeros(len(data) + 1, np.int32)
            starts = np.concatenate([[0], ends[:-1]])
            np.add.at(bad, np.maximum(starts, ends - LENGTH + 1), 1)
            np.add.at(bad, ends, -1)
            valid = np.cumsum(bad[:-1]) == 0
            for c in range(0, len(data) - LENGTH + 1, CHUNK):
                for have, new in zip(found, self._chunk(c, valid), strict=True):
                    have.append(new)
        as_array = lambda k, t: np.concatenate(found[k]).astype(t) if found[k] else np.zeros(0, t)
        self.start, self.n, self.at = (as_array(k, np.int64) for k in range(3))  # first window, windows, trigger's place
        self.trigger, self.phrase = (as_array(k, np.uint64) for k in (3, 4))

    def _chunk(self, c: int, valid: np.ndarray) -> list[np.ndarray]:
        b = self.data[c : c + CHUNK + LENGTH - 1]
        windows = len(b) - LENGTH + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _INVERSE[: len(b)])])
        h = mix((sums[K:] - sums[:-K]) * _POWER[: len(b) - K + 1])
        least = (h & np.uint64(0xFFFFFFFFFFFF0000)) | np.arange(len(h), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[:windows], least[SPAN - 32 : SPAN - 32 + windows])
        at = (least & np.uint64(0xFFFF)).astype(np.int64)
        ok = valid[c : c + windows]
        change = np.concatenate([[True], at[1:] != at[:-1]])
        first = np.flatnonzero(ok & (change | np.concatenate([[True], ~ok[:-1]])))
        last = np.flatnonzero(ok & np.concatenate([change[1:] | ~ok[1:], [True]])) + 1
        n, at = last - first, at[first]
        phrase = mix(mix((sums[last + LENGTH - 1] - sums[first]) * _POWER[first]) + (n * 64 + (at - first)).astype(np.uint64))
        return [first + c, n, at + c, mix(h[at]), phrase]  # mixed again: least hashes crowd at zero


def same_bytes(data: bytes, left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the strings of these sizes at the places ``left`` and ``right`` are equal."""
    return np.fromiter((data[a : a + n] == data[b : b + n] for a, b, n in zip(left.tolist(), right.tolist(), sizes.tolist(), strict=True)), bool, len(left))


class Block:
    """A block's documents in order, their runs, and which runs are the block's first with their phrase."""

    def __init__(self, docs: pa.Table):
        keys = docs.column("doc_id").combine_chunks()
        keys = pa.concat_arrays(keys.chunks) if isinstance(keys, pa.ChunkedArray) else keys
        known = keys.is_valid().to_numpy(zero_copy_only=False)
        ids = keys.fill_null(NO_ID).to_numpy().astype(np.int64)
        texts = docs.column("text").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
        texts = texts.fill_null("")
        order = np.lexsort((known, ids))
        ids = ids[order]
        if (ids[1:] == ids[:-1]).any():
            values = texts.to_pylist()
            order = np.array(sorted(order.tolist(), key=lambda k: (int(keys[k].as_py()) if known[k] else NO_ID, known[k], values[k])))
        texts = texts.take(pa.array(order)).cast(pa.large_string())
        self.ids, self.known = ids, known[order]
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.starts, self.ends = offsets[:-1], offsets[1:]
        self.order = order
        r = self.runs = Runs(self.data, self.ends)
        by = np.lexsort((r.start, r.phrase, r.trigger))
        t, p = r.trigger[by], r.phrase[by]
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (p[1:] != p[:-1])]) if len(by) else np.zeros(0, bool)
        group, again = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0)), np.flatnonzero(~new)
        if len(again):
            one, other = by[group[again]], by[again]
            equal = (r.n[one] == r.n[other]) & (r.at[one] - r.start[one] == r.at[other] - r.start[other])
            equal &= same_bytes(self.data.tobytes(), r.start[one], r.start[other], r.n[other] + LENGTH - 1)
            new[again[~equal]] = True
        self.first, self.again = by[new], by[~new]  # first is in order of triggers

    def windows_of(self, runs: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Places and digests of all windows of these runs."""
        r = self.runs
        places = np.concatenate([np.arange(s, s + n) for s, n in zip(r.start[runs], r.n[runs], strict=True)]) if len(runs) else np.zeros(0, np.int64)
        data = self.data.tobytes() if len(runs) else b""
        return places, [xxhash.xxh3_128_digest(data[p : p + LENGTH]) for p in places.tolist()]

    def hot(self, triggers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For first runs with a hot trigger: first windows of the block with their digests (two 64-bit numbers), later windows."""
        runs = self.first[within(self.runs.trigger[self.first], triggers)]
        places, digests = self.windows_of(np.sort(runs))
        d = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        by = np.lexsort((places, d[:, 1], d[:, 0]))
        s = d[by]
        new = np.concatenate([[True], (s[1:] != s[:-1]).any(1)]) if len(by) else np.zeros(0, bool)
        return places[by[new]], s[new], places[by[~new]]


def within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    k = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[k] == values


def unpack(column: pa.ChunkedArray, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() or b"" for x in column), kind)


def report(bits: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        """A block's triggers by bucket, with the number of phrases that each has there."""
        block = Block(docs)
        t, n = np.unique(block.runs.trigger[block.first], return_counts=True)
        n = np.minimum(n, 65535).astype(np.uint16)
        bucket = (t >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(t), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(t)]]) if len(t) else np.zeros(1, np.int64)
        parts = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.table({
            "bucket": pa.array([int(bucket[a]) for a, _ in parts], pa.int64()), "block": pa.array([key[0].as_py()] * len(parts), pa.int64()),
            "triggers": pa.array([t[a:b].tobytes() for a, b in parts], pa.binary()), "counts": pa.array([n[a:b].tobytes() for a, b in parts], pa.binary()),
        })

    return run


def select(key: tuple, reports: pa.Table) -> pa.Table:
    """For each block: its triggers that have several phrases in all, and those that have too many."""
    every, counts = unpack(reports.column("triggers")), unpack(reports.column("counts"), np.uint16)
    t, back = np.unique(every, return_inverse=True)
    total = np.bincount(back, counts, len(t))
    several, many = t[total > 1], t[total > HOT]
    rows: list[tuple[int, bytes, bytes]] = []
    for block, mine in zip(reports.column("block").to_pylist(), reports.column("triggers").to_pylist(), strict=True):
        own = np.frombuffer(mine, np.uint64)
        if len(kept := own[within(own, several)]):
            rows.append((block, kept.tobytes(), own[within(own, many)].tobytes()))
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "triggers": pa.array([r[1] for r in rows], pa.binary()), "hot": pa.array([r[2] for r in rows], pa.binary())})


#: ``row`` is the block's number and the document's place in it; ``place`` the first window, the windows and the trigger's place among them.
DICTIONARY = "trigger long, phrase long, doc_id long, row long, place long, bytes binary"
PARSE_ORDER = ["trigger", "phrase", "doc_id", "row", "place"]


def dictionary(key: tuple, docs: pa.Table, selected: pa.Table) -> pa.Table:
    """The block's first phrases with a selected trigger; windows under digests for hot ones."""
    block = Block(docs)
    r = block.runs
    several, hot = np.sort(unpack(selected.column("triggers"))), np.sort(unpack(selected.column("hot")))
    runs = block.first[within(r.trigger[block.first], several) & ~within(r.trigger[block.first], hot)]
    places, digests, _ = block.hot(hot)
    where = np.concatenate([r.start[runs], places])
    doc = np.searchsorted(block.ends, where, side="right")
    data, ones = block.data.tobytes(), np.ones(len(places), np.int64)
    texts = [data[s : s + n + LENGTH - 1] for s, n in zip(r.start[runs].tolist(), r.n[runs].tolist(), strict=True)]
    n, at = np.concatenate([r.n[runs], ones]), np.concatenate([r.at[runs] - r.start[runs], ones - 1])
    start = where - block.starts[doc] if len(doc) else np.zeros(0, np.int64)
    return pa.table({
        "trigger": pa.array(np.concatenate([r.trigger[runs], digests[:, 0]]).view(np.int64)), "phrase": pa.array(np.concatenate([r.phrase[runs], digests[:, 1]]).view(np.int64)),
        "doc_id": pa.array(block.ids[doc] if len(doc) else np.zeros(0, np.int64)), "row": pa.array((key[0].as_py() << 32) + doc.astype(np.int64)),
        "place": pa.array(start << 12 | n << 6 | at), "bytes": pa.array(texts + [None] * len(places), pa.binary()),
    })


def suffix_array(data: np.ndarray, where: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the LENGTH-byte suffixes at ``where`` that are not alone, by their group and bytes, and a number that equal ones share."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
    live = np.arange(len(where))
    ranks = group
    for word in (None, *WORDS):
        if word is None:
            by = np.argsort(ranks, kind="stable")
            r = ranks[by]
            new = np.concatenate([[True], r[1:] != r[:-1]])
        else:
            value = np.ascontiguousarray(words[where[live] + word]).view(">u8").ravel()
            by = np.lexsort((value, ranks))
            r, v = ranks[by], value[by]
            new = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])])
        alone = new & np.concatenate([new[1:], [True]])
        number = np.cumsum(new) - 1
        live, ranks = live[by][~alone], number[~alone]
        if not len(live):
            break
    return live, ranks


def compare(rows: dict[str, np.ndarray], texts: list[bytes | None]) -> np.ndarray:
    """(row, from, to): ranges of window starts that are repeated, for whole trigger groups.

    Rows come in the order of trigger, phrase, document and place: the parse's.
    """
    t, p = rows["trigger"], rows["phrase"]
    new_t = np.concatenate([[True], t[1:] != t[:-1]])
    new_p = new_t | np.concatenate([[True], p[1:] != p[:-1]])
    place = rows["place"]
    doc, start, n, into = rows["doc_id"], place >> 12, place >> 6 & 63, place & 63
    head = np.maximum.accumulate(np.where(new_p, np.arange(len(t)), 0))
    for k in np.flatnonzero(~new_p).tolist():
        h = head[k]
        new_p[k] = texts[k] != texts[h] or into[k] != into[h]  # equal hashes, another phrase
    again = np.flatnonzero(~new_p)
    out = [np.stack([rows["row"][again], start[again], start[again] + n[again]], 1)]
    group = np.cumsum(new_t) - 1
    phrases = np.bincount(group, new_p)
    kept = np.flatnonzero(new_p & (phrases[group] > 1))
    if len(kept):
        sizes = np.array([len(texts[k]) for k in kept])
        base = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(texts[k] for k in kept), np.uint8)
        count = n[kept]
        of = np.repeat(np.arange(len(kept)), count)
        step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        some, equal = suffix_array(data, base[of] + step, group[kept][of] * LENGTH + into[kept][of] - step)
        row = kept[of[some]]
        at = start[row] + step[some]
        by = np.lexsort((at, rows["row"][row], doc[row], equal))  # equal suffixes in the parse's order
        e = equal[by]
        later = by[~np.concatenate([[True], e[1:] != e[:-1]])] if len(by) else by
        later = later[np.lexsort((at[later], row[later]))]
        r, s = row[later], at[later]
        if len(r):
            new = np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)])
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(r)) - 1
            out.append(np.stack([rows["row"][r[first]], s[first], s[last] + 1], 1))
    return np.concatenate(out)


REPEATED = "block long, row int, start long, stop long"


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``compare`` over a partition in order, whole triggers at a time."""
    pending: list[pa.Table] = []
    held = 0

    def done(rows: pa.Table) -> pa.RecordBatch:
        columns = {c: rows.column(c).to_numpy().astype(np.int64) for c in rows.column_names if c != "bytes"}
        made = compare(columns, rows.column("bytes").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(made[:, 0] >> 32), pa.array((made[:, 0] & 0xFFFFFFFF).astype(np.int32)), pa.array(made[:, 1]), pa.array(made[:, 2])], ["block", "row", "start", "stop"])

    for batch in batches:
        for at in range(0, batch.num_rows, SORT_ROWS):
            pending.append(pa.Table.from_batches([batch.slice(at, SORT_ROWS)]))
            held += pending[-1].num_rows
            if held < SORT_ROWS:
                continue
            rows = pa.concat_tables(pending)
            t, p = rows.column("trigger").to_numpy(), rows.column("phrase").to_numpy()
            cut = int(np.searchsorted(-(np.cumsum((t != t[-1])[::-1]) > 0)[::-1].astype(int), 0))  # where the last trigger begins
            if cut:
                yield done(rows.slice(0, cut))
                pending = [rows.slice(cut)]
            elif (p == p[0]).all() and rows.column("bytes").null_count == len(p):  # one hot window: its first row stands for the rest
                yield done(rows)
                pending = [rows.slice(0, 1)]
            else:
                pending = [rows]
            held = pending[0].num_rows
    if held:
        yield done(pa.concat_tables(pending))
    give_back()


def removal(columns: str):
    def run(key: tuple, docs: pa.Table, decided: pa.Table) -> pa.Table:
        """Per document: what is left of its bytes."""
        block = Block(docs)
        r = block.runs
        cover = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(cover, r.start[block.again], 1)
        np.add.at(cover, r.start[block.again] + r.n[block.again] + LENGTH - 1, -1)
        _, _, later = block.hot(np.sort(unpack(decided.column("hot"))))
        np.add.at(cover, later, 1)
        np.add.at(cover, later + LENGTH, -1)
        give_back()
        spans = decided.filter(pa.compute.is_valid(decided.column("start")))
        if spans.num_rows:
            k, start, stop = (spans.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "stop"))
            np.add.at(cover, block.starts[k] + start, 1)
            np.add.at(cover, block.starts[k] + stop + LENGTH - 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        rows = []
        for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
            g = gone[a:b]
            kept = block.data[a:b][~g].tobytes()
            spans_n = int(g[:1].sum() + (np.diff(g.astype(np.int8)) == 1).sum()) if b > a else 0
            rows.append((b - a, int(g.sum()), spans_n, kept))
        out = {"doc_id": pa.array(block.ids, mask=~block.known), "n_bytes": pa.array([x[0] for x in rows], pa.int64()), "n_removed": pa.array([x[1] for x in rows], pa.int64()), "n_spans": pa.array([x[2] for x in rows], pa.int64())}
        if columns == "digest":
            return pa.table(out | {"kept_sha256": pa.array([hashlib.sha256(x[3]).hexdigest() for x in rows], pa.string())})
        carried = docs.select([c for c in docs.column_names if c.startswith("_")]).take(pa.array(block.order))
        return carried.append_column("kept", pa.array([x[3].decode("utf-8", "ignore") for x in rows], pa.string()))

    return run


def deduplicated(docs: DataFrame, output: str = "digest") -> DataFrame:
    """Per row of ``docs`` (doc_id, text): sizes and a digest of the kept bytes, or (output "text") the kept text and all columns with a leading underscore."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    blocks = max(1, total // BLOCK_BYTES)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PARTITION_BYTES)
    bits = max(total // (SPAN // 2) // BUCKET_TRIGGERS, parts).bit_length()  # some buckets for every partition
    extra = [c for c in docs.columns if c.startswith("_")]
    # By the text too: rows that share an id, or have none, are dealt apart.
    dealt = docs.select("doc_id", "text", *extra).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(parts, "block")
    reports = dealt.groupBy("block").applyInArrow(report(bits), "bucket long, block long, triggers binary, counts binary")
    selected = reports.groupBy("bucket").applyInArrow(select, "block long, triggers binary, hot binary")
    phrases = dealt.groupBy("block").cogroup(selected.groupBy("block")).applyInArrow(dictionary, DICTIONARY)
    again = phrases.repartition(parts, "trigger").sortWithinPartitions(*PARSE_ORDER).mapInArrow(repeated, REPEATED)
    decided = selected.select("block", "hot", *[F.lit(None).cast(t).alias(c) for c, t in (("row", "int"), ("start", "long"), ("stop", "long"))])
    decided = decided.unionByName(again.withColumn("hot", F.lit(None).cast("binary")))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" if output == "digest" else StructType([*[docs.schema[c] for c in extra], StructField("kept", StringType())])
    return dealt.groupBy("block").cogroup(decided.groupBy("block")).applyInArrow(removal(output), schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes gone from text (broken characters at the cuts go too) and n_chars to match; null texts stay null."""
    inner, back = aside(docs)
    out = deduplicated(inner.withColumn("_id", F.col("doc_id")).withColumn("_null", F.col("text").isNull()), "text")
    return back(out.withColumn("doc_id", F.col("_id")).withColumn("text", F.when(~F.col("_null"), F.col("kept"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return deduplicated(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
