"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of all training rows are added up per language and block of buckets (a
fixed number of rows whatever the corpus), turned into log-probabilities, and
broadcast; the matrix has BUCKETS columns and a row for each learned language,
and its size is checked.  Scoring is sparse and by batch: the (text, bucket,
count) of many texts at once, whose columns are gathered and added up by text.

Texts that are null or have no letter are ``und`` with score 0.  Ties go to the
first language by name.  A text of letters with no learned language at all
(an empty training table) is ``und`` too.  Repeated rows and rows without an id
are scored like any other; an empty ``documents`` gives no rows; other columns
are not looked at.  Texts of any length are counted whole, CHUNK characters at
a time.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import doc_id_crc_mod, map_slices, table

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SIZES = (1, 2, 3)
SMOOTHING = 0.5
#: Most bytes of log-probabilities that are broadcast.
MODEL_BYTES = 64 << 20
#: Characters that are counted at once.
CHUNK = 1 << 18


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@functools.cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Batches of at most CHUNK characters: each piece's text, its string, and how many of its places begin an n-gram.

    A long text comes in several pieces, each with the characters that its last n-grams reach into.
    """
    rows, strings, own, held = [], [], [], 0
    for row, text in enumerate(texts):
        whole = f" {text.lower()} "
        for at in range(0, len(whole), CHUNK):
            mine = min(CHUNK, len(whole) - at)
            if held + mine > CHUNK and rows:
                yield rows, strings, own
                rows, strings, own, held = [], [], [], 0
            rows.append(row), strings.append(whole[at : at + mine + SIZES[-1] - 1]), own.append(mine)
            held += mine
    if rows:
        yield rows, strings, own


def grams(strings: list[str], own: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(string, bucket) of the hashed 1- to 3-grams that hold a letter, other characters being one blank."""
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(x) for x in strings])
    row = np.repeat(np.arange(len(strings), dtype=np.uint32), sizes)
    left = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    begins = left < np.repeat(np.array(own), sizes)
    plain = letters()[codes]
    c = np.where(plain, codes, 32).astype(np.uint32)
    h, keep = c * np.uint32(0x9E3779B1), plain
    found = []
    for n in SIZES:
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[n - 1 :] * np.uint32(0xC2B2AE3D)
            keep = keep[:-1] | plain[n - 1 :]
        end = len(codes) - n + 1
        k = np.flatnonzero(keep & begins[:end] & (row[:end] == row[n - 1 :]))
        found.append((row[k], (h[k] * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKET_BITS)))
    return np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found])


def gram_counts(text: str) -> np.ndarray:
    """Counts of one text's buckets."""
    counts = np.zeros(BUCKETS, np.int64)
    for _, strings, own in pieces([text]):
        counts += np.bincount(grams(strings, own)[1], minlength=BUCKETS)
    return counts


def sparse(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket, count), ordered, of batches; a long text is in several batches."""
    for rows, strings, own in pieces(texts):
        row, bucket = grams(strings, own)
        key = np.sort(row.astype(np.uint64) << np.uint64(BUCKET_BITS) | bucket)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        yield np.array(rows)[(key[first] >> np.uint64(BUCKET_BITS)).astype(np.int64)], (key[first] & np.uint64(BUCKETS - 1)).astype(np.int64), np.diff(np.append(first, len(key)))


def train(rows: DataFrame, text: str | Column = "text", lang: str | Column = "lang") -> tuple[list[str], np.ndarray]:
    """Languages by name, and log-probabilities of buckets with the log prior in a last column."""
    step = BUCKETS // 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                some = [(t, name) for t, name in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if has_letter(t)]
                names = sorted({name for _, name in some})
                number = {name: k for k, name in enumerate(names)}
                of = np.array([number[name] for _, name in some], np.int64)
                for name in names:
                    sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))[-1] += int((of == number[name]).sum())
                for rows_of, strings, own in pieces([t for t, _ in some]):
                    row, bucket = grams(strings, own)
                    for k in np.unique(of[rows_of]):
                        sums[names[k]][:-1] += np.bincount(bucket[(of[rows_of] == k)[row]], minlength=BUCKETS)
        for name, have in sums.items():
            for k in range(0, BUCKETS, step):
                rows_of = k + np.flatnonzero(have[k : k + step])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows_of), pa.string()), pa.array(rows_of.astype(np.int32)), pa.array(have[rows_of])], ["lang", "bucket", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([-1], pa.int32()), pa.array([int(have[-1])])], ["lang", "bucket", "n"])

    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    counted = rows.select(as_col(text).cast("string"), as_col(lang).cast("string").alias("lang")).filter("lang is not null").mapInArrow(run, "lang string, bucket int, n long")
    totals = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_lang = totals.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c"))  # at most BUCKETS + 1 each
    most = MODEL_BYTES // ((BUCKETS + 1) * 4)
    found = per_lang.limit(most + 1).toArrow()
    if found.num_rows > most:
        raise ValueError(f"over {most} languages: the model would take over {MODEL_BYTES} bytes")
    order = sorted(range(found.num_rows), key=lambda k: found.column(0)[k].as_py())
    matrix = np.zeros((len(order), BUCKETS + 1), np.float64)
    for row, k in enumerate(order):
        items = found.column(1)[k].values
        where = items.field(0).to_numpy(zero_copy_only=False)
        matrix[row, where] = items.field(1).to_numpy(zero_copy_only=False)  # bucket -1: the last column
    if len(order):
        smooth, priors = matrix[:, :-1] + SMOOTHING, matrix[:, -1:]
        matrix = np.hstack([np.log(smooth / smooth.sum(1, keepdims=True)), np.log(priors / priors.sum())])
    return [found.column(0)[k].as_py() for k in order], matrix.astype(np.float32)


def best(names: list[str], matrix: np.ndarray, texts: list[str | None]) -> list[tuple[str, float]]:
    """For each text the likeliest language and its posterior: one gather of a batch's columns, added up by text."""
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    known = [k for k, t in enumerate(texts) if names and has_letter(t)]
    if not known:
        return out
    columns = matrix[:, :-1].T
    score = np.tile(matrix[:, -1].astype(np.float64), (len(known), 1))
    for row, bucket, count in sparse([texts[k] for k in known]):
        if len(row):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            np.add.at(score, row[first], np.add.reduceat(columns[bucket] * count[:, None].astype(np.float64), first))
    top = score.argmax(1)
    odds = 1 / np.exp(score - score.max(1, keepdims=True)).sum(1)
    for k, t, p in zip(known, top.tolist(), odds.tolist(), strict=True):
        out[k] = names[t], p
    return out


def identify(docs: DataFrame, training: DataFrame, *keep: Column) -> DataFrame:
    """``docs`` (doc_id, text) with the predicted language and its posterior; ``training`` has text and lang."""
    names, matrix = train(training)
    model = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def make():
        known, logs = model.value
        return lambda ids, texts: [(k, *found) for k, found in zip(ids, best(known, logs, texts), strict=True)]

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, docs.filter(doc_id_crc_mod(4) != 2).select("text", "lang"))
    return out.select("doc_id", (doc_id_crc_mod(4) == 2).alias("held_out"), "lang_pred", "score")
