import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quire.llm import bpe, packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    letters = "abcdetheing 'sSΣßéÉ́一\x1c\x1d\x85 　.,!?0123½Ⅷ\x00\U0001F600İ\n\t"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return [*out, "", " ", "a<|endoftext|>b", "<|startoftext|>", "ab. " * 300_000, "x" * 5000, "The cat's don't 12 ..."]


def test_same_as_library(library, texts):
    encoder = bpe.BatchEncoder(bpe.BacktrackingBPE())
    table, numbers = encoder.bpe.tables()
    for text, (ids, _) in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text[:80])
        assert table.join(ids).decode() == library.decode(want, skip_special_tokens=False)
        assert numbers.join(ids).decode() == " ".join(map(str, want))
    assert encoder.encode([None])[0][0].tolist() == []
    for text in texts[:300]:
        assert encoder.bpe.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_table_starts_anew(library):
    encoder = bpe.BatchEncoder(bpe.BacktrackingBPE())
    encoder.BITS = 6
    encoder._fresh()
    rng = random.Random(2)
    words = [" ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(20)) for _ in range(30)]
    for _ in range(3):
        for w in words:
            assert encoder.encode([w])[0][0].tolist() == library.encode(w, add_special_tokens=False).ids


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(k).count("1") % 2] for k in range(n))


def test_runs_of_equal_hashes_differ(spark, library):
    """Words that polynomial hashes modulo a power of two cannot tell apart, in one batch, over tasks, after each other."""
    texts = [f"prefixab{thue_morse(n, letters)}suffixab" for n in (256, 1024, 2048, 4096) for letters in ("ab", "ba")]
    texts += ["a", "a\0", "a\0\0", "abcdefgh", "abcdefgh\0", "abcdefghijklmnop", "abcdefghijklmnop\0", "abcdefghijklmnopq", "abcdefghijklmnopr"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = bpe.BatchEncoder(bpe.BacktrackingBPE())
    assert [ids.tolist() for ids, _ in encoder.encode(texts)] == want
    assert [encoder.encode([t])[0][0].tolist() for t in texts] == want
    rows = bpe.encode_decode(spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string").repartition(5)).collect()
    assert all(r.ids == want[r.doc_id % len(texts)] for r in rows) and len(rows) == 3 * len(texts)


def test_bpe_query(spark, library, documents):
    docs = [(1, "Hello, world!"), (2, None), (None, "no id"), (3, ""), (3, "Hello, world!"), (3, "Hello, world!"), (4, "long words and " * 120_000)]
    got = bpe.query(spark, documents(docs))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.schema["n_tokens"].dataType.simpleString() == "bigint"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_packing_query(spark, library, documents):
    rng = random.Random(6)
    docs = [(k, " ".join("word%d." % rng.randint(0, 9999) for _ in range(rng.choice([0, 3, 40, 900])))) for k in range(60)]
    docs += [(100, None), (101, "one long text. " * 70_000)]
    got = packing.query(spark, documents(docs))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_pieces(got.collect(), docs, library)
    repeated = packing.pack(spark.createDataFrame([(7, "some words. and more"), (7, "some words. and more"), (None, "x")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in repeated if r.start == 0) == [(0, 2), (7, 6), (7, 6)]


def test_encode_decode(spark, library):
    rows = [(1, "Hello, world!", "x"), (2, None, "x"), (2, None, "x"), (3, "", "x")]
    got = bpe.encode_decode(spark.createDataFrame(rows, "doc_id long, text string, ids string")).collect()
    assert sorted((r.doc_id, r.ids, r.decoded) for r in got) == sorted((d, (i := library.encode(t or "", add_special_tokens=False).ids), library.decode(i, skip_special_tokens=False)) for d, t, _ in rows)
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def brute(places, costs, length, opening):
    f = [0.0] + [np.inf] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= length:
                pad = 0 if n == length or n & (n - 1) == 0 and n >= 64 else length - n
                f[j] = min(f[j], f[i] + pad + costs[j] + opening)
    return f[-1]


def test_cuts_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        places = np.concatenate([[0], np.cumsum(rng.integers(1, 90, rng.integers(2, 60)))])
        costs = np.where(rng.random(len(places)) < 0.3, 0.0, 4.0)
        costs[0] = 0
        ends = packing.best_cuts(places, costs, 128, 16)
        at, total = 0, 0.0
        for j in ends:
            n = int(places[j] - places[at])
            assert 0 < n <= 128
            total += (0 if n & (n - 1) == 0 and n >= 64 else 128 - n) + costs[j] + 16
            at = j
        assert at == len(places) - 1
        assert total == pytest.approx(brute(places, costs, 128, 16))


def check_pieces(rows, docs, library):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for key, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_pack(spark, library):
    rng = random.Random(4)
    docs = [(k, ". ".join("some words in a row %d" % rng.randint(0, 99) for _ in range(rng.choice([1, 5, 50, 700])))) for k in range(200)]
    docs += [(500, None), (501, ""), (502, "w " * 9000), (503, "x" * 7000)]
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, offset int").coalesce(1)
    rows = packing.pack(df).collect()
    padding = check_pieces(rows, docs, library)
    assert padding < 0.02 * sum(r.length for r in rows)
    assert packing.pack(df.limit(0)).collect() == []
    assert [len(r.ids) == r.length for r in packing.pack(df.filter("doc_id = 502"), with_ids=True).collect()]
