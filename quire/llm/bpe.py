"""Exact BPE by backtracking, and decoding by offset tables.

An Aho-Corasick automaton finds every vocabulary entry inside a word in one
pass.  The encoder takes the longest entry at each place that is compatible
with the entry before it (the two would stay apart if their joint text were
merged pair by pair in rank order); where none is, it drops the last entry and
goes on with a shorter one.  Each place is left at most once, so a word takes
linear time, and the result is that of the merge procedure.

Nulls are empty texts and give no ids.  A text that holds a special token's
string gives that token's id there, as the library does by default.  Repeated
rows and rows without an id are encoded like any other; an empty table gives no
rows; other columns, whatever their names, are not looked at.  Texts of any
length are encoded whole, in blocks of BatchEncoder.BLOCK bytes cut at blanks.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import ahocorasick
import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import held_by_worker, map_slices, mix, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Words whose ids a worker keeps, and the longest that are kept.
KEPT_WORDS, KEPT_LENGTH = 250_000, 48
WORD_END = "</w>"
#: What is white space to the library.
SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class OffsetTable:
    """Strings in one byte array with their offsets; ``join`` gathers many of them at once."""

    def __init__(self, strings: list[bytes], separator: bytes = b" "):
        joined = [s + separator for s in strings]
        self.lengths = np.array([len(s) for s in joined], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(joined), np.uint8)
        self.gap = len(separator)

    def join(self, ids: np.ndarray, block: int = 1 << 16) -> bytes:
        parts = []
        for at in range(0, len(ids), block):
            some = ids[at : at + block]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            index = np.repeat(self.offsets[some] - (ends - lengths), lengths) + np.arange(ends[-1])
            parts.append(self.blob[index].tobytes())
        out = b"".join(parts)
        return out[: len(out) - self.gap] if out else out


class BacktrackingBPE:
    def __init__(self, path: str = VOCABULARY):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max(max(vocab.values()), *self.special.values()) + 1
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made_at = [-1] * self.size
        self.result: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(pairs):
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.rank.setdefault(pair, r)
            self.result.setdefault(pair, whole)
            if whole not in self.halves:
                self.halves[whole], self.made_at[whole] = pair, r
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(self.size)]
        self.automaton = ahocorasick.Automaton()
        self.atoms: dict[str, int] = {}
        self.length = [0] * self.size
        for s, i in vocab.items():
            if s in self.special or s == WORD_END:
                continue
            core = s[: -len(WORD_END)] if s.endswith(WORD_END) and len(s) > len(WORD_END) else s
            key = core + ("\0" if core is not s else "")
            self.length[i] = len(key)
            if i not in self.halves:
                self.atoms[key] = i
            if i not in self.halves or self._stands(i):
                self.automaton.add_word(key, i)
        self.automaton.make_automaton()
        letters = byte_letters()
        self.letters = str.maketrans({chr(b): c for b, c in letters.items()})
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.compatible: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, bytes] = {}

    def _stands(self, whole: int) -> bool:
        """An entry is its own encoding if its halves are, and stay apart until its own merge."""
        left, right = self.halves[whole]
        return self._apart(left, right, self.made_at[whole])

    def _apart(self, left: int, right: int, before: int) -> bool:
        """No merge of a rank under ``before`` crosses the seam of ``left`` and ``right`` while each is being merged."""
        limit = before
        while True:
            r = self.rank.get((left, right))
            if r is not None and r < limit:
                return False
            a, b = self.made_at[left], self.made_at[right]
            if a < 0 and b < 0:
                return True
            # Undo the later of the two merges: crossing merges before it saw the halves.  At one
            # rank merges go from left to right: the left one before a crossing one before the right one.
            if a > b:
                left, limit = self.halves[left][1], min(limit, a)
            else:
                right, limit = self.halves[right][0], min(limit, b + 1)

    def _pair_ok(self, left: int, right: int) -> bool:
        ok = self.compatible.get((left, right))
        if ok is None:
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            ok = self.compatible[left, right] = self._apart(left, right, 1 << 60)
        return ok

    def word(self, word: str) -> list[int]:
        """Ids of one word of byte letters."""
        text = word + "\0"
        n, length, compatible = len(text), self.length, self.compatible
        at: list[list[int]] = [[] for _ in range(n)]
        for end, i in self.automaton.iter(text):
            at[end - length[i] + 1].append(i)  # the longest last
        out: list[int] = []
        dead = bytearray(n + 1)
        place, last = 0, -1
        while place < n:
            found = at[place]
            while found:
                i = found[-1]
                end = place + length[i]
                if not dead[end]:
                    if last < 0:
                        break
                    ok = compatible.get((last, i))
                    if ok or ok is None and self._pair_ok(last, i):
                        break
                found.pop()
            if found:
                out.append(i)
                place, last = end, i
            else:
                dead[place] = 1
                if not out:
                    raise ValueError(f"no encoding of {word!r}")
                place -= length[out.pop()]
                at[place].pop()
                last = out[-1] if out else -1
        return out

    def chunk_ids(self, chunk: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a run of normalised text without white space."""
        if chunk.isalpha():
            return self._word_ids(chunk)
        return b"".join([self._word_ids(p) for p in self.split.findall(chunk)])

    def _word_ids(self, piece: str) -> bytes:
        made = self.kept.get(piece)
        if made is None:
            made = self._encode_word(piece)
            if len(piece) <= KEPT_LENGTH:
                if len(self.kept) >= KEPT_WORDS:
                    self.kept.clear()
                self.kept[piece] = made
        return made

    def _encode_word(self, piece: str) -> bytes:
        letters = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letters)
        longest = [i for _, i in self.automaton.iter_long(letters + "\0")]
        if sum(map(self.length.__getitem__, longest)) != len(letters) + 1:
            return pack(self.word(letters))
        compatible = self.compatible
        for pair in zip(longest, longest[1:]):
            ok = compatible.get(pair)
            if not ok and (ok is not None or not self._pair_ok(*pair)):
                return pack(self.word(letters))  # the longest entries do not fit: backtrack
        return pack(longest)

    @staticmethod
    def normalised(text: str) -> str:
        if not text.isascii():
            text = SPACES.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ")
        return text.lower()

    def chunks(self, text: str) -> list[str]:
        return [c for c in SPACES.split(self.normalised(text)) if c]

    def pieces(self, text: str) -> list[tuple[str, bytes]]:
        """(normalised run, its ids) in order; special tokens come with an empty run."""
        out: list[tuple[str, bytes]] = []
        parts = self.marks.split(text) if self.marks and "<|" in text else [text]
        for part in parts:
            if part in self.special:
                out.append(("", np.array([self.special[part]], np.uint32).tobytes()))
            elif part:
                runs = self.chunks(part)
                out += [(c, self.chunk_ids(c)) for c in runs]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text."""
        return np.frombuffer(b"".join(b for _, b in self.pieces(text or "")), np.uint32)

    def tables(self) -> tuple[OffsetTable, OffsetTable]:
        """For texts of entries, as the library decodes without a decoder, and for decimal ids."""
        return OffsetTable([s.encode() for s in self.names]), OffsetTable([str(i).encode() for i in range(self.size)])


class BatchEncoder:
    """Encodes many texts at once: runs are found and looked up in arrays; only new runs go through the encoder.

    The key of a run of at most SHORT bytes is the run: its bytes as two 64-bit
    numbers, and its length.  Longer runs, which are few, are looked up by their bytes.
    """

    BITS, BLOCK, SHORT = 21, 1 << 19, 16
    #: Ids in the pool at which the tables begin anew.
    POOL = 1 << 24
    SENTENCE_ENDS = np.isin(np.arange(256), list(b".!?"))

    def __init__(self, bpe: BacktrackingBPE):
        self.bpe = bpe
        self.space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        #: By length, which bits of eight bytes belong to a run.
        self.bits = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        self._fresh()

    def _fresh(self):
        n = 1 << self.BITS
        self.one, self.two, self.size = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint8)
        self.where, self.count = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        self.long: dict[bytes, tuple[int, int]] = {}
        self.pool, self.filled, self.known = np.zeros(1 << 20, np.uint32), 0, 0

    def _slots(self, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (mix(one + mix(two + size)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def _find(self, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for unknown ones."""
        mask = (1 << self.BITS) - 1
        slot = self._slots(one, two, size)
        out = np.full(len(one), -1, np.int64)
        left = np.arange(len(one))
        while len(left):
            used = self.count[slot] >= 0
            same = used & (self.one[slot] == one[left]) & (self.two[slot] == two[left]) & (self.size[slot] == size[left])
            out[left[same]] = slot[same]
            go = used & ~same
            left, slot = left[go], (slot[go] + 1) & mask
        return out

    def _pooled(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of new runs are, and how many."""
        ids = [self.bpe.chunk_ids(r.decode("utf-8", "surrogatepass")) for r in runs]
        count = np.array([len(b) >> 2 for b in ids], np.int64)
        made = np.frombuffer(b"".join(ids), np.uint32)
        while self.filled + len(made) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.filled : self.filled + len(made)] = made
        where = self.filled + np.cumsum(count) - count
        self.filled += len(made)
        return where, count

    def _add(self, one: np.ndarray, two: np.ndarray, size: np.ndarray, runs: list[bytes]):
        """Takes in new keys, all different, with their runs' ids."""
        where, count = self._pooled(runs)
        self.known += len(runs)
        mask = (1 << self.BITS) - 1
        slot = self._slots(one, two, size)
        left = np.arange(len(one))
        while len(left):
            free = np.flatnonzero(self.count[slot] < 0)
            got = free[np.unique(slot[free], return_index=True)[1]]
            s, k = slot[got], left[got]
            self.one[s], self.two[s], self.size[s], self.where[s], self.count[s] = one[k], two[k], size[k], where[k], count[k]
            rest = np.ones(len(left), bool)
            rest[got] = False
            left, slot = left[rest], (slot[rest] + 1) & mask

    def _short(self, data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slots of runs of at most SHORT bytes, new ones taken in."""
        eight = np.lib.stride_tricks.as_strided(np.frombuffer(data + b"\0" * 2 * self.SHORT, np.uint8), (len(data) + 9, 8), (1, 1))
        one = np.ascontiguousarray(eight[start]).view("<u8").ravel() & self.bits[np.minimum(size, 8)]
        two = np.zeros(len(start), np.uint64)
        more = np.flatnonzero(size > 8)
        two[more] = np.ascontiguousarray(eight[start[more] + 8]).view("<u8").ravel() & self.bits[size[more] - 8]
        size = size.astype(np.uint64)
        slot = self._find(one, two, size)
        new = np.flatnonzero(slot < 0)
        if len(new):
            order = new[np.lexsort((size[new], two[new], one[new]))]
            differs = np.zeros(len(order) - 1, bool)
            for key in (one, two, size):
                differs |= key[order][1:] != key[order][:-1]
            first = order[np.concatenate([[True], differs])]
            self._add(one[first], two[first], size[first], [data[s : s + int(n)] for s, n in zip(start[first].tolist(), size[first].tolist(), strict=True)])
            slot[new] = self._find(one[new], two[new], size[new])
        return slot

    def _long(self, run: bytes) -> tuple[int, int]:
        found = self.long.get(run)
        if found is None:
            where, count = self._pooled([run])
            found = int(where[0]), int(count[0])
            if len(run) <= KEPT_LENGTH:
                self.long[run] = found
        return found

    def _block(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the runs of ``data``, how many ids each has, the ids, and which runs end a sentence."""
        if self.known > 1 << self.BITS - 1 or self.filled > self.POOL:
            self._fresh()
        a = np.frombuffer(data, np.uint8)
        gap = np.concatenate([[True], self.space[a], [True]])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, end = edge[::2], edge[1::2]
        if not len(start):
            return start, np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, bool)
        size = end - start
        where, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        wide = size > self.SHORT
        short = np.flatnonzero(~wide)
        slot = self._short(data, start[short], size[short])
        where[short], count[short] = self.where[slot], self.count[slot]
        for k in np.flatnonzero(wide).tolist():
            where[k], count[k] = self._long(data[start[k] : end[k]])
        stop = np.cumsum(count)
        ids = self.pool[np.repeat(where - (stop - count), count) + np.arange(stop[-1])]
        return start, count, ids, self.SENTENCE_ENDS[a[end - 1]]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids and how many come before each end of a sentence."""
        out: list = [None] * len(texts)
        parts: list[tuple[int, bytes]] = []
        held = 0
        special = "<|" if self.bpe.marks else None

        def flush():
            nonlocal held
            if not parts:
                return
            start, count, ids, ends = self._block(b"\n".join(data for _, data in parts))
            starts = np.cumsum([0] + [len(data) + 1 for _, data in parts])
            runs = np.searchsorted(start, starts)
            stop = np.concatenate([[0], np.cumsum(count)])
            for j, (k, _) in enumerate(parts):
                a, b = runs[j], runs[j + 1]
                made = ids[stop[a] : stop[b]], stop[a + 1 : b + 1][ends[a:b]] - stop[a]
                if out[k] is not None:  # a text in several parts
                    made = np.concatenate([out[k][0], made[0]]), np.concatenate([out[k][1], made[1] + len(out[k][0])])
                out[k] = made
            parts.clear()
            held = 0

        for k, text in enumerate(texts):
            if not text:
                out[k] = np.zeros(0, np.uint32), np.zeros(0, np.int64)
                continue
            if special and special in text:
                pieces = self.bpe.pieces(text)
                stop = np.cumsum([len(b) >> 2 for _, b in pieces])
                out[k] = np.frombuffer(b"".join(b for _, b in pieces), np.uint32), stop[[j for j, (r, _) in enumerate(pieces) if r and r[-1] in ".!?"]].astype(np.int64)
                continue
            data = self.bpe.normalised(text).encode("utf-8", "surrogatepass")
            for part in self._cut(data):
                if held + len(part) + len(parts) > self.BLOCK:
                    flush()
                if len(part) > self.BLOCK:  # a run longer than a block
                    flush()
                    ids = np.frombuffer(self.bpe.chunk_ids(part.decode("utf-8", "surrogatepass").strip()), np.uint32)
                    out[k] = (np.concatenate([out[k][0], ids]), out[k][1]) if out[k] is not None else (ids, np.zeros(0, np.int64))
                    continue
                parts.append((k, part))
                held += len(part)
        flush()
        return out

    def _cut(self, data: bytes) -> list[bytes]:
        """Parts of at most a block, cut at blanks."""
        if len(data) <= self.BLOCK:
            return [data]
        gaps = np.flatnonzero(self.space[np.frombuffer(data, np.uint8)])
        out, at = [], 0
        while at < len(data):
            if len(data) - at <= self.BLOCK:
                end = len(data)
            else:
                k = np.searchsorted(gaps, at + self.BLOCK, side="right") - 1
                if k < 0 or gaps[k] <= at:
                    k += 1
                end = int(gaps[k]) if k < len(gaps) else len(data)
            out.append(data[at:end])
            at = end + 1
        return out


def shared(path: str = VOCABULARY) -> BatchEncoder:
    """One encoder for each worker process, so that its known runs serve all its tasks."""
    return held_by_worker(f"bpe {path}", lambda: BatchEncoder(BacktrackingBPE(path)))


def encode_decode(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, its token ids, and the text decoded from them through the offset table."""

    def make():
        encoder = shared(path)
        texts, _ = encoder.bpe.tables()
        return lambda ids, values: [(k, x.tolist(), texts.join(x).decode()) for k, (x, _) in zip(ids, encoder.encode(values), strict=True)]

    return map_slices(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The query's row per document: count, digest of the ids, digest of what they decode to."""

    def make():
        encoder, sha = shared(path), hashlib.sha256
        texts, numbers = encoder.bpe.tables()
        return lambda ids, values: [(k, len(x), sha(numbers.join(x)).hexdigest(), sha(texts.join(x)).hexdigest()) for k, (x, _) in zip(ids, encoder.encode(values), strict=True)]

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
