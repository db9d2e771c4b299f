"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of token characters of at least LEAST characters.  Its
features are its length and character classes, transitions between classes, the
log-likelihood of its character pairs under pairs of ordinary words, its
coverage by dictionary words, entropy, the words and signs beside it, and
whether the path it comes from is one of tests, examples or lock files.

The path is that of the row together with the last path-like word in the
PATH_CHARS characters before the candidate.

The forest (TREES trees, at most DEPTH deep) is trained from labelled findings:
secrets of many formats and look-alikes (digests, numbers, identifiers, long
words, placeholders) made by a seeded generator and set into sentences of a
sample of at most SAMPLE documents of at most SAMPLE_CHARS characters each.  The dictionary
(words of three documents at least; where those are more than DICTIONARY words or
WORD_CHARS characters, the ones of most documents that fit) and the character
pairs are counted over all documents.  Every document is scanned whole.

Null texts have no candidates.  Rows keep their number, repeated ones and those
without an id too; an empty table gives no rows, and a forest trained without
any sample still separates the formats.  A score equal to the threshold counts
as a secret.  Very long texts and candidates are read whole.  Other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import base64
import re
import string
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import map_slices, staged, table

LEAST, BESIDE, PATH_CHARS = 16, 32, 160
SAMPLE, SAMPLE_CHARS, FINDINGS, TREES, DEPTH, LEAF = 600, 20_000, 3000, 24, 10, 4
THRESHOLD = 0.5
DICTIONARY, WORD_CHARS, MANY = 1 << 18, 1 << 22, 3
#: A task adds up its counts until it has so many words or has read so many characters.
COUNTED_WORDS, COUNTED_CHARS = 1 << 16, 1 << 25
#: Signs of equality behind belong to it as padding, unless a value follows them: then they assign.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{%d,}(?:={1,2}(?![\"'`]?[A-Za-z0-9+/_=]))?" % LEAST)
KEYWORDS = re.compile(r"(?i)(token|secret|api.?key|access.?key|private.?key|passw|pwd|auth|bearer|credential)")
BENIGN = re.compile(r"(?i)(sha\d*|md5|commit|digest|checksum|uuid|hash|etag|revision|version|serial|order|invoice|isbn)")
ASSIGNED = re.compile(r"[=:]\s*[\"'`]?$|(?i:bearer)\s+$")
DULL_PATH = re.compile(r"(?i)(test|example|sample|doc|lock|fixture|vendor|node_modules)")
PATH = re.compile(r"(?:[\w.-]*/)+[\w.-]+|[\w-]+\.(?:py|js|ts|java|go|rb|rs|sh|sql|ya?ml|json|toml|ini|cfg|conf|env|properties|md|rst|txt|lock)\b")
HEX = set("0123456789abcdefABCDEF")
N_FEATURES = 18


class Counts:
    """In how many texts each word is, and pairs of letters beside each other."""

    def __init__(self):
        self.words: Counter[str] = Counter()
        self.pairs = np.zeros(128 * 128, np.int64)
        self.chars = 0

    def add(self, text: str) -> None:
        self.words.update(set(re.findall(r"[A-Za-z]{4,}", text.lower())))
        for at in range(0, len(text), 1 << 20):
            c = np.frombuffer(text[at : at + (1 << 20) + 1].encode("ascii", "replace"), np.uint8).astype(np.int64)
            letter = ((c | 32) >= 97) & ((c | 32) <= 122)
            self.pairs += np.bincount((c[:-1] * 128 + c[1:])[letter[:-1] & letter[1:]], minlength=128 * 128)
        self.chars += len(text)

    def rows(self) -> Iterator[tuple[str, int]]:
        """Words, and pairs as words of two letters; words have four at least."""
        yield from self.words.items()
        for k in np.flatnonzero(self.pairs).tolist():
            yield chr(k // 128) + chr(k % 128), int(self.pairs[k])


def pair_table(pairs: np.ndarray) -> np.ndarray:
    """Log-probability of the second character given the first, over 128 codes."""
    counts = pairs.reshape(128, 128) + 0.05
    return np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


class Featurer:
    def __init__(self, dictionary: list[str], pairs: np.ndarray):
        self.pairs = pairs
        self.words = ahocorasick.Automaton()
        for w in dictionary:
            self.words.add_word(w, len(w))
        self.any = bool(dictionary)
        if self.any:
            self.words.make_automaton()

    def __call__(self, value: str, before: str, after: str, path: str) -> list[float]:
        n = len(value)
        c = np.frombuffer(value.encode("ascii", "replace"), np.uint8)
        digit, upper, lower = (c >= 48) & (c <= 57), (c >= 65) & (c <= 90), (c >= 97) & (c <= 122)
        kind = digit + 2 * upper + 3 * lower
        counts = np.bincount(c, minlength=128)
        share = counts[counts > 0] / n
        covered = 0
        if self.any:
            end_of = -1
            for end, size in self.words.iter_long(value.lower()):
                covered += size if end - size >= end_of else 0
                end_of = end
        longest = max(len(m) for m in re.split(r"[^A-Za-z]", value))
        return [
            min(n, 200), digit.mean(), upper.mean(), lower.mean(), (kind[1:] != kind[:-1]).mean(), float(self.pairs[c[:-1], c[1:]].mean()),
            covered / n, float(-(share * np.log2(share)).sum()), len(share) / n, sum(x in HEX for x in value) / n, float(digit.all()), longest / n,
            float(bool(KEYWORDS.search(before))), float(bool(ASSIGNED.search(before))), float(before[-1:] in "\"'`" and after[:1] in "\"'`" and before != ""),
            float(bool(BENIGN.search(before))), float(bool(DULL_PATH.search(path))), float(n % 4 == 0),
        ]


def near_path(path: str | None, before: str) -> str:
    """The row's path and the last one that ``before`` names."""
    last = path or ""
    for m in PATH.finditer(before):
        last = f"{path or ''} {m.group()}"
    return last


class Forest:
    """Bagged trees with random features at each split, kept as flat arrays."""

    def __init__(self, seed: int = 11):
        self.rng = np.random.default_rng(seed)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        for _ in range(TREES):
            rows = self.rng.integers(0, len(x), len(x))
            self.trees.append(self._tree(x[rows], y[rows]))
        return self

    def _tree(self, x: np.ndarray, y: np.ndarray):
        feature, cut, child, value = [], [], [], []
        todo = [(np.arange(len(x)), 0, -1)]
        while todo:
            rows, depth, parent = todo.pop()
            node = len(feature)
            if parent >= 0:
                child[parent // 2][parent % 2] = node
            p = y[rows].mean()
            feature.append(0), cut.append(0.0), child.append([node, node]), value.append(p)
            if depth == DEPTH or len(rows) < 2 * LEAF or p in (0, 1):
                continue
            best = (np.inf, 0, 0.0)
            for f in self.rng.choice(x.shape[1], 5, replace=False):
                order = np.argsort(x[rows, f], kind="stable")
                v, t = x[rows[order], f], np.cumsum(y[rows[order]])
                left = np.arange(1, len(rows))
                gini = t[:-1] * (1 - t[:-1] / left) + (t[-1] - t[:-1]) * (1 - (t[-1] - t[:-1]) / (len(rows) - left))
                gini[(v[1:] == v[:-1]) | (left < LEAF) | (len(rows) - left < LEAF)] = np.inf
                k = int(gini.argmin())
                if gini[k] < best[0]:
                    best = (gini[k], f, (v[k] + v[k + 1]) / 2)
            if best[0] == np.inf:
                continue
            feature[node], cut[node] = best[1], best[2]
            go = x[rows, best[1]] > best[2]
            todo += [(rows[~go], depth + 1, 2 * node), (rows[go], depth + 1, 2 * node + 1)]
        return np.array(feature), np.array(cut), np.array(child), np.array(value)

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, child, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = child[node, (x[np.arange(len(x)), feature[node]] > cut[node]).astype(int)]
            total += value[node]
        return total / max(1, len(self.trees))


def labelled_findings(sentences: list[str], n: int = FINDINGS, seed: int = 5) -> list[tuple[str, str, str, str, int]]:
    """(value, before, after, path, label) of made secrets and look-alikes."""
    rng = np.random.default_rng(seed)
    pick = lambda seq: seq[int(rng.integers(len(seq)))]
    text = lambda alphabet, k: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), k))
    low, up, num = string.ascii_lowercase, string.ascii_uppercase, string.digits
    sentences = sentences or ["the quick brown fox jumps over the lazy dog while the others are looking at it"]
    words = [w for s in sentences for w in re.findall(r"[A-Za-z]+", s)] or ["word"]
    long = lambda: "".join(pick(words).lower() for _ in range(int(rng.integers(2, 6))))
    b64 = lambda k: base64.b64encode(rng.bytes(k)).decode()
    shout = lambda s: s.upper() if rng.random() < 0.15 else s
    keys = ["token", "secret", "api_key", "API_KEY", "access_key", "password", "passwd", "auth_token", "client_secret", "credential", "private_key"]
    secrets = [
        lambda: text("0123456789abcdef", pick([32, 40, 48, 64])), lambda: text(low + up + num, int(rng.integers(20, 64))), lambda: b64(int(rng.integers(15, 48))),
        lambda: "AKIA" + text(up + num, 16), lambda: "ghp_" + text(low + up + num, 36), lambda: "xoxb-" + text(num, 12) + "-" + text(low + up + num, 24),
        lambda: "sk_live_" + text(low + up + num, 24), lambda: ".".join(b64(k).rstrip("=").replace("+", "-").replace("/", "_") for k in (20, 60, 32)),
    ]
    alike = [
        (lambda: text("0123456789abcdef", 64), ["sha256:", "sha256 ", "digest: ", "checksum = "]), (lambda: text("0123456789abcdef", 40), ["commit ", "revision ", "etag: \"", "hash = \""]),
        (lambda: text("0123456789abcdef", 32), ["md5 ", "md5: "]), (lambda: "-".join(text("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)), ["uuid: ", "id = ", "uuid=\"", " "]),
        (lambda: text(num, int(rng.integers(16, 24))), [" ", "number ", "order ", "serial "]), (long, [" ", " ", "| ", "the "]), (lambda: long().upper(), [" ", "!! "]),
        (lambda: "/".join(pick(words).lower() for _ in range(5)), [" ", "path: ", "from "]), (lambda: "_".join(pick(words).upper() for _ in range(4)), [" ", "key = \"", "token = \""]),
        (lambda: "".join(pick(words).capitalize() for _ in range(4)), [" ", "class ", "new "]), (lambda: pick("aAxX0-=_.") * int(rng.integers(16, 60)), [" ", "password = \"", "token = \""]),
        (lambda: pick(["your-api-key-here", "INSERT_TOKEN_HERE_PLEASE", "example-secret-value", "changeme-changeme-changeme"]), ["api_key = \"", "token: ", "secret="]),
        (lambda: text(num, 4) + "-" + text(num, 2) + "-" + text(num, 2) + "T" + text(num, 6) + "." + text(num, 4), ["at ", "version "]),
    ]
    out = []
    for k in range(n):
        near = pick(sentences)[-BESIDE // 2 :] + " "
        if k % 2:
            value, quote = pick(secrets)(), pick(["\"", "'", ""])
            key = shout(pick(keys))
            before = near + pick([f"{key} = {quote}", f"{key}={quote}", f"{key}: {quote}", f"{key} {quote}", "Authorization: Bearer "])
            if value[:4] in ("AKIA", "ghp_", "xoxb", "sk_l") and rng.random() < 0.5:
                before, quote = near, ""
            value = shout(value) if re.fullmatch("[0-9a-f]+", value) else value
            after, path = quote + " " + pick(sentences)[:BESIDE], pick(["src/app.py", "config/settings.yml", ".env", "deploy.sh", "src7", "src0"])
            out.append((value, before[-BESIDE:], after[:BESIDE], path, 1))
        else:
            make, lead = pick(alike)
            before = near + pick(lead)
            after = ("\"" if before[-1:] == "\"" else "") + " " + pick(sentences)[:BESIDE]
            out.append((make(), before[-BESIDE:], after[:BESIDE], pick(["tests/test_app.py", "docs/example.md", "package-lock.json", "src/app.py", "src3", "src0"]), 0))
    return [f for f in out if CANDIDATE.fullmatch(f[0])]


def model(dictionary: list[str], counts: np.ndarray, texts: list[str]) -> tuple[list[str], np.ndarray, Forest]:
    """Dictionary, character pairs and forest; findings are set into ``texts``."""
    pairs = pair_table(counts)
    sentences = [s.strip() for t in texts for s in re.split(r"[.\n]", t) if len(s) > 20]
    findings = labelled_findings(sentences)
    featurer = Featurer(dictionary, pairs)
    x = np.array([featurer(*f[:4]) for f in findings])
    return dictionary, pairs, Forest().fit(x, np.array([f[4] for f in findings], float))


def fit(texts: list[str]) -> tuple[list[str], np.ndarray, Forest]:
    """``model`` of texts at hand."""
    counts = Counts()
    for t in texts:
        counts.add(t)
    return model(sorted(w for w, k in counts.words.items() if k >= MANY), counts.pairs, texts)


def counted(docs: DataFrame) -> DataFrame:
    """word, n over all texts: ``Counts.rows`` added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            words, n = zip(*counts.rows(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

        counts = Counts()
        for batch in batches:
            for text in batch.column(0):
                counts.add(text.as_py() or "")
                if len(counts.words) > COUNTED_WORDS or counts.chars > COUNTED_CHARS and counts.pairs.any():
                    yield out()
                    counts = Counts()
        if counts.pairs.any():
            yield out()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def dictionary_of(words: DataFrame) -> list[str]:
    """The words of MANY texts at least, or those above the least count at which DICTIONARY and WORD_CHARS hold."""
    grade = F.floor(F.log2("n") * 64).cast("long")
    least, total, chars = None, 0, 0
    graded = words.filter((F.length("word") >= 4) & (F.col("n") >= MANY)).withColumn("grade", grade)
    for r in graded.groupBy("grade").agg(F.count("*").alias("k"), F.sum(F.length("word")).alias("chars")).orderBy(F.desc("grade")).collect():
        total, chars = total + r.k, chars + r.chars
        if total > DICTIONARY or chars > WORD_CHARS:
            break
        least = r.grade
    return [] if least is None else sorted(r.word for r in graded.filter(F.col("grade") >= least).select("word").collect())


def scan(docs: DataFrame, model: tuple[list[str], np.ndarray, Forest], threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, path): counts, highest score, findings as start:end (code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        dictionary, pairs, forest = shared.value
        featurer = Featurer(dictionary, pairs)

        def several(ids, texts, paths):
            x, where = [], []
            for k, (text, path) in enumerate(zip(texts, paths, strict=True)):
                for m in CANDIDATE.finditer(text or ""):
                    s, e = m.span()
                    x.append(featurer(m.group(), text[max(0, s - BESIDE) : s], text[e : e + BESIDE], near_path(path, text[max(0, s - PATH_CHARS) : s])))
                    where.append((k, s, e))
            scores = forest.predict(np.array(x)) if x else []
            total, most, found = [0] * len(ids), [0.0] * len(ids), [[] for _ in ids]
            for (k, s, e), score in zip(where, scores, strict=True):
                total[k] += 1
                most[k] = max(most[k], float(score))
                if score >= threshold:
                    found[k].append(f"{s}:{e}")
            return [(i, t, len(f), m, ",".join(f)) for i, t, m, f in zip(ids, total, most, found, strict=True)]

        return several

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("path").cast("string")), make, "doc_id long, n_candidates long, n_secrets long, max_score double, spans string")


def sampled(docs: DataFrame) -> list[str]:
    """At most SAMPLE texts of at most SAMPLE_CHARS characters, by a hash of row; other rows fall out where they are read, so tasks send few."""
    total, of = docs.count(), 1 << 30
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(of))
    some = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.length("text").between(1, SAMPLE_CHARS)).filter(place < min(of, 4 * SAMPLE * of // max(1, total) + 1))
    return [r.text for r in some.orderBy(place, "doc_id").limit(SAMPLE).collect()]


def trained(docs: DataFrame) -> tuple[list[str], np.ndarray, Forest]:
    words = staged(counted(docs), "words")
    pairs = np.zeros(128 * 128, np.int64)
    for r in words.filter(F.length("word") == 2).collect():
        pairs[ord(r.word[0]) * 128 + ord(r.word[1])] = r.n
    return model(dictionary_of(words), pairs, sampled(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("path"))
    return scan(docs, trained(docs))
