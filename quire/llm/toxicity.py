"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input has three parts.  Its own vector, learned, for words of enough
training texts.  The mean of the learned vectors of its hashed character n-grams
with marks at both ends, so unseen words built from known parts get a sensible
input.  And evidence: the smoothed log-odds of being in a toxic training text, of
the word and (largest and mean) of its n-grams; a training text's own counts are
taken out for that text, so rare words do not give it away.

Windows of WINDOW words start every STEP words, a quarter of a window, and the
last ends with the text: all of them are scored, and any passage of WINDOW - STEP
+ 1 words is whole in one.  In each window both directions' states are pooled by
attention into one logit; a text's score is that of its highest window.

Training takes a bounded sample of labelled rows (at most PER_CLASS of each
label, by a hash of the id, of texts of at most SAMPLE_CHARS characters) and
learns from each text's currently highest window and from random windows of
clean texts, since labels are for texts.  The weights of the later rounds are
averaged.

Null, empty and letterless texts have one empty window, whose score is the
network's for no input.  Without both labels to learn from all scores are 0.
Repeated rows and rows without an id are scored like any other; labels with
conflicting rows are left out of training; a score equal to the threshold is
toxic; an empty ``documents`` gives no rows.  Texts of any length are scored
whole, BATCH_WINDOWS windows at a time.  Other columns are carried or not looked
at, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quire.llm.common import doc_id_crc_mod, held_by_worker, table

WINDOW, STEP = 48, 12
#: Hidden units of a direction, and the length of a word's own vector and of its n-grams'.
HIDDEN, LEARNED, EVIDENCE = 8, 6, 3
WIDTH = EVIDENCE + 2 * LEARNED
#: Rows of the tables of words, of n-grams' log-odds, and of n-grams' vectors.
WORD_ROWS, GRAM_ROWS, VECTOR_ROWS = 1 << 17, 1 << 19, 1 << 12
GRAMS = (3, 4, 5, 6)
#: Training texts, and their share, that a word or n-gram with a vector is in: what fewer have would be learned by heart.
MIN_TEXTS, MIN_SHARE = 3, 0.01
#: Most labelled texts of each label that are learned from, their most characters, and windows scored at once.
PER_CLASS, SAMPLE_CHARS, BATCH_WINDOWS = 1000, 20_000, 1 << 10
ROUNDS, STEPS, BATCH, RATE, DECAY, DROPPED = 4, 80, 64, 0.01, 1e-4, 0.3
KEPT_WORDS = 300_000
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W\d_]+")
#: Tables of vectors, of which only rows that enough texts have move.
KNOWN = ("word", "gram")
#: Steps of the later rounds whose weights are averaged: every so many.
AVERAGED = 8


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def features(word: str) -> tuple[int, list[int]]:
    """Row of the word itself, rows of its n-grams."""
    marked = f"^{word}$".encode()
    n = len(marked)
    crc = zlib.crc32
    grams = [crc(marked[i : i + k]) & (GRAM_ROWS - 1) for k in GRAMS for i in range(n - k + 1)]
    return crc(marked) & (WORD_ROWS - 1), grams or [crc(marked) & (GRAM_ROWS - 1)]


def starts(n: int) -> np.ndarray:
    """Where the windows over ``n`` words begin; all have WINDOW words, or all the words there are."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STEP), n - WINDOW)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Vocabulary:
    """Word to row number; row 0 is no word.  Keeps feature rows in flat arrays."""

    def __init__(self):
        self.row: dict[str, int] = {}
        self.own, self.flat, self.sizes = array("i", [0]), array("i", [0]), array("i", [1])

    def add(self, words: list[str]) -> np.ndarray:
        row = self.row
        for w in words:
            if w not in row:
                row[w] = len(self.own)
                own, grams = features(w)
                self.own.append(own)
                self.flat.extend(grams)
                self.sizes.append(len(grams))
        return np.array([row[w] for w in words], np.int32)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word rows, n-gram rows end to end, and where each word's begin (and the last's end)."""
        return np.array(self.own, np.int32), np.array(self.flat, np.int32), np.concatenate([[0], np.cumsum(self.sizes)])


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Of a text with the feature, shrunk by how many texts have it."""
    n = toxic + clean
    raw = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return (np.clip(raw, -4, 4) * n / (n + 4)).astype(np.float32)


def evidence(words: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log-odds of words, and the largest and mean ones of their n-grams."""
    first = np.cumsum(sizes) - sizes
    return np.stack([words, np.maximum.reduceat(grams, first), np.add.reduceat(grams, first) / sizes], 1).astype(np.float32) if len(sizes) else np.zeros((0, EVIDENCE), np.float32)


class Network:
    """Weights; rows of words and n-grams in too few texts stay zero."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        init = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        h, d = HIDDEN, WIDTH
        self.p = {"word": init(WORD_ROWS, LEARNED, s=0.1), "gram": init(VECTOR_ROWS, LEARNED, s=0.1), "odds_word": np.zeros(WORD_ROWS, np.float32), "odds_gram": np.zeros(GRAM_ROWS, np.float32)}
        for side in "fb":
            self.p |= {f"W{side}": init(d, 3 * h, s=0.4), f"U{side}": init(h, 3 * h, s=0.3), f"c{side}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": init(2 * h, h, s=0.3), "a": init(h, s=0.5), "o": init(2 * h, s=0.5), "b": np.full(1, -1.0, np.float32)}

    def vectors(self, own: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Learned inputs of words with these word rows and, end to end, n-gram rows."""
        grams = np.add.reduceat(self.p["gram"][flat % VECTOR_ROWS], np.cumsum(sizes) - sizes) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][own], grams], 1)

    def inputs(self, own: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        p = self.p
        return np.concatenate([evidence(p["odds_word"][own], p["odds_gram"][flat], sizes), self.vectors(own, flat, sizes)], 1)

    def _run(self, gates: np.ndarray, present: np.ndarray, side: str, keep: list) -> np.ndarray:
        """States [time, window, hidden] of one direction; gates has the projected inputs."""
        steps, n, _ = gates.shape
        h, U = HIDDEN, self.p[f"U{side}"]
        out = np.zeros((steps, n, h), gates.dtype)
        state = np.zeros((n, h), gates.dtype)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            g = gates[t]
            u = state @ U
            zr = sigmoid(g[:, : 2 * h] + u[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(g[:, 2 * h :] + r * u[:, 2 * h :])
            m = present[t][:, None]
            keep.append((t, state, z, r, c, u[:, 2 * h :], m))
            state = out[t] = state + m * z * (c - state)
        return out

    def logits(self, x: np.ndarray, present: np.ndarray, tape: dict) -> np.ndarray:
        """Of windows of inputs [time, window, width]; ``tape`` gets what gradients need."""
        p, keep_f, keep_b = self.p, [], []
        s = np.concatenate([self._run(x @ p["Wf"] + p["cf"], present, "f", keep_f), self._run(x @ p["Wb"] + p["cb"], present, "b", keep_b)], 2)
        q = np.tanh(s @ p["A"])
        e = q @ p["a"] + np.where(present > 0, 0, -1e4).astype(np.float32)
        w = np.exp(e - e.max(0))
        w = w / w.sum(0) * present.max(0)
        pooled = np.einsum("tn,tnh->nh", w, s)
        tape |= {"s": s, "q": q, "w": w, "pooled": pooled, "f": keep_f, "b": keep_b}
        return pooled @ p["o"] + p["b"][0]

    def gradients(self, x: np.ndarray, present: np.ndarray, target: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean cross-entropy, for the dense weights and the inputs."""
        p, h, tape = self.p, HIDDEN, {}
        z = self.logits(x, present, tape)
        n = len(target)
        dz = ((sigmoid(z) - target) / n).astype(x.dtype)
        g = {"b": np.array([dz.sum()]), "o": tape["pooled"].T @ dz}
        s, q, w = tape["s"], tape["q"], tape["w"]
        d_pooled = dz[:, None] * p["o"]
        d_s = w[:, :, None] * d_pooled
        d_w = np.einsum("nh,tnh->tn", d_pooled, s)
        d_e = w * (d_w - (w * d_w).sum(0))
        g["a"] = np.einsum("tn,tnh->h", d_e, q)
        d_q = d_e[:, :, None] * p["a"] * (1 - q * q)
        g["A"] = s.reshape(-1, 2 * h).T @ d_q.reshape(-1, h)
        d_s = d_s + d_q @ p["A"].T
        d_x = np.zeros_like(x)
        for side, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            U = p[f"U{side}"]
            d_gates, d_U = np.zeros((*present.shape, 3 * h), x.dtype), np.zeros_like(U)
            d_state = np.zeros((n, h), x.dtype)
            for t, before, zt, r, c, uc, m in reversed(tape[side]):
                d_new = d_s[t][:, part] + d_state
                d_c = d_new * m * zt * (1 - c * c)
                d_zt = d_new * m * (c - before) * zt * (1 - zt)
                d_r = d_c * uc * r * (1 - r)
                d_u = np.concatenate([d_zt, d_r, d_c * r], 1)
                d_gates[t] = np.concatenate([d_zt, d_r, d_c], 1)
                d_U += before.T @ d_u
                d_state = d_new * (1 - m * zt) + d_u @ U.T
            g[f"U{side}"], g[f"c{side}"] = d_U, d_gates.sum((0, 1))
            g[f"W{side}"] = x.reshape(-1, WIDTH).T @ d_gates.reshape(-1, 3 * h)
            d_x += d_gates @ p[f"W{side}"].T
        return g, d_x


class Adam:
    """Steps of weights; of tables only the rows that have gradients move."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.p, self.step = weights, 0
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items() if not k.startswith("odds")}

    def _move(self, name: str, rows, grad: np.ndarray):
        m, v = (x[rows] for x in self.moments[name])
        m, v = m + 0.1 * (grad - m), v + 0.001 * (grad * grad - v)
        self.moments[name][0][rows], self.moments[name][1][rows] = m, v
        old = self.p[name][rows]
        self.p[name][rows] = old * (1 - DECAY) - RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)

    def __call__(self, dense: dict[str, np.ndarray], tables: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.step += 1
        for name, grad in dense.items():
            self._move(name, slice(None), grad)
        for name, (rows, grad) in tables.items():
            self._move(name, rows, grad)


def summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    r = rows[order]
    first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    return r[first], np.add.reduceat(values[order], first)


class Scorer:
    """Scores texts with projected inputs kept for each word.

    Units come before windows in arrays, so every step works on long rows.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.net, p, h = Network.__new__(Network), weights, HIDDEN
        self.net.p = weights
        # A sigmoid is half of a hyperbolic tangent of half its input, and one half.
        half = np.repeat(np.array([0.5, 1.0], np.float32), [2 * h, h])
        self.wide = np.concatenate([p["Wf"] * half, p["Wb"] * half], 1)
        self.bias = np.concatenate([p["cf"] * half, p["cb"] * half])
        self.U = [np.ascontiguousarray((p[f"U{side}"] * half).T) for side in "fb"]
        self.pool = np.ascontiguousarray(np.concatenate([p["A"], p["o"][:, None]], 1).T)
        self._fresh()

    def _fresh(self):
        self.row: dict[str, int] = {}
        self.table = np.zeros((2, KEPT_WORDS + (1 << 16), 3 * HIDDEN), np.float32)  # pages are taken as they fill
        self.table[:, 0, :HIDDEN] = -1e4  # no word: the state stays
        self.filled = 1

    def _learn(self, words: list[str]):
        """Rows for words not seen before."""
        v = Vocabulary()
        v.add(words)
        own, flat, bounds = v.arrays()
        made = self.net.inputs(own[1:], flat[1:], np.diff(bounds)[1:]) @ self.wide + self.bias
        more = self.filled + len(made) - self.table.shape[1]
        if more > 0:
            self.table = np.concatenate([self.table, np.zeros((2, more, 3 * HIDDEN), np.float32)], 1)
        self.table[:, self.filled : self.filled + len(made)] = made.reshape(len(made), 2, -1).transpose(1, 0, 2)
        self.row.update(zip(v.row, range(self.filled, self.filled + len(made)), strict=True))
        self.filled += len(made)

    def _states(self, side: int, grid: np.ndarray, out: np.ndarray):
        """States of one direction into ``out`` [time, hidden, window]."""
        (steps, n), h = grid.shape, HIDDEN
        state, u = np.zeros((h, n), np.float32), np.empty((3 * h, n), np.float32)
        zr, z, r, c = u[: 2 * h], u[:h], u[h : 2 * h], u[2 * h :]
        for t in range(steps - 1, -1, -1) if side else range(steps):
            g = self.table[side][grid[t]].T
            np.matmul(self.U[side], state, out=u)
            zr += g[: 2 * h]
            np.tanh(zr, out=zr)
            zr += 1  # twice the gates
            c *= r
            c *= 0.5
            c += g[2 * h :]
            np.tanh(c, out=c)
            c -= state
            c *= z
            c *= 0.5
            state = np.add(state, c, out=out[t])

    def _logits(self, grid: np.ndarray) -> np.ndarray:
        """Of windows of word rows [time, window]."""
        p, h = self.net.p, HIDDEN
        s = np.empty((len(grid), 2 * h, grid.shape[1]), np.float32)
        self._states(0, grid, s[:, :h])
        self._states(1, grid, s[:, h:])
        q = self.pool @ s
        value = q[:, h].copy()
        e = np.tensordot(p["a"], np.tanh(q[:, :h]), (0, 1))
        empty = grid == 0
        e[empty] = -1e4
        w = np.exp(e - e.max(0))
        w *= ~empty[0] / w.sum(0)
        return (w * value).sum(0) + p["b"][0]

    def window_logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text, the logits of all its windows."""
        if len(self.row) > KEPT_WORDS:
            self._fresh()
        row = self.row
        found = [[row.get(w, 0) for w in text] for text in texts]
        new = {w: None for text, rows in zip(texts, found, strict=True) if 0 in rows for w, k in zip(text, rows, strict=True) if not k}
        if new:
            self._learn(list(new))
            found = [[row[w] for w in text] if 0 in rows else rows for text, rows in zip(texts, found, strict=True)]
        sizes = np.array([len(x) for x in found])
        words = np.concatenate([np.fromiter((k for x in found for k in x), np.int32, int(sizes.sum())), np.zeros(WINDOW, np.int32)])
        begins = [starts(n) for n in sizes.tolist()]
        counts = np.array([len(x) for x in begins])
        begin = np.concatenate(begins) + np.repeat(np.cumsum(sizes) - sizes, counts)
        length = np.repeat(np.minimum(sizes, WINDOW), counts)
        out = np.zeros(len(begin), np.float32)
        by = np.argsort(length, kind="stable")  # windows of like lengths together
        for at in range(0, len(by), BATCH_WINDOWS):
            some = by[at : at + BATCH_WINDOWS]
            step = np.arange(max(1, int(length[some[-1]])))[:, None]
            grid = words[begin[some] + step]
            if length[some[0]] < len(step):
                grid[step >= length[some]] = 0
            out[some] = self._logits(grid)
        return np.split(out, np.cumsum(counts)[:-1])

    def scores(self, texts: list[str | None]) -> list[float]:
        return [float(sigmoid(z.max())) for z in self.window_logits([words_of(t) for t in texts])] if texts else []


def _scorer(weights: dict[str, np.ndarray]) -> Scorer:
    """The worker's scorer for these weights: its known words serve further tasks."""
    return held_by_worker(f"toxicity {zlib.crc32(weights['gram'].tobytes())}", lambda: Scorer(weights))


def fit(texts: list[str | None], toxic: list[int], seed: int = 7, without: tuple[str, ...] = ()) -> dict[str, np.ndarray] | None:
    """Weights learned from labelled texts; None without both labels.  ``without`` leaves out parts ("word", "gram", "odds_word", "odds_gram"), for comparisons."""
    toxic_of = np.array(toxic, np.float32)
    if not len(toxic_of) or toxic_of.min() == toxic_of.max():
        return None
    rng = np.random.default_rng(seed)
    net, vocabulary = Network(seed), Vocabulary()
    ids = [vocabulary.add(words_of(t)) for t in texts]
    names = ["", *vocabulary.row]
    own, flat, bounds = vocabulary.arrays()
    p, known = net.p, {name: np.zeros(len(p_), np.int32) for name, p_ in net.p.items() if name in KNOWN}
    for x in ids:
        rows = np.unique(x)
        known["word"][np.unique(own[rows])] += 1
        known["gram"][np.unique(flat[ranges(bounds[rows], np.diff(bounds)[rows])] % VECTOR_ROWS)] += 1
    for name in KNOWN:
        known[name] = (known[name] >= max(MIN_TEXTS, MIN_SHARE * len(ids))) & (name not in without)
        p[name] *= known[name][:, None]
    # What is known of a text's words from the other texts, so rare words do not give it away.
    n_of = [float((toxic_of == y).sum()) for y in (0, 1)]
    tables_of = [np.zeros((2, n), np.float32) for n in (WORD_ROWS, GRAM_ROWS)]

    def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a text's words: their word rows, n-gram rows end to end and how many, and which word is where."""
        rows, back = np.unique(x, return_inverse=True)
        sizes = np.diff(bounds)[rows]
        return own[rows], flat[ranges(bounds[rows], sizes)], sizes, back

    for x, y in zip(ids, toxic_of.astype(int).tolist(), strict=True):
        for t, where in zip(tables_of, distinct(x)[:2], strict=True):
            t[y, np.unique(where)] += 1
    p |= {name: log_odds(t[1], t[0], n_of[1], n_of[0]) * (name not in without) for name, t in zip(("odds_word", "odds_gram"), tables_of, strict=True)}
    known_of = []
    for x, y in zip(ids, toxic_of, strict=True):
        *where, sizes, back = distinct(x)
        odds = [log_odds(t[1][w] - y, t[0][w] - (1 - y), n_of[1] - y, n_of[0] - (1 - y)) * (name not in without) for name, t, w in zip(("odds_word", "odds_gram"), tables_of, where, strict=True)]
        known_of.append(evidence(*odds, sizes)[back].astype(np.float16))
    begins = [starts(len(x)) for x in ids]
    groups = [np.flatnonzero(toxic_of == y) for y in (0, 1)]
    adam = Adam(p)

    def tables(rows: np.ndarray, grams: np.ndarray, sizes: np.ndarray, d_rows: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Gradients of the vectors that are learned, from those of the inputs of ``rows``."""
        moved = {}
        for name, where, d in (("word", own[rows], d_rows[:, :LEARNED]), ("gram", grams % VECTOR_ROWS, np.repeat(d_rows[:, LEARNED:] / sizes[:, None], sizes, 0))):
            some = known[name][where]
            if some.any():
                moved[name] = summed(where[some], d[some])
        return moved

    top, mean, taken = None, None, 0
    for k in range(ROUNDS):
        for step in range(STEPS):
            picked = np.concatenate([rng.choice(g, BATCH // 2) for g in groups])
            grid, facts = np.zeros((WINDOW, len(picked)), np.int64), np.zeros((WINDOW, len(picked), EVIDENCE), np.float32)
            for i, j in enumerate(picked):
                best = top is not None and (toxic_of[j] or i % 2)
                at = begins[j][top[j] if best else rng.integers(len(begins[j]))]
                some = ids[j][at : at + WINDOW]
                grid[: len(some), i], facts[: len(some), i] = some, known_of[j][at : at + WINDOW]
            rows, back = np.unique(grid, return_inverse=True)
            back, sizes = back.reshape(grid.shape), np.diff(bounds)[rows]
            grams = flat[ranges(bounds[rows], sizes)]
            x = net.vectors(own[rows], grams, sizes)[back]
            kept = np.repeat(rng.random((2, *grid.shape)) > DROPPED, LEARNED, 0).transpose(1, 2, 0) * (grid > 0)[:, :, None]
            dense, d_x = net.gradients(np.concatenate([facts, x * kept], 2).astype(np.float32), (grid > 0).astype(np.float32), toxic_of[picked])
            _, d_rows = summed(back.ravel(), (d_x[:, :, EVIDENCE:] * kept).reshape(-1, 2 * LEARNED))
            adam(dense, tables(rows, grams, sizes, d_rows))
            if k >= ROUNDS // 2 and step % AVERAGED == 0:
                taken += 1
                if mean is None:
                    mean = {n: v.copy() for n, v in p.items()}
                for n, m in mean.items():
                    m += (p[n] - m) / taken
        if k < ROUNDS - 1:
            scorer = Scorer(p)
            some = (ids[at : at + BATCH] for at in range(0, len(ids), BATCH))
            top = [int(z.argmax()) for part in some for z in scorer.window_logits([[names[i] for i in x] for x in part])]
            del scorer
    return {n: v.astype(np.float32) for n, v in (mean or p).items()}


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[list[str], list[int]]:
    """At most ``per_class`` texts of each label, by a hash of the id, among those that are short enough; ids with conflicting labels are left out.

    Ids are chosen before any text is read for the driver.
    """
    known = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most and toxic in (0, 1)").select("doc_id", "toxic")
    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS).select("doc_id")
    fit_for = known.join(short, "doc_id", "left_semi")
    chosen = None
    for y in (0, 1):
        some = fit_for.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = docs.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").limit(2 * per_class)
    found = rows.collect()
    return [r.text for r in found], [r.toxic for r in found]


def _scored(docs: DataFrame, weights: dict[str, np.ndarray] | None, columns: list[str]) -> DataFrame:
    """Columns _0, _1, ... for ``columns``, whatever their names, and _score."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(columns)], *([] if "text" in columns else [F.col("text").alias("_text")]))
    where = columns.index("text") if "text" in columns else len(columns)
    schema = StructType([*[inner.schema[f"_{k}"] for k in range(len(columns))], StructField("_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model.value) if model.value else None
        for batch in batches:
            step = max(1, int(batch.num_rows * (1 << 20) / max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = part.column(where).to_pylist()
                made = scorer.scores(texts) if scorer else [0.0] * len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], pa.array(made, pa.float64())], [*part.schema.names[: len(columns)], "_score"])

    return inner.mapInArrow(run, schema)


def score(docs: DataFrame, weights: dict[str, np.ndarray] | None) -> DataFrame:
    """doc_id and score of each row."""
    return _scored(docs, weights, ["doc_id"]).select(F.col("_0").alias("doc_id"), F.col("_score").alias("score"))


def below(docs: DataFrame, weights: dict[str, np.ndarray] | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with their columns, that score under ``threshold``."""
    return _scored(docs, weights, docs.columns).filter(F.col("_score") < threshold).select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)])


def trained(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray] | None:
    """Learned from labelled rows whose crc32(doc_id as text) mod 3 is not 1."""
    return fit(*labelled_sample(docs, labels.filter(doc_id_crc_mod(3) != 1)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    out = score(docs, trained(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (doc_id_crc_mod(3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
