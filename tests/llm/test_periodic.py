import hashlib
import random
import zlib

from quire.llm import periodic


def brute(words, least=6, exponent=4):
    """Runs by every period and place."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - a
            if length >= max(least, exponent * q) and not any(all(words[k] == words[k + d] for k in range(a, a + length - d)) for d in range(1, q)):
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 40))]
    if rng.random() < 0.6:
        root = [rng.choice("abé") for _ in range(rng.randint(1, 6))]
        words[3:3] = root * rng.randint(2, 8) + root[: rng.randint(0, len(root))]
    return words


def test_runs_same_as_brute_force():
    rng = random.Random(4)
    for _ in range(1500):
        words = random_words(rng)
        for least, exponent in ((6, 4), (2, 2), (3, 3)):
            assert periodic.runs_of(words, least, exponent) == brute(words, least, exponent), words


def test_lyndon_arrays_same_as_suffixes():
    rng = random.Random(5)
    for _ in range(800):
        s = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 40))]
        after, match = periodic.lyndon(s)
        for i in range(len(s)):
            j = next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s))
            m = 0
            while j + m < len(s) and s[i + m] == s[j + m]:
                m += 1
            assert (after[i], match[i]) == (j, m)


def test_linear_on_repetitive_texts():
    """Comparisons stay in proportion to the length, on words that match far."""

    class Counted(int):
        seen = 0

        def __eq__(self, other):
            Counted.seen += 1
            return int(self) == int(other)

        __hash__ = int.__hash__

    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    for s in (b[:20_000], [1] * 20_000, [0] * 10_000 + [1] + [0] * 10_000, ([0] * 100 + [1]) * 198, list(range(200)) * 100):
        Counted.seen = 0
        periodic.lyndon([Counted(x) for x in s])
        assert Counted.seen < 4 * len(s)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    shown = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(shown), digest(b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))


def test_query_same_as_brute_force(spark, documents):
    rng = random.Random(6)
    rows = [(k, rng.choice([" ", "\n", "\t \x0b", "\r\f"]).join(random_words(rng))) for k in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (None, "a " * 9), (None, None), (5, "x x x x x x x"), (5, "x x x x x x x"), (1003, "a a " * 8), (1004, "w " * 30_000), (1005, "one two three four five six seven")]
    got = periodic.query(spark, documents(rows)).collect()
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    key = lambda r: tuple((x is None, x) for x in r)
    small = sorted(((r.doc_id, *(r[c] for c in columns)) for r in got if r.doc_id != 1004), key=key)
    assert small == sorted(((d, *expected(d, t)) for d, t in rows if d != 1004), key=key)
    long = next(r for r in got if r.doc_id == 1004)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 30_000, 1)


def test_empty_table_and_texts(spark, documents):
    assert periodic.query(spark, documents([])).count() == 0
    out = periodic.with_runs(spark.createDataFrame([(1, "a b c c c c c c d")], "doc_id long, text string")).first()
    assert out.collapsed == "a b c d" and [tuple(r) for r in out.runs] == [(2, 6, 1)]
