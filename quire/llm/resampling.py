"""Importance resampling towards a target distribution, over hashed word n-grams.

Words are runs of ASCII digits and letters and of everything beyond ASCII, with
A-Z in lower case.  Features are the runs of 1 to ``most`` consecutive words.
Each block of texts (a slice of an Arrow batch) has an integer dictionary: its
distinct words get ids, an n-gram is the tuple of its words' ids, and each
distinct tuple's bytes are put together and hashed once; the counts are joined
back by the tuple's place.  Tuples are told apart exactly: one of n words is the
pair of the place of its first n - 1 words' tuple and its last word's id.

Three passes, none of which shuffles a text or a word:

* counts of features by bucket, of the raw and the target texts: BUCKETS rows a block at most, added up by Spark;
* gains, floor(1000 * ln((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS)))), a table of BUCKETS rows that the scoring pass carries;
* each document's floored mean of gains, plus Gumbel noise from a hash of its id: the highest scores of the documents with LEAST_WORDS words are drawn.

Ranks come from one range-partitioned sort of (doc_id, score): a row's place in
its part plus the rows of the parts before, of which there is one number a part.

Null and empty texts, and those without a word, have no features and a weight of
0; they are not drawn where LEAST_WORDS is above 0.  Equal rows get equal scores
and following ranks.  Rows without an id have no noise: their score and rank are
null, they are not counted among the documents to draw from, but their words
count.  An empty table gives no rows; with empty target texts every gain is that
of no counts.  Texts of any length are taken whole, a block has at least one.
Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.llm.common import map_slices, staged, table

NGRAM, BUCKETS, SEED, PERCENT, LEAST_WORDS = 1, 10_000, 2024, 10, 20
#: In a text whose A-Z are in lower case.
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


class Block:
    """The features of a block of texts: ``buckets`` of its distinct tuples, and of each feature its text and tuple."""

    def __init__(self, texts: list[str | None], most: int = NGRAM, buckets: int = BUCKETS):
        ids: dict[str, int] = {}
        lists = [[ids.setdefault(w, len(ids)) for w in words_of(t)] for t in texts]
        self.n_words = np.array([len(x) for x in lists], np.int64)
        words = np.fromiter((k for x in lists for k in x), np.int64, int(self.n_words.sum()))
        owner = np.repeat(np.arange(len(lists)), self.n_words)
        names = [w.encode("utf-8", "surrogatepass") for w in ids]
        at, tuples, spelled = np.arange(len(words)), words, names  # where the tuples of this length start, which they are, their bytes
        owners, features, hashed, before = [owner], [words], [self._hash(names, buckets)], len(names)
        for n in range(2, most + 1):
            whole = at + n - 1 < len(words)
            whole[whole] = owner[at[whole]] == owner[at[whole] + n - 1]
            at, tuples = at[whole], tuples[whole]
            pair = tuples * max(1, len(names)) + words[at + n - 1]
            distinct, tuples = np.unique(pair, return_inverse=True)
            spelled = [spelled[p // len(names)] + b" " + names[p % len(names)] for p in distinct.tolist()]
            owners.append(owner[at])
            features.append(tuples + before)
            hashed.append(self._hash(spelled, buckets))
            before += len(spelled)
        self.owner, self.feature, self.buckets = np.concatenate(owners), np.concatenate(features), np.concatenate(hashed)

    @staticmethod
    def _hash(tuples: list[bytes], buckets: int) -> np.ndarray:
        return np.fromiter((zlib.crc32(t) % buckets for t in tuples), np.int64, len(tuples))

    def counts(self) -> list[tuple[int, int]]:
        """(bucket, features in it)."""
        of_tuples = np.bincount(self.feature, minlength=len(self.buckets))
        found = np.bincount(self.buckets, of_tuples, minlength=1).astype(np.int64)
        return [(int(b), int(found[b])) for b in np.flatnonzero(found)]

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: its features, and the sum of their buckets' gains."""
        n = len(self.n_words)
        of_feature = gains[self.buckets][self.feature]
        total = np.zeros(n, np.int64)
        np.add.at(total, self.owner, of_feature)
        return np.bincount(self.owner, minlength=n), total


def bucket_counts(texts: DataFrame, most: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts of a table with a column ``text``."""
    found = map_slices(texts.select(F.col("text").cast("string")), lambda: lambda ts: Block(ts, most, buckets).counts(), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from counts (bucket, n) of the raw and the target texts."""
    spark = raw.sparkSession
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(raw.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    # At most ``buckets`` rows.
    whole = Window.partitionBy(F.lit(0))
    ratio = ((F.col("t") + 1).cast("double") * (F.sum("s").over(whole) + buckets)) / ((F.col("s") + 1).cast("double") * (F.sum("t").over(whole) + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weights(docs: DataFrame, gain_of: list[int], most: int = NGRAM) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of the features' gains, 0 without features."""

    def make():
        held = np.array(gain_of, np.int64)

        def several(doc_ids, texts):
            block = Block(texts, most, len(held))
            n, total = block.sums(held)
            return list(zip(doc_ids, block.n_words.tolist(), n.tolist(), (total // np.maximum(n, 1)).tolist(), strict=True))

        return several

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from 32 bits of a hash of the seed and the id; null without an id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: 1, 2, ... by ``order``, without a task that sees more than a part of the sorted rows."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for b in batches:
            yield b.append_column(pa.field("_place", pa.int64()), pa.array(np.arange(seen + 1, seen + b.num_rows + 1), pa.int64()))
            seen += b.num_rows

    parted = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    schema = StructType([*parted.schema.fields, StructField("_place", LongType())])
    placed = staged(parted.mapInArrow(run, schema), "ranked")
    # A row for each part.
    w = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return placed.join(F.broadcast(before), "_part").select(*names, (F.col("_before") + F.col("_place")).alias(name))


def resampled(docs: DataFrame, target: DataFrame, most: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank (of the drawn) by closeness to ``target`` (text)."""
    table_ = gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets), buckets)
    gain_of = [r.gain for r in table_.orderBy("bucket").collect()]  # ``buckets`` numbers
    scored = staged(weights(docs, gain_of, most).withColumn("score", F.col("weight") + noise(seed)), "weights")
    entered = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    places = ranked(scored.filter(entered), [F.desc("score"), F.asc("doc_id")], "rank")
    drawn = F.floor(F.lit(percent).cast("long") * scored.filter(entered).count() / 100)
    rest = scored.filter(~entered).withColumn("rank", F.lit(None).cast("long"))
    out = places.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The check value of a word's bytes, by the usual table of 256 remainders, once for each distinct word.
ORACLE = f"""
WITH crc AS (SELECT list(v ORDER BY b) AS tab FROM (SELECT b, list_reduce([CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b))),
w AS (SELECT 's' AS side, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
  UNION ALL SELECT 't', NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
c AS (SELECT side, id, word, count(*) AS n FROM w GROUP BY ALL),
hx AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM c)),
bk AS (SELECT word, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(len(h) // 2), lambda i: CAST(('0x' || substr(h, 2 * i + 1, 2)) AS BIGINT))), lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])), 4294967295) % {BUCKETS} AS bucket FROM hx, crc),
bc AS (SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM c JOIN bk USING (word) GROUP BY bucket),
tot AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM bc),
g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * (s_all + {BUCKETS})) / (CAST(s + 1 AS DOUBLE) * (t_all + {BUCKETS})))) AS BIGINT) AS gain FROM bc, tot),
f AS (SELECT id, sum(n) AS n, sum(n * gain) AS total FROM c JOIN bk USING (word) JOIN g USING (bucket) WHERE side = 's' GROUP BY id),
d AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(floor(CAST(total AS DOUBLE) / n), 0) AS BIGINT) AS weight, CAST(('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8)) AS BIGINT) AS h FROM documents LEFT JOIN f ON f.id = doc_id),
sc AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM sc WHERE n_features >= {LEAST_WORDS})
SELECT sc.doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * n // 100 THEN rank END AS rank FROM sc LEFT JOIN r USING (doc_id)
"""
