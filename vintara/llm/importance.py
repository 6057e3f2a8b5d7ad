"""Importance resampling towards a target distribution.

A text's features are its runs of 1 to 3 words, hashed into buckets. How much more often a bucket
occurs in the target texts than in the corpus is its gain; a document's weight is the sum of the
gains of its features, and its score the weight with Gumbel noise that its id fixes, so that the
highest scores are a sample without replacement.

Counting and scoring see one batch of texts as one array of bytes: the CRC of every word is worked
out a byte position at a time for all words together, and that of a run follows from those of its
words, since shifting a CRC by n bytes is linear. What leaves a counting task are its bucket sums.
Scores are written once. The cutoff is found by bisection: each job counts exactly how many written
scores fall into the parts of an interval and keeps the part in which the last drawn one lies, then
the same for the ids tied at that score. Only drawn rows are put in order, by range.

Odd rows: a null or empty text has no features and weight 0; a null id takes noise from the empty
string and comes before all others among ties; rows of one id are documents of their own, and of
rows alike at the cutoff as many are drawn as fit. Empty tables give no rows. Only the id and the
text are read, so other columns may have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.llm import common
from vintara.operators.joins import lookup_join
from vintara.session import settle

common.by_value(__name__)

BUCKETS = 10_000
#: Longest run of words that is a feature.
RUN = 3
#: Parts into which a job of the bisection cuts its interval.
PARTS = 256
#: Bytes of text taken at once, and the length from which words are hashed one by one.
SLICE, LONG = 1 << 22, 64


class Crc:
    """CRC-32 over many byte strings at once, and its shifts by whole bytes."""

    def __init__(self) -> None:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
        self.table = table
        # by[n][k][b]: byte b at place k of a register, n zero bytes later
        by = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
        for _ in range(LONG + 1):
            by.append(table[by[-1] & 255] ^ by[-1] >> 8)
        self.by = np.stack(by)
        # the same for 1, 2, 4, ... zero bytes
        self.powers = [self.by[1]]
        for _ in range(31):
            self.powers.append(self._moved(self.powers[-1], self.powers[-1]))

    @staticmethod
    def _moved(register: np.ndarray, places: np.ndarray) -> np.ndarray:
        return (places[0][register & 255] ^ places[1][register >> 8 & 255]
                ^ places[2][register >> 16 & 255] ^ places[3][register >> 24])

    def shift(self, register: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Registers after ``n`` zero bytes each."""
        far = np.flatnonzero(n > LONG)
        near = np.minimum(n, LONG)
        flat = self.by.reshape(-1)
        at = near * 1024
        out = (flat[at + (register & 255)] ^ flat[at + 256 + (register >> 8 & 255)]
               ^ flat[at + 512 + (register >> 16 & 255)] ^ flat[at + 768 + (register >> 24)])
        if len(far):
            moved, left = register[far], n[far]
            for k, places in enumerate(self.powers):
                odd = left >> k & 1 == 1
                moved[odd] = self._moved(moved[odd], places)
            out[far] = moved
        return out

    def words(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Registers, begun at zero, of the strings at ``start``."""
        register = np.zeros(len(start), np.uint32)
        left = np.flatnonzero(size <= LONG)
        for k in range(int(size[left].max(initial=0))):
            left = left[size[left] > k]
            now = register[left]
            register[left] = self.table[(now ^ data[start[left] + k]) & 255] ^ now >> 8
        for i in np.flatnonzero(size > LONG):
            register[i] = zlib.crc32(data[start[i]:start[i] + size[i]], 0xFFFFFFFF) ^ 0xFFFFFFFF
        return register

    def finished(self, register: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The CRC of strings of these registers and sizes."""
        ones = np.full(len(register), 0xFFFFFFFF, np.uint32)
        return register ^ self.shift(ones, size) ^ ones


def _lookups() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words (ASCII letters, digits, all of other characters); lower case."""
    byte = np.arange(256)
    letter = ((byte | 32) >= 97) & ((byte | 32) <= 122) & (byte < 128)
    lower = np.where(letter, byte | 32, byte).astype(np.uint8)
    return letter | (byte >= 128) | ((byte >= 48) & (byte <= 57)), lower


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets of features, the text each belongs to, and how many words a feature has.

    Texts are taken as one array of bytes, in slices that end between words; the last words of a
    slice are carried over, so that runs over its edge count.
    """
    in_word, lower = _lookups()
    crc = Crc()
    flat = texts.fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    at, end = (int(bounds[0]), int(bounds[-1])) if len(flat) else (0, 0)
    empty = np.zeros(0, np.int64)
    held = (np.zeros(0, np.uint32), empty, empty)
    while at < end:
        to = min(end, at + SLICE)
        while to < end and in_word[raw[to - 1]]:  # on to the end of the word
            gap = np.flatnonzero(~in_word[raw[to:min(end, to + SLICE)]])
            to = to + int(gap[0]) if len(gap) else min(end, to + SLICE)
            if len(gap):
                break
        data = lower[raw[at:to]]
        inside = in_word[data]
        inner = bounds[(bounds > at) & (bounds < to)] - at
        edge = np.empty(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[inner] = True
        edges = np.flatnonzero(edge)
        begin, size = edges[:-1], np.diff(edges)
        word = inside[begin]
        begin, size = begin[word], size[word]
        register = crc.words(data, begin, size)
        text = np.searchsorted(bounds, begin + at, side="right") - 1
        fresh = len(held[0])
        register, size, text = (np.concatenate(p) for p in zip(held, (register, size, text)))
        run, long = register, size
        space = crc.words(np.array([32], np.uint8), np.zeros(1, np.int64), np.ones(1, np.int64))
        spaced = register ^ crc.shift(np.repeat(space, len(size)), size)  # a blank, then the word
        for n in range(1, RUN + 1):
            if n > 1:
                run = crc.shift(run[:-1], size[n - 1:] + 1) ^ spaced[n - 1:]
                long = long[:-1] + 1 + size[n - 1:]
            same = text[n - 1:] == text[:len(text) - n + 1]
            same[:max(0, fresh - n + 1)] = False  # counted with the slice before
            some = np.flatnonzero(same)
            yield crc.finished(run[some], long[some]) % BUCKETS, text[some], n
            if len(run) < 2:
                break
        held = tuple(a[max(0, len(a) - RUN + 1):] for a in (register, size, text))
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for bucket, _, _ in features(batch.column(0)):
            total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket.

    A task sends on its sums only, and the driver gets one number per bucket.
    """
    parts = common.tuned(texts).select(text).mapInArrow(_count, "bucket int, n long")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed frequencies, rounded down."""
    corpus, target = corpus.astype(float), target.astype(float)
    ratio = (target + 1) * (corpus.sum() + BUCKETS) / ((corpus + 1) * (target.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of each row."""
    by_bucket = gains.astype(float)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            for bucket, row, length in features(batch.column(1)):
                each = np.bincount(row, minlength=n)
                words += each if length == 1 else 0
                count += each
                weight += np.bincount(row, by_bucket[bucket], n)  # whole numbers below 2^53
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, count, weight.astype(np.int64)))],
                ["doc_id", "n_words", "n_features", "weight"])

    rows = common.tuned(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = 42) -> Column:
    """Thousandths of Gumbel noise that the id fixes, rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((drawn + 0.5) / F.lit(4294967296.0))))


def _narrowed(rows: DataFrame, value: Column, nth: int) -> tuple[int, int]:
    """The ``nth`` smallest value, counted from 1, and how many rows have a smaller one."""
    wide = value.cast("decimal(20,0)")
    low, high = rows.agg(F.min(value), F.max(value)).first()
    before = 0
    while low < high:
        width = -(-(high - low + 1) // PARTS)
        part = F.floor((wide - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("int")
        counts = dict(rows.where(value.between(low, high)).groupBy(part.alias("part")).count().collect())
        for p in sorted(counts):
            if before + counts[p] >= nth:
                break
            before += counts[p]
        low, high = low + p * width, min(high, low + (p + 1) * width - 1)
    return low, before


def cutoff(scored: DataFrame, draws: int) -> tuple[int, int]:
    """Score and id of the last of ``draws`` rows, higher scores and smaller ids first."""
    last, before = _narrowed(scored, -F.col("score"), draws)
    tied = scored.where(F.col("score") == -last)
    return -last, _narrowed(tied, F.col("_id"), draws - before)[0]


def ranked(drawn: DataFrame) -> DataFrame:
    """The rows with their ``rank`` from 1 on: ranges of scores are sorted side by side, and the
    sizes of the ranges before one are added to the places within it."""
    order = [F.desc("score"), F.asc("_id")]
    placed = settle(drawn.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_place", F.monotonically_increasing_id())
                    .withColumn("_range", F.shiftright("_place", 33)))
    sizes = sorted(placed.groupBy("_range").count().collect())  # a row per range
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    starts = drawn.sparkSession.createDataFrame(starts, "_range long, _start long")
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return lookup_join(placed, starts, ["_range"], "inner").withColumn("rank", F.col("_start") + place + 1).drop(
        "_range", "_start", "_place")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score``, and its ``rank`` if it is drawn.

    Drawn are ``percent`` of the documents with at least ``min_words`` words, rounded down.
    """
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    scored = weighed(docs, gains, doc_id, text).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = settle(scored).withColumn("_id", F.coalesce("doc_id", F.lit(-2**63)))
    fit = scored.where(F.col("n_words") >= min_words)
    draws = percent * fit.count() // 100
    if not draws:
        return scored.drop("_id").withColumn("rank", F.lit(None).cast("long"))
    score, last = cutoff(fit, draws)
    chosen = (F.col("n_words") >= min_words) & (
        (F.col("score") > score) | ((F.col("score") == score) & (F.col("_id") <= last)))
    drawn = ranked(scored.where(chosen)).withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("_id")
