"""Importance resampling towards a target corpus, over hashed n-grams of whole texts."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.arrays import LOWER, arrow_schema, flat, slices
from ledgerline.llm.store import stored

#: Words after A-Z are lower-cased; every byte of a character beyond ASCII belongs to one.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: An ASCII byte that no word has: it ends the words of one text before those of the next.
_SENTINEL = b"\n"
#: Longer words are joined bit by bit of their length, not by one table lookup.
_SHORT = 64


@dataclass(frozen=True)
class Resampling:
    """width: longest run of words that is a feature; buckets: of the hashed features; least_words: documents with fewer are never
    drawn; percent: of the others that are drawn, rounded down; seed: of the draw."""

    width: int = 3
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 5
    seed: int = 42


def _times_x(crc: np.ndarray) -> np.ndarray:
    """A CRC-32 remainder after one more zero bit."""
    return (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))


def _zeros() -> list[np.ndarray]:
    """[k][b][v]: the remainder of byte value v at byte b of a CRC, after 2**k zero bytes."""
    one = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    for _ in range(8):
        one = _times_x(one)
    steps = [one]
    for _ in range(40):
        steps.append(_through(steps[-1], steps[-1]))
    return steps


def _through(step: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = step[0][crc & np.uint32(255)]
    for b in (1, 2, 3):
        out = out ^ step[b][(crc >> np.uint32(8 * b)) & np.uint32(255)]
    return out


class Crc:
    """CRC-32 of joined byte strings from the CRCs of their parts: crc(a + b) = crc(a) after len(b) zero bytes, xor crc(b)."""

    def __init__(self):
        self.steps = _zeros()
        same = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        short = [same]
        for _ in range(1, _SHORT):
            short.append(_through(self.steps[0], short[-1]))
        self.short = np.stack(short)

    def joined(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """CRCs of a's strings followed by b's, which have `size` bytes."""
        n = np.minimum(size, _SHORT - 1)
        out = np.zeros(len(a), np.uint32)
        for k in range(4):
            out ^= self.short[n, k, (a >> np.uint32(8 * k)) & np.uint32(255)]
        far = np.flatnonzero(size >= _SHORT)
        if len(far):
            crc, left = a[far], size[far].copy()
            for k, step in enumerate(self.steps):
                odd = (left >> k) & 1 == 1
                if odd.any():
                    crc[odd] = _through(step, crc[odd])
            out[far] = crc
        return out ^ b


_crc: list[Crc] = []


def features(texts: pa.Array, p: Resampling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every feature of the texts, and the number of words of each text.

    The texts are joined with sentinels, one pass of the pattern finds all words, and the offsets of the texts tell, by binary
    search, which text a word is of; runs of words that begin in one text and end in another are masked.
    """
    if not _crc:
        _crc.append(Crc())
    data, bounds = flat(texts)
    n = len(bounds) - 1
    apart = LOWER[np.insert(data, bounds[1:], _SENTINEL[0])].tobytes()
    offsets = bounds[:-1] + np.arange(n)
    cuts = np.fromiter(chain.from_iterable(m.span() for m in _WORD.finditer(apart)), np.int64)
    starts = cuts[::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    both = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(apart)])  # words and gaps
    known = both.take(pa.array(np.arange(0, len(cuts) - 1, 2))).dictionary_encode()
    at, distinct = known.indices.to_numpy(), known.dictionary.to_pylist()
    own = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct))[at]
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in distinct), np.uint32, len(distinct))[at]
    size = np.fromiter(map(len, distinct), np.int64, len(distinct))[at] + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    crc, buckets, texts_of = own, [own % np.uint32(p.buckets)], [text]
    for k in range(1, p.width):
        if k >= len(own):
            break
        crc = _crc[0].joined(crc[:-1], spaced[k:], size[k:])
        whole = text[k:] == text[:-k]
        buckets.append((crc % np.uint32(p.buckets))[whole])
        texts_of.append(text[k:][whole])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(texts_of), np.bincount(text, minlength=n)


def feature_counts(docs: DataFrame, text: str, p: Resampling) -> np.ndarray:
    """How many features of all texts fall into each bucket. Tasks add up their own counts; buckets rows come to the driver."""
    kinds = arrow_schema("bucket int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.buckets, np.int64)
        for part in slices(batches, "text"):
            total += np.bincount(features(part.column(0), p)[0], minlength=p.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=kinds)

    counts = np.zeros(p.buckets, np.int64)
    each = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of each bucket's smoothed shares in target and source, rounded down."""
    s, t, size = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [math.floor(1000 * math.log(((int(b) + 1) * (s + size)) / ((int(a) + 1) * (t + size)))) for a, b in zip(source, target, strict=True)], np.int64
    )


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", p: Resampling = Resampling()) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every row of docs.

    weight is the sum of the gains of a text's features; score adds Gumbel noise that is a function of seed and key, so that the
    highest scores are a draw without replacement by weight. rank is 1, 2, 3... for the drawn rows in order of score, then key,
    and null for the others. The order is by ranges of the score: each range is sorted in its own task and numbered after the
    counts of the ranges before. Rows that tie in score and key are told apart by where they are stored, so that a repeated
    key spreads over ranges too.

    A null text has no features and weight 0; null keys draw as the key "null"; without rows, or without target texts, the
    same formulas hold with counts of 0. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    gain = gains(feature_counts(docs, text, p), feature_counts(target, text, p))
    schema = "key string, n_words long, n_features long, weight long"
    kinds = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            bucket, of, words = features(part.column("text"), p)
            n = np.bincount(of, minlength=part.num_rows)
            # sums stay far below 2**53, so that doubles are exact
            weight = np.bincount(of, gain[bucket].astype(np.float64), minlength=part.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(words), pa.array(n), pa.array(weight)], schema=kinds)

    kind = docs.schema[key].dataType
    weighed = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    name = F.concat(F.lit(f"{p.seed}:"), F.coalesce("key", F.lit("null")))
    draw = (F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(draw)))
    scored = stored(weighed.withColumn("score", score).withColumn("key", F.col("key").cast(kind)).withColumn("row", F.monotonically_increasing_id()), "scores")

    able = scored.where(F.col("n_words") >= p.least_words)
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]
    ranged = able.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "ranges")  # partition << 33 and the place in it
    numbered = numbered.withColumn("part", F.shiftright("at", 33))
    counts = numbered.groupBy("part").agg(F.count("*").alias("n"))
    starts = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))  # a row a range
    drawn = scored.where(F.col("n_words") >= p.least_words).count() * p.percent // 100
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    out = numbered.join(F.broadcast(starts), "part").withColumn("rank", F.when(place <= drawn, place))
    rest = scored.where(F.col("n_words") < p.least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["key", "n_words", "n_features", "weight", "score", "rank"]
    return out.select(*columns).unionByName(rest.select(*columns))
