"""Importance resampling against a plain count of every feature."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm.resampling import Crc, Resampling, features, gains, resampled

DOCS, TARGET = "doc_id long, text string, rank string, row int", "item_id long, text string"


def runs(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [" ".join(w[i : i + k]) for k in range(1, width + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, p):
    def bucket(f):
        return zlib.crc32(f.encode()) % p.buckets

    source, goal = Counter(), Counter()
    for _, t in docs:
        source.update(map(bucket, runs(t, p.width)[1]))
    for t in target:
        goal.update(map(bucket, runs(t, p.width)[1]))
    s, t = sum(source.values()), sum(goal.values())
    out = []
    for k, text in docs:
        w, f = runs(text, p.width)
        weight = sum(math.floor(1000 * math.log((goal[b] + 1) * (s + p.buckets) / ((source[b] + 1) * (t + p.buckets)))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"{p.seed}:{'null' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= p.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(able) * p.percent // 100
    return Counter(out), [r for r in able[:drawn]]


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choices(string.ascii_letters + "0123456789äßé中", k=rng.randint(1, 9))) for _ in range(60)]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", "\n", ", ", "\x00", "_", "...", "\x7f"]) for _ in range(n))

    docs = [(k, text(rng.choice([0, 1, 2, 3, 19, 20, 21, 60]))) for k in range(120)]
    docs += [(500, None), (501, ""), (502, " \n.-"), (503, "x" * 70_000 + " " + "y" * 63 + " " + "z" * 64 + " w"), (504, "Word " * 5000)]
    docs += [(None, text(30)), (600, docs[7][1]), (601, "É É é"), (602, "a b\x00c")]
    return docs, [text(40) for _ in range(9)] + [None, "", "alone"]


@pytest.mark.parametrize("p", [Resampling(), Resampling(width=2, buckets=97, least_words=3, percent=50, seed=7), Resampling(width=5, buckets=1)])
def test_matches_plain_counts(spark, p):
    docs, target = corpus()
    frame = spark.createDataFrame([(k, t, "r", 1) for k, t in docs], DOCS).repartition(5)
    rows = resampled(frame, spark.createDataFrame(list(enumerate(target)), TARGET), p=p).collect()
    want, drawn = plain(docs, target, p)
    assert Counter(tuple(r)[:5] for r in rows) == want
    assert [tuple(r)[:5] for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, len(drawn) + 1))


def test_empty_tables_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "r", 1)] * 40 + [(2, "a b d", "r", 1)], DOCS)
    target = spark.createDataFrame([(1, "a b c")], TARGET)
    p = Resampling(least_words=2, percent=50)
    rows = resampled(docs, target, p=p).collect()
    assert len(rows) == 41 and sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 21))
    assert resampled(docs.where("doc_id > 2"), target, p=p).count() == 0
    none = resampled(docs, target.where("item_id > 1"), p=p).where("key = 2").first()
    assert none["n_features"] == 6 and none["weight"] == plain([(1, "a b c")] * 40 + [(2, "a b d")], [], p)[0].popitem()[0][3]


def test_joined_crcs():
    rng, crc = random.Random(1), Crc()
    for size in (0, 1, 5, 63, 64, 65, 4096, 70_001):
        a, b = rng.randbytes(20), rng.randbytes(size)
        got = crc.joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([size]))
        assert got[0] == zlib.crc32(a + b)


def test_no_feature_spans_two_texts():
    p = Resampling()
    bucket, of, words = features(pa.array(["a", None, "b c", "", "d"]), p)
    assert words.tolist() == [1, 0, 2, 0, 1]
    assert Counter(zip(of.tolist(), bucket.tolist())) == Counter(
        (k, zlib.crc32(f) % p.buckets) for k, f in [(0, b"a"), (2, b"b"), (2, b"c"), (2, b"b c"), (4, b"d")]
    )


def test_target_texts_are_favoured(spark):
    rng = random.Random(9)
    common, rare = [f"c{k}" for k in range(200)], [f"r{k}" for k in range(200)]
    docs = [(k, " ".join(rng.choices(rare if k % 20 == 0 else common, k=40)), "r", 1) for k in range(400)]
    target = [(k, " ".join(rng.choices(rare, k=40))) for k in range(30)]
    drawn = resampled(spark.createDataFrame(docs, DOCS), spark.createDataFrame(target, TARGET)).where("rank is not null").collect()
    assert len(drawn) == 20 and sum(r["key"] % 20 == 0 for r in drawn) >= 18


def test_gains_go_down():
    assert gains(np.array([9, 0]), np.array([0, 0])).tolist() == [math.floor(1000 * math.log(11 / (10 * 2))), math.floor(1000 * math.log(11 / 2))]
