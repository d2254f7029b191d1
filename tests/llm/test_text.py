"""Tokens, shards, pieces and repeats against the libraries and brute force."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.arrays import mix
from ledgerline.llm.encoder import Encoder
from ledgerline.llm.pieces import decode_pieces, encode_sampled, lattice, sample
from ledgerline.llm.repair import RePair, Shard, pack, read_shards, write_shards
from ledgerline.llm.repeats import RepeatRules, measures, passing, quality_rules
from ledgerline.llm.store import scratch
from ledgerline.llm.tokens import TokenCache, count_tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n\n", "a <|endoftext|> b", "it's we'll\n The", "é d'r ÷ x", "▁ a\x00b", "中文 text 😀", " \x85a\xa0b  c"]


def texts(n, seed=1):
    rng = random.Random(seed)
    parts = [*"aZbé÷×Ãñ'sltd \n\t\r.,<|>09中😀́_", "<|endoftext|>", "'ll", "\n\n", "  ", "the "]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def frame(spark, rows):
    """doc_id, text and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, key int, digest string, kept string")


def test_chunks_encode_like_the_library():
    own, library = Encoder(JSON), Tokenizer.from_file(JSON)
    assert own.chunks
    many = texts(3000)
    ids, bounds = own.ids(pa.array(many))
    for k, want in enumerate(library.encode_batch(many, add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == want.ids


def test_token_counts_and_cache(spark):
    rows = [(k, t) for k, t in enumerate(texts(60))] + [(None, None), (3, "again"), (3, "again"), (None, "a"), (900, "a")]
    docs, cache = frame(spark, rows), TokenCache(spark, scratch(spark, "cache"))
    library = Tokenizer.from_file(JSON)
    want = sorted((str(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in rows)
    stored = set()
    for _ in range(2):  # the second time everything is known
        got = sorted((str(r[0]), r[1], r[2]) for r in count_tokens(docs, JSON, cache).collect())
        assert got == want
        found = spark.read.parquet(cache.folder).count()
        assert found == len({t or "" for _, t in rows})
        stored.add(found)
    assert len(stored) == 1
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = docs.where("doc_id between 10 and 20")
    assert {r[0]: r[2] for r in count_tokens(some, MODEL, cache).collect()} == {k: len(model.encode(rows[k][1])) for k in range(10, 21)}
    assert count_tokens(docs.limit(0), JSON, cache).count() == 0


def test_repair_round_trip():
    rng = np.random.default_rng(4)
    for size, kinds in ((0, 5), (1, 5), (4000, 3), (4000, 60)):
        ids = rng.integers(0, kinds, size).astype(np.int32)
        cut = np.sort(rng.integers(0, size + 1, 9))
        bounds = np.concatenate(([0], cut, [size]))
        shard = Shard(pack(np.arange(10), ids, bounds, 100, RePair(rounds=5, pairs=7, least=2, rules=30)))
        assert shard.expand(shard.symbols).tolist() == ids.tolist()
        for k in range(10):
            assert shard.document(k).tolist() == ids[bounds[k] : bounds[k + 1]].tolist()
    assert len(shard.symbols) < 4000


def test_shards_hold_all_documents(spark):
    rows = [(k * 7 % 50, t) for k, t in enumerate(texts(41))] + [(None, "none"), (5, None)]
    folder = scratch(spark, "shards")
    manifest = write_shards(frame(spark, rows), folder, JSON, 50257)
    got = read_shards(manifest, folder).orderBy("start").collect()
    library = Tokenizer.from_file(JSON)
    want, start = [], 0
    for k, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((k, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r["key"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    assert [r["key"] or -1 for r in got] == sorted(r["key"] or -1 for r in got)
    empty = scratch(spark, "shards")
    assert write_shards(frame(spark, rows).limit(0), empty, JSON, 50257).count() == 0


def test_sampled_pieces_are_lossless_and_reproducible(spark):
    rows = [(k, t) for k, t in enumerate(texts(200))] + [(None, None), (1, "x" * 5000)]
    docs = frame(spark, rows)
    encoded = encode_sampled(docs, MODEL)
    decoded = decode_pieces(encoded, MODEL, original="text")
    assert decoded.count() == len(rows) and decoded.where("not lossless").count() == 0
    again = encode_sampled(docs.repartition(7), MODEL)
    assert sorted(map(str, encoded.collect())) == sorted(map(str, again.collect()))
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(model.decode(r["ids"]) == r["text"] for r in encoded.where("size(ids) > 0").collect())
    assert encode_sampled(docs.limit(0), MODEL).count() == 0


def test_sampling_follows_the_lattice():
    own, n = lattice(MODEL, 0.5), 40_000
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    weight = {model.id_to_piece(int(i)): (int(i), w) for _, ids, ws in own.tables for i, w in zip(ids, ws, strict=True)}

    def ways(rest):
        if not rest:
            yield (), 1.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in weight:
                for ids, w in ways(rest[k:]):
                    yield (weight[rest[:k]][0], *ids), w * weight[rest[:k]][1]

    want = dict(ways("▁there"))
    ids, bounds = sample(pa.array(["there"] * n), mix(np.arange(n, dtype=np.uint64)), own)
    seen = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    assert set(seen) <= set(want)
    assert max(abs(seen[k] / n - w / sum(want.values())) for k, w in want.items()) < 0.01


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    w = WORD.findall(text)
    n, longest, cover, three = len(w), 0, set(), set()
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and w[i + k] == w[j + k]:
                k += 1
            if k >= least:
                cover.update(range(i, i + k))
                longest = max(longest, k)
    often = collections.Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    for i in range(n - 2):
        if often[tuple(w[i : i + 3])] > 1:
            three.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(three), len(cover), longest


def repeated(n):
    rng = random.Random(3)
    out = ["", "  \n", "a", "a b c " * 5, "x\n\nx\n x\nx"]
    for _ in range(n):
        some = rng.choice(["ab", "abc", "abcdefé#"])
        unit = [rng.choice(some) for _ in range(rng.randint(0, 12))]
        words = []
        while len(words) < rng.randint(0, 90):
            words += unit if rng.random() < 0.3 else [rng.choice(some) for _ in range(rng.randint(1, 9))]
        out.append("".join(x + rng.choice([" ", "  ", "\n", "\t"]) for x in words))
    return out


def test_measures_match_brute_force():
    many = repeated(250)
    for least in (2, 3, 8):
        m = measures(pa.array(many), RepeatRules(least=least))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
        assert list(zip(*[m[k].tolist() for k in names], strict=True)) == [brute(t, least) for t in many]


def test_quality_rules(spark):
    rng = random.Random(9)
    fresh = " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(200))
    twice = fresh + " " + fresh[: len(fresh) // 2]
    rows = [(1, fresh), (2, twice), (3, "too short"), (4, None), (4, None), (None, fresh), (5, "a b c " * 60)]
    got = quality_rules(frame(spark, rows))
    assert sorted((str(r["doc_id"]), r["base_failed"], r["kept"]) for r in got.collect()) == sorted(
        [("1", False, True), ("2", bool(100 * 200 > 50 * 300), False), ("3", True, False), ("4", True, False), ("4", True, False), ("None", False, True), ("5", True, False)]
    )
    kept = passing(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "None"]
    assert passing(frame(spark, rows).limit(0)).count() == 0
    assert got.select(F.sum("n_words")).first()[0] > 0
