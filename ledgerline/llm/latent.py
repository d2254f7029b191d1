"""Benchmark decontamination: latent semantic retrieval of passages, then alignment and answer checks."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import LOWER, arrow_schema, flat, hash64, mapped, slices, words
from ledgerline.llm.store import stored

#: Vectors of one word that are added at a time; sums of them that a task holds at a time, about; bytes of codes that it reads at a time.
PIECE, HELD_SUMS, CODE_BYTES = 8, 1 << 13, 2 << 20
#: Lines of a matrix that go through a shuffle as one value.
LINES = 16


@dataclass(frozen=True)
class Latent:
    """features: hashed words. rank and extra: latent dimensions and oversampling; seed: of the random projection. whole: words in
    a passage of the matrix, passages side by side. passage and stride: words in a searched passage and between the beginnings
    of two. step: words between an item's query passages, which reach from its first word to its last, since a copy may lack
    any part of the item. nearest: cosine from which a passage is a candidate. shared: share of a candidate
    passage's words that must be the item's, in any order. overlap: share of an item's words that a common subsequence must
    have; overlap_with_answer: the same where the answer, the item's last answer_words words, is there as well. short: items
    with fewer words must be there in full. Items of fewer than passage + stride - 1 words need not hold a whole searched passage, and are looked up
    by words that no copy can lack. block: items that one pass over the documents searches for."""

    features: int = 1 << 14
    rank: int = 128
    extra: int = 8
    seed: int = 5
    whole: int = 24
    passage: int = 16
    stride: int = 8
    step: int = 2
    nearest: float = 0.55
    shared: float = 0.6
    overlap: float = 0.8
    overlap_with_answer: float = 0.6
    answer_words: int = 5
    short: int = 8
    block: int = 1000


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of whole texts, A-Z lower-cased, and the bounds of each text's."""
    data, bounds = flat(texts)
    data = LOWER[data]
    starts, ends, of = words(data, bounds)
    return hash64(data, starts, ends), of


def features_of(value: np.ndarray, p: Latent) -> np.ndarray:
    return (value >> np.uint64(32)).astype(np.uint32) % np.uint32(p.features)


def coded(rows: DataFrame, key: str, text: str, p: Latent) -> DataFrame:
    """(key, codes): the hashed lower-cased words of each whole text as little-endian 16-bit integers."""
    kind = dict(rows.dtypes)[key]

    def run(part):
        value, of = hashed(part.column("text"))
        code = features_of(value, p)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(of) - 1, [None, pa.py_buffer(2 * of.astype(np.int64)), pa.py_buffer(code.astype("<u2"))])
        return {"key": part.column("key"), "codes": raw.cast(pa.binary())}

    named = [F.col(key).alias("key"), F.col(text).cast("string").alias("text")]
    return mapped(rows, named, run, f"key {kind}, codes binary")


def _read(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a slice, and the bounds of each row."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    code = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view("<u2") if data is not None else np.zeros(0, "<u2")
    return code.astype(np.int64), (at - at[0]) // 2


def passages(of: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of all passages: every `stride` words, and one that ends with the text, so that no word is left out;
    a shorter text is one passage."""
    n = np.diff(of)
    count = np.where(n > width, -(-(n - width) // stride) + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = of[:-1][doc] + np.minimum(turn * stride, np.maximum(n[doc] - width, 0))
    return begin, np.minimum(begin + width, of[1:][doc]), doc


def document_frequencies(codes: DataFrame, p: Latent) -> tuple[np.ndarray, int]:
    """In how many passages (side by side, of p.whole words) each feature is, and how many passages there are."""

    def run(batches):
        total, count = np.zeros(p.features, np.int64), 0
        for part in slices(batches, "codes", CODE_BYTES):
            code, of = _read(part.column("codes"))
            begin, _, _ = passages(of, p.whole, p.whole)
            total += np.bincount(_once(code, begin, p.whole), minlength=p.features)
            count += len(begin)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"feature": np.append(used, -1), "n": np.append(total[used], count)})

    rows = codes.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # features + 1
    out = np.zeros(p.features, np.int64)
    for r in rows:
        if r[0] >= 0:
            out[r[0]] = r[1]
    return out, sum(r[1] for r in rows if r[0] == -1)


def _once(code: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """Each code of each passage once, where a passage ends with the next one's beginning; no passage is longer than width. The
    words of many passages are sorted as the lines of one table."""
    out, end = [np.zeros(0, np.int64)], np.append(begin[1:], len(code))
    for lo in range(0, len(begin), 1 << 14):
        a, b = begin[lo : lo + (1 << 14)], end[lo : lo + (1 << 14)]
        place = a[:, None] + np.arange(width)
        lines = np.where(place < b[:, None], code[np.minimum(place, len(code) - 1)], -1).astype(np.int32)
        lines.sort(axis=1)
        new = lines >= 0
        new[:, 1:] &= lines[:, 1:] != lines[:, :-1]
        out.append(lines[new])
    return np.concatenate(out)


def _vectors(code: np.ndarray, begin: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of table rows over short ranges of codes."""
    out = np.zeros((len(begin), table.shape[1]), table.dtype)
    for lo in range(0, len(begin), 512):
        a, b, total = begin[lo : lo + 512], end[lo : lo + 512], out[lo : lo + 512]
        rows = np.empty_like(total)
        for k in range(int((b - a).max())):
            live = a + k < b
            if live.all():
                np.take(table, code[a + k], axis=0, out=rows, mode="clip")
                total += rows
            else:
                total[live] += table[code[a[live] + k]]
    return out


def right_factors(codes: DataFrame, weight: np.ndarray, p: Latent) -> np.ndarray:
    """The leading right singular vectors (features x rank) of the TF-IDF matrix A of all passages, by a randomised SVD, each
    divided by its singular value, so that no direction of common words outweighs the others.

    One pass gives A'(A G) for a random G, whose orthonormal basis Q holds the leading directions; a second pass gives the
    small matrix (A Q)'(A Q), whose eigenvectors turn Q. Each task adds up its passages; the sums meet by feature, and only
    features x (rank + extra) numbers reach the driver, whatever the number of documents.
    """
    width = p.rank + p.extra
    start = np.random.default_rng(p.seed).standard_normal((p.features, width)).astype(np.float32)
    q, _ = np.linalg.qr(_gathered(codes, weight[:, None] * start, weight, p))
    del start
    small = _gathered(codes, (weight[:, None] * q).astype(np.float32), None, p)
    value, turn = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-value)[: p.rank]
    top = top[value[top] > 1e-9 * max(value.max(), 1e-30)]
    return (q @ turn[:, top] / np.sqrt(value[top])).astype(np.float32)


def _gathered(codes: DataFrame, table: np.ndarray, weight: np.ndarray | None, p: Latent) -> np.ndarray:
    """A'(A X) for table = weight * X; or, without weights, (A X)'(A X)."""
    shared = codes.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table, np.float32))  # features x (rank + extra)
    lines = p.features if weight is not None else table.shape[1]

    def run(batches):
        table = shared.value
        total = np.zeros((lines, table.shape[1]), np.float32)
        for part in slices(batches, "codes", CODE_BYTES):
            code, of = _read(part.column("codes"))
            begin, end, _ = passages(of, p.whole, p.whole)
            if not len(begin):
                continue
            if weight is None:
                mapped_to = _vectors(code, begin, end, table)
                total += mapped_to.T @ mapped_to
                continue
            mapped_to = _vectors(code, np.append(begin, 0), np.append(end, 0), table)  # a line of zeros at the end
            # each word adds its passage's vector; the last passage of a text may overlap the one before
            size = end - begin
            word = code[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())]
            owner = np.repeat(np.arange(len(begin)), size)
            order = np.argsort(word.astype(np.uint16), kind="stable")
            word, owner = word[order], owner[order]
            cut = np.flatnonzero(np.concatenate(([True], np.diff(word) > 0)))
            run = np.diff(np.append(cut, len(word)))
            pieces = -(-run // PIECE)
            first = np.cumsum(pieces) - pieces
            # every piece has PIECE lines: those that a word's last piece lacks are the line of zeros
            adds = np.full(PIECE * int(pieces.sum()), len(begin))
            adds[np.arange(len(word)) + np.repeat(PIECE * first - cut, run)] = owner
            _add(total, word[cut], first, adds, mapped_to)
        total = np.pad(total, ((0, -lines % LINES), (0, 0))).reshape(-1, LINES * table.shape[1])
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([x.tobytes() for x in total[used]], pa.binary())], names=["part", "numbers"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, numbers in zip(batch.column("part").to_pylist(), batch.column("numbers"), strict=True):
                own = np.frombuffer(numbers.as_buffer(), np.float32)
                sums[part] = sums[part] + own if part in sums else own.astype(float)
        yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "numbers"])

    parts = codes.mapInArrow(run, "part long, numbers binary").repartition("part").mapInArrow(add, "part long, numbers binary")
    out = np.zeros((-(-lines // LINES), LINES, table.shape[1]))
    for r in parts.collect():  # features x (rank + extra) numbers, as bytes
        out[r[0]] = np.frombuffer(r[1]).reshape(LINES, -1)
    out = out.reshape(-1, table.shape[1])[:lines]
    if weight is not None:
        out *= weight[:, None]
    return out


def _add(total: np.ndarray, word: np.ndarray, first: np.ndarray, adds: np.ndarray, lines: np.ndarray) -> None:
    """Add to each word's line of total the lines that its pieces name; first: the first piece of each word. Some words at a
    time, so that the sums of all pieces of a slice are never held at once."""
    ends = np.append(first[1:], len(adds) // PIECE)
    lo = 0
    while lo < len(word):
        hi = max(lo + 1, int(np.searchsorted(ends, first[lo] + HELD_SUMS, side="right")))
        a = PIECE * np.arange(first[lo], ends[hi - 1])
        total[word[lo:hi]] += np.add.reduceat(_vectors(adds, a, a + PIECE, lines), first[lo:hi] - first[lo], axis=0)
        lo = hi


@dataclass(frozen=True)
class Anchors:
    """Words of short items, one of which any copy must have: (code, item, need) by code, with the number of the item's words
    that must then stand around it. width and owns: words and features of each item."""

    code: np.ndarray
    item: np.ndarray
    need: np.ndarray
    width: np.ndarray
    owns: np.ndarray

    @staticmethod
    def of(items: list[np.ndarray], count: np.ndarray, p: Latent) -> Anchors:
        """A copy that has `need` of m words lacks m - need at most, so it has one of the m - need + 1 rarest; a copy that needs
        fewer words has the whole answer."""
        found, owns = [], np.zeros((len(items), p.features), bool)
        for k, c in enumerate(items):
            owns[k, c] = True
            need = len(c) if len(c) < p.short else math.ceil(p.overlap * len(c))
            least = {int(x): need for x in c[np.argsort(count[c], kind="stable")][: len(c) - need + 1]}
            with_answer = math.ceil(p.overlap_with_answer * len(c))
            if len(c) >= p.short and with_answer < need:
                answer = c[-p.answer_words :]
                least[int(answer[np.argmin(count[answer])])] = with_answer
            found += [(x, k, n) for x, n in least.items()]
        code, item, need = np.array(sorted(found), np.int64).reshape(-1, 3).T
        return Anchors(code, item, need, np.array([len(c) for c in items], np.int64), owns)

    def stretches(self, code: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
        """(item, document, begin, end) around each anchor that has enough words of its item within twice the item's length."""
        features = self.owns.shape[1]
        first = np.searchsorted(self.code, np.arange(features + 1))
        place = np.flatnonzero((np.diff(first) > 0)[code])
        out = [np.zeros((4, 0), np.int64)]
        for lo in range(0, len(place), 1 << 14):
            at = place[lo : lo + (1 << 14)]
            n = first[code[at] + 1] - first[code[at]]
            pick = np.repeat(first[code[at]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            at, item, need = np.repeat(at, n), self.item[pick], self.need[pick]
            doc, room = np.searchsorted(of, at, side="right") - 1, self.width[item]
            a, b = np.maximum(at - 2 * room + 1, of[doc]), np.minimum(at + 2 * room, of[doc + 1])
            same = np.zeros(len(at), np.int64)
            for k in range(int((b - a).max())):
                same += (a + k < b) & self.owns[item, code[np.minimum(a + k, len(code) - 1)]]
            keep = same >= need
            a, b = np.maximum(at - room + 1, of[doc]), np.minimum(at + room, of[doc + 1])
            out.append(np.stack([item, doc, a, b])[:, keep])
        return tuple(np.concatenate(out, axis=1))


def found_items(texts: DataFrame, items: list[tuple[int, np.ndarray]], latent: np.ndarray, count: np.ndarray, p: Latent) -> DataFrame:
    """(key, item, overlap) of the stretches that pass the alignment and answer checks. items: hashes of each item's words. texts: (key, text).

    Candidates are passages with a cosine of at least p.nearest to a passage of an item, and surroundings of short items' anchors;
    neighbouring passages of one document that are near the same item are one stretch, and it is aligned where it is found, so that
    no text is shuffled. count: passages that have each feature."""
    value_of = [(i, v) for i, v in items if len(v)]
    goals = [v.tolist() for _, v in sorted(value_of, key=lambda x: len(x[1]) < p.passage + p.stride - 1)]  # short items last, as below
    items = [(i, features_of(v, p).astype(np.int64)) for i, v in value_of]
    short = [(i, c) for i, c in items if len(c) < p.passage + p.stride - 1]
    items = [(i, c) for i, c in items if len(c) >= p.passage + p.stride - 1]
    anchors = Anchors.of([c for _, c in short], count, p)
    goal, first = [], np.zeros(len(items), np.int64)
    owns = np.zeros((p.features, len(items)), np.min_scalar_type(p.passage))
    for k, (_, c) in enumerate(items):
        last = max(0, len(c) - p.passage)
        begin = np.append(np.arange(0, last, p.step), last)
        owns[c, k] = 1
        first[k] = sum(map(len, goal))
        goal.append(_vectors(c, begin, np.minimum(begin + p.passage, len(c)), latent))
    goal = np.concatenate(goal) if goal else np.zeros((0, latent.shape[1]), np.float32)
    goal /= np.maximum(np.linalg.norm(goal, axis=1, keepdims=True), 1e-9)
    number = np.array([i for i, _ in items + short], np.int64)
    shared = texts.sparkSession.sparkContext.broadcast((latent, goal, first, number, owns, anchors, goals))  # one block of items
    kind = dict(texts.dtypes)["key"]
    schema = f"key {kind}, item long, overlap double"
    kinds = arrow_schema(schema)

    def run(batches):
        latent, goal, first, number, owns, anchors, goals = shared.value
        for part in slices(batches, "text") if len(number) else ():
            value, of = hashed(part.column("text"))
            code = features_of(value, p).astype(np.int64)
            begin, end, doc = passages(of, p.passage, p.stride)
            item, of_item, from_, to = anchors.stretches(code, of)
            hits = [np.stack([item + len(first), of_item, from_, to])]
            for lo in range(0, len(begin) if len(first) else 0, 2048):
                a, b = begin[lo : lo + 2048], end[lo : lo + 2048]
                # words in common first: few passages have enough, and only these are projected
                held = _vectors(code, a, b, owns) >= np.ceil(p.shared * (b - a)).astype(owns.dtype)[:, None]
                some = np.flatnonzero(held.any(1))
                for at in range(0, len(some), 256):
                    r = some[at : at + 256]
                    own = _vectors(code, a[r], b[r], latent)
                    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
                    near = np.maximum.reduceat(own @ goal.T, first, axis=1) >= p.nearest
                    x, c = np.nonzero(held[r] & near)
                    r = r[x] + lo
                    hits.append(np.stack([c, doc[r], begin[r], end[r]]))
            hit = np.concatenate(hits, axis=1)
            c, owner, a, b = hit[:, np.lexsort((hit[2], hit[1], hit[0]))]
            head = np.ones(len(c), bool)
            head[1:] = (c[1:] != c[:-1]) | (owner[1:] != owner[:-1]) | (a[1:] > b[:-1])
            opens = np.flatnonzero(head)
            last = np.append(opens[1:], len(c)) - 1 if len(opens) else opens
            c, owner, a, b = c[opens], owner[opens], a[opens], b[last]
            share = np.array([overlap(goals[k], value[of[i] : of[i + 1]], x - of[i], y - of[i], p) for k, i, x, y in zip(c, owner, a, b, strict=True)], float)
            some = np.flatnonzero(share > 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(owner[some])), pa.array(number[c[some]], pa.int64()), pa.array(share[some])], schema=kinds
            )

    return texts.mapInArrow(run, schema)


def overlap(own: list[int], document: np.ndarray, begin: int, end: int, p: Latent) -> float:
    """The largest share of the item's words that a common subsequence has within a stretch of twice its length, with room around
    begin and end; 0 if none is enough."""
    room, best = len(own), 0.0
    there = document[max(0, begin - room) : end + room].tolist()
    for at in range(0, max(1, len(there) - room), room):
        near = there[at : at + 2 * room]
        length = common_subsequence(own, near)
        enough = length >= p.overlap * len(own)
        if len(own) < p.short:
            enough = length == len(own)
        elif not enough and length >= p.overlap_with_answer * len(own):
            answer = own[-p.answer_words :]
            enough = any(near[i : i + len(answer)] == answer for i in range(len(near) - len(answer) + 1))
        if enough:
            best = max(best, length / len(own))
    return best


def common_subsequence(a: list, b: Iterable) -> int:
    """Length of the longest common subsequence, a bit for each word of a."""
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", p: Latent = Latent()) -> DataFrame:
    """One row (key, items, overlap, contaminated) per input row: the benchmark items found in it, in order, and the largest share
    of an item's words in a common subsequence.

    Passages of all documents are compared with passages of the items in latent space, and short items are looked up by their
    words; a stretch that is near an item is aligned with the item's words (A-Z lower-cased), with room around it. An item is found if the common subsequence, within
    any stretch of twice the item's length, has p.overlap of its words, or p.overlap_with_answer and the answer as well. Every
    passage of every whole text is searched. Null or empty texts and items have no words and find nothing; a null key is never
    found; rows that repeat a key share their findings. Items are searched in blocks of p.block, a pass over the documents each,
    so what a task holds has a fixed bound. Empty tables give clean rows. Other columns are ignored.
    """
    codes = stored(coded(docs, key, text, p), "codes")
    known = stored(benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("item is not null"), "items")
    found = None
    count, n = document_frequencies(codes, p)
    if n and known.where("text is not null").head(1):
        weight = np.log((1 + n) / (1 + count)).astype(np.float32)
        latent = (weight[:, None] * right_factors(codes, weight, p)).astype(np.float32)
        parts = max(1, -(-known.count() // p.block))
        for k in range(parts):
            mine = known.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k)
            block = [(r[0], hashed(pa.array([r[1]], pa.string()))[0]) for r in mine.collect()]
            texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("key is not null")
            near = found_items(texts, block, latent, count, p)
            found = near if found is None else found.unionByName(near)
    if found is None:
        none = docs.select(F.col(key).alias("key"))
        return none.select(F.col("key").alias(key), F.array().cast("array<bigint>").alias("items"), F.lit(0.0).alias("overlap"), F.lit(False).alias("contaminated"))
    hits = stored(found, "aligned").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("overlap").alias("overlap"))
    rows = codes.select("key").join(stored(hits, "hits"), "key", "left")
    return rows.select(
        F.col("key").alias(key),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("overlap", F.lit(0.0)).alias("overlap"),
        F.col("items").isNotNull().alias("contaminated"),
    )

