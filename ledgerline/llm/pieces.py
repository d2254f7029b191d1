"""SentencePiece segmentations sampled from the piece lattice, and lossless decoding."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import arrow_schema, flat, hash64, mapped, mix

#: How SentencePiece writes a space inside a piece.
SPACE_MARK = "▁"

#: Ids that are decoded at a time, about; a longer row is decoded by itself.
DECODE_IDS = 1 << 19


@dataclass(frozen=True)
class Sampling:
    """alpha: 0 draws all segmentations alike, a large value always the most probable. seed: with the row key and the place in the
    text it fixes every draw, whatever the partitions."""

    alpha: float = 0.5
    seed: int = 17


_models: dict[tuple[str, float], Lattice] = {}


def lattice(path: str, alpha: float) -> Lattice:
    """One lattice per Python worker."""
    if (path, alpha) not in _models:
        _models[path, alpha] = Lattice(path, alpha)
    return _models[path, alpha]


class Lattice:
    """The pieces of a model with an identity normaliser and byte fallback, as hash tables by length in code points.

    A piece's weight is exp(alpha * score) for a unigram model. A BPE model has merge ranks instead of log-probabilities; there
    the weight is (1 / (rank + 3)) ** alpha, as piece frequencies fall about like that. A code point that is no piece, and the
    space mark itself where a text has it, has one way only: its UTF-8 bytes as byte pieces.
    """

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not proto.trainer_spec.byte_fallback:
            raise ValueError("lossless decoding needs an identity normaliser, a dummy prefix and byte fallback")
        ids = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        text = [model.id_to_piece(i) for i in ids]
        if any(SPACE_MARK in t.lstrip(SPACE_MARK) for t in text):
            raise ValueError("pieces that reach over a word's beginning are not supported")
        score = np.array([model.get_score(i) for i in ids])
        if proto.trainer_spec.model_type == 2:
            rank = np.empty(len(ids))
            rank[np.argsort(-score, kind="stable")] = np.arange(len(ids))
            score = -np.log(rank + 3)
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.surface = [model.id_to_piece(i).replace(SPACE_MARK, " ").encode() for i in range(len(model))]
        for b, i in enumerate(self.bytes):
            self.surface[i] = bytes([b])
        self.content = np.frombuffer(b"".join(self.surface), np.uint8)
        self.length = np.array([len(t) for t in self.surface], np.int64)
        self.place = np.cumsum(self.length) - self.length
        self.width = max(map(len, text))
        self.tables, self.nodes = [], []  # pieces; pieces and beginnings of longer ones
        for n in range(1, self.width + 1):
            own = {t: k for k, t in enumerate(text) if len(t) == n}
            begins = {t[:n] for t in text if len(t) > n}
            names = [*own, *sorted(begins - own.keys())]
            codes = np.array([[ord(c) for c in t] for t in names], np.uint64).reshape(len(names), n)
            value = np.zeros(len(names), np.uint64)
            for c in range(n):
                value = _roll(value, codes[:, c])
            at = list(own.values())
            number, weight = np.full(len(names), -1, np.int32), np.zeros(len(names))
            number[: len(at)], weight[: len(at)] = [ids[k] for k in at], np.exp(alpha * score[at])
            order = np.argsort(value[: len(at)])
            self.tables.append((value[: len(at)][order], number[: len(at)][order], weight[: len(at)][order]))
            order = np.argsort(value)
            self.nodes.append((value[order], number[order], weight[order], np.array([t in begins for t in names], bool)[order]))

    def spelt(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts that lists of ids spell, without the dummy space. Raises on bytes that are not UTF-8."""
        size = self.length[ids]
        end = np.concatenate(([0], np.cumsum(size)))
        content = self.content[np.repeat(self.place[ids] - end[:-1], size) + np.arange(end[-1])]
        at, filled = end[bounds], np.diff(bounds) > 0
        stay = np.ones(len(content), bool)
        stay[at[:-1][filled]] = False
        at = at - np.concatenate(([0], np.cumsum(filled)))
        return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(content[stay])]).cast(pa.large_string())

    def find(self, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids (-1: none) and weights of strings of n code points, by hash, and whether longer pieces begin so."""
        known, ids, weight, begins = self.nodes[n - 1]
        if not len(known):
            return np.full(len(value), -1, np.int32), np.zeros(len(value)), np.zeros(len(value), bool)
        at = np.minimum(np.searchsorted(known, value), len(known) - 1)
        hit = known[at] == value
        return np.where(hit, ids[at], -1), np.where(hit, weight[at], 0.0), hit & begins[at]


def _roll(value: np.ndarray, code: np.ndarray) -> np.ndarray:
    return mix(value * np.uint64(0x2545F4914F6CDD1D) + code.astype(np.uint64) + np.uint64(1))


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    b = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32)
    one, two, three, four = (b[at + k] for k in range(4))
    low = np.uint32(0x3F)
    code = np.where(
        one < 0x80,
        one,
        np.where(
            one < 0xE0,
            (one & 0x1F) << 6 | two & low,
            np.where(one < 0xF0, (one & 0x0F) << 12 | (two & low) << 6 | three & low, (one & 0x07) << 18 | (two & low) << 12 | (three & low) << 6 | four & low),
        ),
    )
    return code, at


def sample(texts: pa.Array, seeds: np.ndarray, model: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all texts and the bounds of each text; an empty text has none.

    A text gets the dummy space, and spaces become marks. No piece reaches over the beginning of a word (marks, then other
    code points), so the lattice splits there without changing the distribution. Forward filtering runs once for each
    distinct word, backward sampling for each word of the texts; both step over all words of the slice at a time.
    """
    # the marked texts as code points; a literal mark is kept apart as 0x110000, which is no piece
    data, bounds = flat(texts)
    code, at = _points(data)
    first = np.searchsorted(at, bounds)
    full = np.diff(bounds) > 0
    mark = np.uint32(ord(SPACE_MARK))
    code = np.where(code == mark, np.uint32(0x110000), np.where(code == 32, mark, code))
    code = np.insert(code, first[:-1][full], mark)
    first = first + np.concatenate(([0], np.cumsum(full)))
    n = len(code)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    is_mark = code == mark
    start = is_mark.copy()
    start[1:] &= ~is_mark[:-1]
    start[first[:-1][full]] = True
    word = np.flatnonzero(start)
    word_end = np.append(word[1:], n)
    # distinct words
    kind, one = _distinct(code, word, word_end)
    length = (word_end - word)[one]
    pool = np.concatenate(([0], np.cumsum(length)))
    points = code[np.repeat(word[one] - pool[:-1], length) + np.arange(pool[-1])]
    ends = np.repeat(pool[1:], length)
    total = len(points)
    # all edges of the lattice, by the position that they end at, then by width; a string that begins no piece is followed no more
    found = []
    least = model.tables[0][2].min() if len(model.tables[0][2]) else 1.0
    live, value = np.arange(total), np.zeros(total, np.uint64)
    for w in range(1, model.width + 1):
        value = _roll(value, points[live + w - 1])
        piece, weight, begins = model.find(value, w)
        if w == 1:  # no piece: byte pieces, one way
            found.append((live, piece, np.where(piece < 0, least, weight)))
        else:
            hit = np.flatnonzero(piece >= 0)
            found.append((live[hit] + w - 1, piece[hit], weight[hit]))
        on = np.flatnonzero(begins & (live + w < ends[live]))
        live, value = live[on], value[on]
        if not len(live):
            break
    count = np.ones(total, np.int64)
    for end, _, _ in found[1:]:
        count[end] += 1
    first_edge = np.cumsum(count) - count
    edges = int(count.sum())
    ids, width_of, log_weight = np.empty(edges, np.int32), np.empty(edges, np.int32), np.empty(edges)
    free = first_edge.copy()
    for w, (end, piece, weight) in enumerate(found, 1):
        at = free[end]
        ids[at], width_of[at], log_weight[at] = piece, w, np.log(weight)
        free[end] += 1
    del found, free
    # forward filtering: scaled sums of the weights of all ways to each position
    place = np.arange(total) - np.repeat(pool[:-1], length)
    by_place = np.lexsort((-count, place))  # positions with many edges first: those with more than k are a beginning
    edge = np.searchsorted(place[by_place], np.arange(place.max() + 2))
    into = np.empty(edges)
    log_alpha = np.zeros(total)
    for step in range(len(edge) - 1):
        here = by_place[edge[step] : edge[step + 1]]
        own = first_edge[here]
        more = np.searchsorted(-count[here], -np.arange(count[here[0]]), side="left")  # how many have more than k edges
        scores = []
        for k, m in enumerate(more.tolist()):
            at = own[:m] + k
            w = width_of[at]
            score = log_weight[at] + np.where(w <= step, log_alpha[here[:m] - w], 0.0)
            if k:
                top[:m] = np.maximum(top[:m], score)
            else:
                top = score.copy()
            scores.append(score)
        running = np.zeros(len(here))
        for k, score in enumerate(scores):
            m = len(score)
            running[:m] += np.exp(score - top[:m])
            into[own[:m] + k] = running[:m]
        log_alpha[here] = top + np.log(running)  # logarithms: long words neither overflow nor vanish
        for k, score in enumerate(scores):
            m = len(score)
            into[own[:m] + k] /= running[:m]
    # backward sampling for every word of the texts
    last = pool[1:][kind] - 1
    begin = pool[:-1][kind]
    doc = np.searchsorted(first, word, side="right") - 1
    key = mix(seeds[doc] + (word - first[doc]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    live, where = np.arange(len(word)), last.copy()
    steps = []
    turn = 0
    while len(live):
        draw = mix(key[live] + np.uint64((turn + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        u = (draw >> np.uint64(11)) * (1.0 / (1 << 53))
        drawn = first_edge[where]
        open_ = np.flatnonzero(u >= into[drawn])
        while len(open_):  # the last edge of a position has 1
            drawn[open_] += 1
            open_ = open_[u[open_] >= into[drawn[open_]]]
        steps.append((live, where, drawn))
        where = where - width_of[drawn]
        more = where >= begin[live]
        live, where = live[more], where[more]
        turn += 1
    owner = np.concatenate([s[0] for s in steps])
    where = np.concatenate([s[1] for s in steps])
    drawn = np.concatenate([s[2] for s in steps])
    order = np.argsort(word[owner] + where - begin[owner], kind="stable")
    owner, where, drawn = owner[order], where[order], drawn[order]
    return _with_bytes(ids[drawn], points[where], doc[owner], model, len(bounds) - 1)


def _distinct(code: np.ndarray, word: np.ndarray, word_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each word's distinct form, and one word of each form; words are compared exactly."""
    raw = pa.Array.from_buffers(
        pa.large_binary(), len(word), [None, pa.py_buffer(np.append(word, word_end[-1]) * 4), pa.py_buffer(code.astype(np.uint32))]
    ).dictionary_encode()
    kind = raw.indices.to_numpy().astype(np.int64)
    one = np.zeros(len(raw.dictionary), np.int64)
    one[kind[::-1]] = np.arange(len(kind))[::-1]
    return kind, one


def _with_bytes(out: np.ndarray, point: np.ndarray, doc: np.ndarray, model: Lattice, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Replace the code points without a piece (-1) by their byte pieces."""
    bare = np.flatnonzero(out < 0)
    size = np.ones(len(out), np.int64)
    raw = [(SPACE_MARK if p == 0x110000 else chr(p)).encode() for p in point[bare].tolist()]
    size[bare] = [len(r) for r in raw]
    end = np.cumsum(size)
    ids = np.repeat(out, size)
    if len(bare):
        value = np.frombuffer(b"".join(raw), np.uint8)
        own = size[bare]
        ids[np.repeat(end[bare] - own - np.cumsum(own) + own, own) + np.arange(own.sum())] = model.bytes[value]
    count = np.bincount(doc, weights=size, minlength=docs).astype(np.int64) if len(doc) else np.zeros(docs, np.int64)
    return ids, np.concatenate(([0], np.cumsum(count)))


def encode_sampled(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", p: Sampling = Sampling()) -> DataFrame:
    """One row (key, text, ids) per input row: a segmentation drawn by forward filtering and backward sampling.

    The draws depend on the seed, the row key and the place in the text only. A null or empty text has no ids; a null key draws
    like key 0; rows that repeat key and text get the same ids. Whole texts are encoded; words of any length. There is no
    shuffle. Other columns are ignored.
    """
    kind = dict(docs.dtypes)[key]
    named = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.coalesce(F.col(key).cast("string"), F.lit("0")).alias("name"))

    def run(part):
        name, edges = flat(part.column("name"))
        seeds = hash64(name, edges[:-1], edges[1:]) + np.uint64(p.seed)
        ids, bounds = sample(part.column("text"), seeds, lattice(model_path, p.alpha))
        return {"key": part.column("key"), "text": part.column("text"), "ids": pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids, pa.int32()))}

    found = mapped(named, ["key", "text", "name"], run, f"key {kind}, text string, ids array<int>", limit=1 << 20)
    return found.select(F.col("key").alias(key), F.col("text").alias(text), "ids")


def decode_pieces(rows: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids", original: str | None = None) -> DataFrame:
    """One row (key, decoded, n_pieces, ids_crc32) per input row: the text that the ids spell, without the dummy space; a null list
    decodes to the empty text. ids_crc32 is of the ids as little-endian unsigned 32-bit integers. With `original`, a column of
    texts: whether the decoded text equals it (a null: empty), as `lossless`. Raises on bytes that are not UTF-8."""
    kind = dict(rows.dtypes)[key]
    schema = f"key {kind}, decoded string, n_pieces long, ids_crc32 long, same boolean, ids array<int>"
    kinds = arrow_schema(schema)
    text = F.coalesce(F.col(original).cast("string"), F.lit("")) if original else F.lit("")

    def run(batches):
        model = lattice(model_path, 0.0)
        for whole in batches:
            sizes = pa.compute.fill_null(pa.compute.list_value_length(whole.column("ids")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            total, start = np.cumsum(sizes), 0
            while start < whole.num_rows:
                end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + DECODE_IDS, side="right")))
                batch, size = whole.slice(start, end - start), sizes[start:end]
                own, start = batch.column("ids"), end
                bounds = np.concatenate(([0], np.cumsum(size)))
                flat_ids = own.flatten().to_numpy(zero_copy_only=False).astype("<u4")
                raw = flat_ids.tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                decoded = model.spelt(flat_ids, bounds).cast(pa.string())
                out = [batch.column("key"), decoded, pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                same = pa.compute.equal(decoded, batch.column("text").cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*out, same, own], schema=kinds)

    out = rows.select(F.col(key).alias("key"), F.col(ids).alias("ids"), text.alias("text")).mapInArrow(run, schema)
    named = out.select(F.col("key").alias(key), "decoded", "n_pieces", "ids_crc32", F.col("ids").alias(ids), F.col("same").alias("lossless"))
    return named if original else named.drop("lossless")
