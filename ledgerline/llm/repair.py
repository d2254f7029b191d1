"""Token ids in Re-Pair compressed shard files: rules, expansion lengths and an index for random access."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.arrays import slices
from ledgerline.llm.encoder import ENCODE_BYTES, encoder
from ledgerline.llm.store import stored, write_file

MAGIC = b"RPAIR01\n"
_HEADER = struct.Struct("<8sIIIIQQ")  # magic, documents, rules, first nonterminal, symbol bytes, symbols, ids
_BUCKETS = 1 << 21


@dataclass(frozen=True)
class RePair:
    """rounds: passes over a shard. pairs: the most frequent pairs replaced in one pass. least: occurrences that a pair needs.
    rules: nonterminals in a shard at most, so that symbols of a 50k vocabulary fit 16 bits."""

    rounds: int = 6
    pairs: int = 2048
    least: int = 8
    rules: int = 12_000


def _numbered(code: np.ndarray, bucket: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes in order, the number of each code among them and how often each is there; equal codes share a bucket, and
    heavy marks the buckets. One code a bucket needs no sort of all codes; only the others that meet there are sorted."""
    own = np.flatnonzero(heavy)
    place = np.zeros(len(heavy), np.int32)
    place[own] = np.arange(len(own))
    kind = place[bucket].astype(np.int64)
    kinds = np.zeros(len(own), np.uint64)
    kinds[kind] = code
    other = np.flatnonzero(kinds[kind] != code)
    if len(other):
        more, number = np.unique(code[other], return_inverse=True)
        kind[other] = len(kinds) + number
        kinds = np.concatenate((kinds, more))
    order = np.argsort(kinds)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    kind = rank[kind]
    return kinds[order], kind, np.bincount(kind, minlength=len(kinds))


def compress(ids: np.ndarray, bounds: np.ndarray, first: int, p: RePair) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, document bounds among them, rules). A pass counts neighbouring pairs within documents, turns the most frequent
    ones into nonterminals and replaces their occurrences from left to right; a pair used only once is not replaced."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    filled = bounds[1:] > bounds[:-1]
    rules = np.zeros((0, 2), np.uint32)
    for _ in range(p.rounds):
        room = min(p.pairs, p.rules - len(rules))
        if room <= 0 or len(symbols) < 2:
            break
        bucket = (symbols[:-1] * np.uint32(2654435761) ^ symbols[1:] * np.uint32(2246822519)) >> np.uint32(11)
        bucket = bucket.astype(np.intp)
        bucket[last[:-1]] = 0
        count = np.bincount(bucket, minlength=_BUCKETS)
        count[0] = 0
        many = count[count >= p.least]
        bar = int(np.partition(many, -room)[-room]) if len(many) > room else p.least
        heavy = count >= bar
        at = np.flatnonzero(heavy[bucket])
        code = symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]
        kinds, kind, often = _numbered(code, bucket[at], heavy)
        top = np.argsort(-often, kind="stable")[:room]
        chosen = np.zeros(len(kinds), bool)
        chosen[top[often[top] >= p.least]] = True
        keep = chosen[kind]
        at, kind = at[keep], kind[keep]
        if not len(at):
            break
        run = np.concatenate(([True], np.diff(at) > 1))
        line = np.arange(len(at))
        keep = (line - np.maximum.accumulate(np.where(run, line, 0))) % 2 == 0  # neighbours overlap: every second one
        at, kind = at[keep], kind[keep]
        used = np.flatnonzero(np.bincount(kind, minlength=len(kinds)) >= 2)
        number = np.full(len(kinds), -1)
        number[used] = np.arange(len(used))
        keep = number[kind] >= 0
        at, kind = at[keep], kind[keep]
        symbols[at] = first + len(rules) + number[kind]
        last[at] = last[at + 1]
        rules = np.concatenate((rules, np.stack([kinds[used] >> np.uint64(32), kinds[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)))
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, last = symbols[stay], last[stay]
    ends = np.zeros(len(bounds) - 1, np.int64)
    ends[filled] = np.flatnonzero(last) + 1
    return symbols, np.concatenate(([0], np.maximum.accumulate(ends))), rules


def pack(keys: np.ndarray, ids: np.ndarray, bounds: np.ndarray, first: int, p: RePair) -> bytes:
    """The bytes of a shard: header, keys, document bounds among symbols and among ids, rules, expansion lengths, symbols."""
    symbols, at, rules = compress(ids, bounds, first, p)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    length = np.ones(first + len(rules), np.uint32)
    for k, (a, b) in enumerate(rules):
        length[first + k] = length[a] + length[b]
    head = _HEADER.pack(MAGIC, len(keys), len(rules), first, width, len(symbols), len(ids))
    parts = (keys.astype("<i8"), at.astype("<u8"), bounds.astype("<u8"), rules.astype("<u4"), length[first:].astype("<u4"), symbols.astype(f"<u{width}"))
    return head + b"".join(x.tobytes() for x in parts)


class Shard:
    """Random access to the documents of a shard's bytes."""

    def __init__(self, content: bytes):
        magic, docs, rules, first, width, symbols, self.n_ids = _HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        place = _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            out = np.frombuffer(content, kind, n, place)
            place += out.nbytes
            return out

        self.keys, self.at, self.bounds = take("<i8", docs), take("<u8", docs + 1).astype(np.int64), take("<u8", docs + 1).astype(np.int64)
        pairs, length = take("<u4", 2 * rules).reshape(-1, 2), take("<u4", rules)
        self.symbols = take(f"<u{width}", symbols)
        if place != len(content):
            raise ValueError("a shard of token ids is cut or too long")
        grown: list[np.ndarray] = []
        for a, b in pairs:
            grown.append(np.concatenate([[x] if x < first else grown[x - first] for x in (a, b)]))
        self.pool = np.concatenate([np.arange(first, dtype=np.uint32), *grown]).astype(np.uint32)
        self.size = np.concatenate((np.ones(first, np.int64), length.astype(np.int64)))
        self.begin = np.cumsum(self.size) - self.size

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.at[k] : self.at[k + 1]])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self.size[symbols]
        end = np.cumsum(size)
        return self.pool[np.repeat(self.begin[symbols] - end + size, size) + np.arange(end[-1] if len(end) else 0)]


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, first: int, key: str = "doc_id", text: str = "text", end_id: int = 0, p: RePair = RePair()) -> DataFrame:
    """Encode whole texts and write them in ascending order of key; the manifest (name, part, piece, n_ids, start).

    Null texts are empty and hold only the end id. Null keys come first and are stored as the smallest integer; rows that share
    a key are ordered by text, so a frequent key is spread over tasks. A file has one attempt's name and only files of the
    manifest count, so a repeated task leaves nothing wrong. An empty table has no files. `first`: size of the vocabulary.
    """
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text")

    def write(batches: Iterable[pa.RecordBatch]):
        part = TaskContext.get().partitionId()
        for piece, rows in enumerate(slices(batches, "text", ENCODE_BYTES)):
            ids, bounds = encoder(tokenizer_path).ids(rows.column("text"))
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
            keys = rows.column("key").to_numpy()
            name = write_file(folder, f"{part:07d}-{piece:06d}-{uuid.uuid4().hex}.rpr", pack(keys, ids, bounds, first, p))
            yield pa.RecordBatch.from_pydict({"name": [name], "part": [part], "piece": [piece], "n_ids": [len(ids)]})

    made = stored(ordered.select("key", "text").mapInArrow(write, "name string, part long, piece long, n_ids long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = made.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return stored(
        made.join(stored(parts, "parts"), "part").withColumn("start", F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).drop("base"),
        "manifest",
    )


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """One row a document from the files: (key, start, n_tokens, ids_crc32); start counts the ids of all documents before it."""

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                shard = Shard(content.as_buffer())
                ids, b = shard.expand(shard.symbols).astype("<u4"), shard.bounds
                yield pa.RecordBatch.from_pydict(
                    {
                        "name": pa.array([path.as_py().rsplit("/", 1)[1]] * len(shard.keys), pa.string()),
                        "key": shard.keys,
                        "offset": b[:-1],
                        "n_tokens": np.diff(b),
                        "ids_crc32": pa.array([zlib.crc32(ids[x:y]) for x, y in zip(b[:-1], b[1:], strict=True)], pa.int64()),
                    }
                )

    files = manifest.sparkSession.read.format("binaryFile").load(folder).select("path", "content")
    rows = files.mapInArrow(read, "name string, key long, offset long, n_tokens long, ids_crc32 long")
    found = rows.join(manifest.select("name", F.col("start").alias("base")), "name")
    return found.select(F.nullif("key", F.lit(-(1 << 63))).alias("key"), (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
