"""Near-duplicate groups: SuperMinHash signatures, banding, verification on whole shingle sets, connected components."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import LOWER, arrow_schema, flat, hash64, mapped, mix, of_windows, words
from ledgerline.llm.graph import components
from ledgerline.llm.store import stored

_GOLDEN = 0x9E3779B97F4A7C15
_NONE = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class NearDup:
    """width: words in a shingle. least: similarity from which texts are linked, in hundredths. A signature has bands * rows
    places; a pair at 0.75 is missed by all 40 bands of 4 rows with a probability of 3e-7 or less. hubs: members of a bucket that
    all others are held against before single pairs are. pairwise: members up to which a bucket's pairs are rows; larger
    buckets are compared in blocks of `block` members."""

    width: int = 5
    least: int = 75
    bands: int = 40
    rows: int = 4
    hubs: int = 2
    pairwise: int = 24
    block: int = 256


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in order of size, and the bounds of each text's. A-Z is lower-cased; fewer words
    than `width` are one shingle; a text without words has none."""
    data, bounds = flat(texts)
    data = LOWER[data]
    starts, ends, of = words(data, bounds)
    n = np.diff(of)
    code = hash64(data, starts, ends)
    window = of_windows(code, width)
    full = np.maximum(n - width + 1, 0)
    doc = np.repeat(np.arange(len(n)), full)
    at = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full) + np.repeat(of[:-1], full)
    value = window[at]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        own = np.array([of_windows(code[of[i] : of[i + 1]], n[i])[0] for i in short], np.uint64)
        doc, value = np.concatenate((doc, short)), np.concatenate((value, mix(own + n[short].astype(np.uint64))))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[fresh], value[fresh]
    return value, np.searchsorted(doc, np.arange(len(n) + 1))


def super_minhash(value: np.ndarray, bounds: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash signatures, a row a set: level (8 bits) and a random number (24 bits) in each place.

    Each element visits all places in a random order of its own, one a level, and leaves level + random there if that is
    smaller. All elements go through a level together; a set stops as soon as no place is empty, since later levels are larger.
    """
    sets = len(bounds) - 1
    doc = np.repeat(np.arange(sets), np.diff(bounds))
    signature = np.full(sets * places, _NONE, np.uint32)
    order: np.ndarray | None = None
    for level in range(places):
        if not len(value):
            break
        with np.errstate(over="ignore"):
            x = mix(value + np.uint64((level + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
        drawn = (((x & np.uint64(0xFFFFFFFF)) * np.uint64(places - level)) >> np.uint64(32)).astype(np.int64) + level
        if order is None:
            place = drawn
        else:
            line = np.arange(len(value))
            place = order[line, drawn]
            order[line, drawn] = order[:, level]
        np.minimum.at(signature, doc * places + place, (x >> np.uint64(40)).astype(np.uint32) | np.uint32(level << 24))
        open_set = (signature.reshape(sets, places) == _NONE).any(1)
        stay = open_set[doc]
        if order is None:
            value, doc, drawn = value[stay], doc[stay], drawn[stay]
            order = np.tile(np.arange(places, dtype=np.uint8), (len(value), 1))
            order[np.arange(len(value)), drawn] = 0
        elif not stay.all():
            value, doc, order = value[stay], doc[stay], order[stay]
    return signature.reshape(sets, places)


def signatures(docs: DataFrame, key: str, text: str, p: NearDup) -> DataFrame:
    """(key, n_shingles, digest, sketch, bands): digest of the whole set, null if empty; sketch: a bit for each place, in longs;
    bands: hashes of each band's rows."""

    def run(part):
        value, bounds = shingle_sets(part.column("text"), p.width)
        size = np.diff(bounds)
        signature = super_minhash(value, bounds, p.bands * p.rows).astype(np.uint64).reshape(len(size), p.bands, p.rows)
        packed = np.packbits((mix(signature) & np.uint64(1)).astype(np.uint8).reshape(len(size), -1), axis=1)
        bits = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view("<i8")
        band = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(_GOLDEN), signature.shape[:2]).copy()
        for row in range(p.rows):
            band = mix(band * np.uint64(0x2545F4914F6CDD1D) + signature[:, :, row])
        halves = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(c))))) for c in (1, 2)]
        digest = np.stack([h[bounds[1:]] - h[bounds[:-1]] for h in halves], 1).view(np.uint8).reshape(-1)
        filled = size > 0
        column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(size), [None, pa.py_buffer(digest)])
        return {
            "key": part.column("key"),
            "n_shingles": size,
            "digest": pa.compute.if_else(pa.array(filled), column.cast(pa.binary()), pa.scalar(None, pa.binary())),
            "sketch": pa.ListArray.from_arrays(
                np.arange(0, (len(size) + 1) * bits.shape[1], bits.shape[1], dtype=np.int32), pa.array(bits.reshape(-1))
            ),
            "bands": pa.ListArray.from_arrays(
                np.arange(0, (len(size) + 1) * p.bands, p.bands, dtype=np.int32), pa.array(band.reshape(-1).view(np.int64))
            ),
        }

    kind = dict(docs.dtypes)[key]
    schema = f"key {kind}, n_shingles long, digest binary, sketch array<long>, bands array<long>"
    return mapped(docs, [F.col(key).alias("key"), F.col(text).cast("string").alias("text")], run, schema)


def verified(pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough. texts: (key, text), each key once."""
    with_a = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")

    def check(part):
        both = pa.chunked_array([part.column("ta"), part.column("tb")]).dictionary_encode().unify_dictionaries()
        value, bounds = shingle_sets(both.chunk(0).dictionary, p.width)
        left, right = (both.chunk(i).indices.to_numpy() for i in (0, 1))
        size = np.diff(bounds)
        same = np.fromiter(
            (
                len(np.intersect1d(value[bounds[x] : bounds[x + 1]], value[bounds[y] : bounds[y + 1]], assume_unique=True))
                for x, y in zip(left, right, strict=True)
            ),
            np.int64,
            len(left),
        )
        near = (same > 0) & (100 * same >= p.least * (size[left] + size[right] - same))
        return {"a": part.column("a"), "b": part.column("b"), "near": near}

    kind = dict(pairs.dtypes)["a"]
    return mapped(with_b, ["a", "b", "ta", "tb"], check, f"a {kind}, b {kind}, near boolean", "ta").where("near").drop("near")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", p: NearDup = NearDup()) -> DataFrame:
    """One row (key, n_shingles, component_id, kept) per input row; component_id is the smallest key that links reach.

    Equal sets are one class. Classes that share a band are candidates: first each member of a bucket against its hub, the one
    with most company in all its buckets (in a group of copies mostly their source); then, where a bucket still spans components,
    against the next hub; at last all pairs of a bucket in different components, as rows in small buckets (if sizes and sketches
    allow the similarity), inside blocks in large ones.
    So a group of copies costs its size, and no link between different components is left out. Links are confirmed on whole
    sets of the whole texts. Texts without words (null, empty) are alone. A null key has a null component_id and is kept; of
    rows that repeat a key each gets the same answer if their texts are equal (else the links of all its texts count).
    Other columns are ignored; an empty table gives an empty one.
    """
    sets = stored(signatures(docs, key, text, p), "signatures")
    classes = stored(
        sets.where("digest is not null and key is not null").groupBy("digest").agg(F.min("key").alias("rep")), "classes"
    )
    reps = sets.join(classes.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("key") == F.col("rep")))
    rows = reps.select("rep", "n_shingles", "sketch", F.explode("bands").alias("bucket"))
    shared = stored(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = stored(rows.join(shared, "bucket"), "members")
    company = stored(members.groupBy("rep").agg(F.sum("n").alias("company")), "company")
    members = stored(members.drop("n").join(company, "rep"), "members")
    texts = stored(
        docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .join(company.select(F.col("rep").alias("key")), "key", "left_semi")
        .groupBy("key")
        .agg(F.min("text").alias("text")),
        "texts",
    )
    labels = company.select(F.col("rep").alias("node"), F.col("rep").alias("label"))
    links, tried = None, None
    for _ in range(p.hubs):
        mixed = _mixed(members, labels, tried)
        hubs = mixed.where("not tried").groupBy("bucket").agg(F.max(F.struct("company", "rep", "label")).alias("hub"))
        hubs = stored(hubs.select("bucket", F.col("hub.rep").alias("hub"), F.col("hub.label").alias("at")), "hubs")
        pairs = mixed.join(hubs, "bucket").where("label <> at").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        found = verified(pairs.distinct(), texts, p)
        links = stored(found if links is None else links.unionByName(found), "links")
        labels = components(links, "a", "b")
        used = hubs.select("bucket", F.col("hub").alias("rep"))
        tried = stored(used if tried is None else tried.unionByName(used).distinct(), "tried")
    # every other pair that could still join two components: in small buckets as rows, in large ones inside blocks
    mixed = _mixed(members, labels, tried).where("not tried")
    mixed = stored(mixed.join(stored(mixed.groupBy("bucket").agg(F.count("*").alias("n")), "sizes"), "bucket"), "mixed")
    small = mixed.where(F.col("n") <= p.pairwise)
    other = small.select(
        "bucket", F.col("rep").alias("b"), F.col("label").alias("to"), F.col("n_shingles").alias("m_shingles"), F.col("sketch").alias("with")
    )
    words = -(-p.bands * p.rows // 64)
    apart = " + ".join(f"bit_count(sketch[{i}] ^ with[{i}])" for i in range(words))
    similar = f"{p.least} * greatest(n_shingles, m_shingles) <= 100 * least(n_shingles, m_shingles) and {apart} <= {_most_apart(p)}"
    pairs = small.join(other, "bucket").where(f"rep < b and label <> to and {similar}")
    more = verified(pairs.select(F.col("rep").alias("a"), "b").distinct(), texts, p)
    more = stored(more.unionByName(_in_blocks(mixed.where(F.col("n") > p.pairwise), texts, p)), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more), "a", "b")

    roots = classes.join(labels, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("label", "rep").alias("root"))
    found = sets.drop("bands", "sketch").join(stored(roots, "roots"), "digest", "left")
    return found.select(
        F.col("key").alias(key),
        "n_shingles",
        F.when(F.col("key").isNotNull(), F.coalesce("root", "key")).alias("component_id"),
    ).withColumn("kept", F.col("component_id").isNull() | (F.col(key) == F.col("component_id")))


def _in_blocks(members: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """Links (a, b) between members of large buckets: a bucket is dealt into blocks, each two blocks meet in one group of bounded
    size, whose whole shingle sets are compared as sparse rows; only links that connect the group's members come out."""
    kind = dict(members.dtypes)["rep"]
    blocks = F.ceil(F.col("n") / p.block).cast("long")
    dealt = members.select("bucket", "rep", blocks.alias("blocks"), F.pmod(F.xxhash64("rep", "bucket"), blocks).alias("own"))
    met = dealt.select("bucket", "rep", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    met = met.select("bucket", "rep", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = met.join(texts.withColumnRenamed("key", "rep"), "rep")
    kinds = arrow_schema(f"a {kind}, b {kind}")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep").combine_chunks()
        value, bounds = shingle_sets(group.column("text").combine_chunks(), p.width)
        size = np.diff(bounds)
        same = common_counts(value, np.repeat(np.arange(len(size)), size), len(size))
        near = (same > 0) & (100 * same >= p.least * (size[:, None] + size[None, :] - same))
        label = np.arange(len(size))
        while True:
            least = np.where(near, label[None, :], len(size)).min(1, initial=len(size))
            new = np.minimum(label, least)
            new = new[new]
            if (new == label).all():
                break
            label = new
        rep = group.column("rep").combine_chunks()
        joined = np.flatnonzero(label != np.arange(len(size)))
        return pa.table([rep.take(pa.array(label[joined])), rep.take(pa.array(joined))], schema=kinds)

    return rows.groupBy("bucket", "i", "j").applyInArrow(compare, f"a {kind}, b {kind}")


def common_counts(value: np.ndarray, row: np.ndarray, rows: int, columns: int = 4096) -> np.ndarray:
    """How many values each two rows have in common; values that only one row has are left out, the rest meet as 0/1 columns, a
    bounded number at a time."""
    _, column, often = np.unique(value, return_inverse=True, return_counts=True)
    keep = often[column] > 1
    row, column = row[keep], (np.cumsum(often > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((rows, rows), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, columns):
        a, b = np.searchsorted(column, (lo, lo + columns))
        part = np.zeros((rows, min(columns, width - lo)), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _most_apart(p: NearDup) -> int:
    """Sketch bits in which a pair at the least similarity differs, and five deviations more: each bit differs with half the
    probability that a place does."""
    places, share = p.bands * p.rows, (1 - p.least / 100) / 2
    return math.ceil(places * share + 5 * math.sqrt(places * share * (1 - share)))


def _mixed(members: DataFrame, labels: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold more than one component, with their labels and whether they were the bucket's hub."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    if tried is None:
        return stored(named.withColumn("tried", F.lit(False)), "mixed")
    named = stored(named, "named")
    spans = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    mixed = named.join(stored(spans.select("bucket"), "spans"), "bucket", "left_semi")
    seen = tried.withColumn("seen", F.lit(True))
    return stored(mixed.join(seen, ["bucket", "rep"], "left").withColumn("tried", F.col("seen").isNotNull()).drop("seen"), "mixed")
