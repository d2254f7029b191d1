"""Results stay the same where operators do less work for them."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from pyspark.ml.linalg import VectorUDT

from ledgerline.llm import arrays, cotraining, latent
from ledgerline.llm import encoder as encoding
from ledgerline.llm.cotraining import CoTraining, co_train
from ledgerline.llm.encoder import Encoder
from ledgerline.llm.latent import _once, passages
from ledgerline.llm.pieces import lattice, sample
from ledgerline.llm.repair import _numbered
from ledgerline.llm.views import Vocabulary, word_numbers, word_terms


def test_chunks_meet_the_library_in_long_texts(monkeypatch):
    """Most distinct chunks are given side by side; texts that spell a special token across a border are still encoded apart."""
    own = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain, given = own.encode, []
    own.encode = lambda texts: (given.extend(texts), plain(texts))[1]
    words = [f" {a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    texts = ["start" + "".join(words), None, "", "a, b. C\n\nd \n e", "<|endoftext|>x", "a <|endoftext", "b |>abc", "x.y z's 12 ab c été b"]
    ids, bounds = own.ids(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == plain([t or "" for t in texts])
    own.encode = plain
    other = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    calls, there = [], other.encode
    other.encode = lambda texts: (calls.extend(texts), there(texts))[1]
    other.ids(pa.array(texts[:1]))
    assert len(calls) < 20  # 601 distinct chunks
    # chunks met again are remembered when there are too many
    monkeypatch.setattr(encoding, "KEPT_CHUNKS", 500)
    calls.clear()
    other.ids(pa.array([" klmu" + " aku" * 3]))
    got, at = other.ids(pa.array(["x aku akv", "y aku"]))
    assert [got[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == plain(["x aku akv", "y aku"])
    assert " aku" in other.index and len(other.index) < 500


def test_pairs_that_share_a_bucket_are_told_apart():
    code = np.array([9, 4, 9, 7, 5, 4, 9], np.uint64)
    kinds, kind, often = _numbered(code, np.array([1, 1, 1, 3, 3, 1, 1]), np.array([False, True, False, True]))
    assert kinds.tolist() == [4, 5, 7, 9] and kind.tolist() == [3, 0, 3, 2, 1, 0, 3] and often.tolist() == [2, 1, 1, 3]


def test_codes_of_passages_count_once():
    """Lines of a table give what a sort of all pairs gives: short, empty, repeated and overlapping last passages."""
    rng = np.random.default_rng(3)
    of = np.cumsum([0, 0, 1, 24, 25, 0, 70, 3, 24 * 700, 0])
    code = rng.integers(0, 9, of[-1])
    code[-40:] = 7
    begin, _, _ = passages(of, 24, 24)
    number = np.searchsorted(begin, np.arange(len(code)), side="right") - 1
    want = np.unique(number * 9 + code) % 9
    assert np.array_equal(np.bincount(_once(code, begin, 24), minlength=9), np.bincount(want, minlength=9))
    assert len(_once(np.zeros(0, np.int64), np.zeros(0, np.int64), 24)) == 0


def test_lattice_asks_only_for_beginnings_of_pieces():
    """Strings that begin no piece are not looked up at greater widths, and lists of ids spell the texts at once."""
    own = lattice(public_tokenizers.path("piece_bpe_32k.model"), 0.5)
    asked, plain = [], own.find
    own.find = lambda value, n: (asked.append(len(value)), plain(value, n))[1]
    texts = ["qzxjvkqw " * 300, None, "", " ", "▁▁ x", "日本 é\U0001f600  \n\n  ab", "x" * 3000, "the " * 50 + "\0", " lead", "trail  "]
    try:
        ids, bounds = sample(pa.array([*texts, " ".join("qzxjvkqw"[k:] + str(k) * 9 for k in range(8))]), np.arange(11, dtype=np.uint64), own)
    finally:
        del own.find
    assert sum(asked) < 0.5 * own.width * asked[0]
    assert own.spelt(ids, bounds).to_pylist()[:10] == [t or "" for t in texts]
    crossed = [own.bytes[b] for b in "é".encode()]
    try:
        own.spelt(np.array([own.bytes[32], *crossed[:1]]), np.array([0, 2]))
        raise AssertionError("half a character was decoded")
    except pa.ArrowInvalid:
        pass


def test_fits_read_stored_sparse_vectors(spark, monkeypatch):
    """Feature numbers are not turned into strings and back for every pass of every fit; a row's vector has each number once."""
    seen, plain = [], cotraining._fit
    monkeypatch.setattr(cotraining, "_fit", lambda rows, view, *rest: (seen.append((rows, view, rest)), plain(rows, view, *rest))[1])
    rows = [(k, " ".join(f"{'bad' if k % 3 == 0 else 'good'}{c} %%" for c in "abcdefgh"), "en", "s", 50) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(0, 90, 2)], "doc_id long, quality int, toxic int")
    fitted = co_train(docs, labels, p=CoTraining(rounds=1, proof=2, sure=0.6, least_docs=2, evidence=1.0, page_features=16, iterations=5))
    assert set(fitted.heads) == {"word", "page"} and len(seen) == 4
    for df, view, rest in seen:
        assert isinstance(df.schema[view].dataType, VectorUDT)
        assert "cast" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
        found = [r[0] for r in df.select(view).collect()]
        assert rest[0] == len(found) and all((np.diff(v.indices) > 0).all() and (v.values == 1).all() for v in found)
        assert {v.size for v in found} == {16 if view == "page" else len(fitted.vocabulary)}


def test_a_fit_has_one_python_function(spark, monkeypatch):
    """A filter by the scores does not score once more, in a second worker of each task; arrays of a fit stay small."""
    plans, blocks, plain, real = [], [], cotraining._fit, cotraining.LogisticRegression
    monkeypatch.setattr(cotraining, "LogisticRegression", lambda **k: (blocks.append(k.get("maxBlockSizeInMB", 1)), real(**k))[1])
    monkeypatch.setattr(cotraining, "_fit", lambda rows, *rest: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), plain(rows, *rest))[1])
    rows = [(k, " ".join(f"{'bad' if k % 3 == 0 else 'good'}{c} %%" for c in "abcdefgh"), "en", "s", 50) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(0, 90, 2)], "doc_id long, quality int, toxic int")
    co_train(docs, labels, p=CoTraining(rounds=1, proof=2, sure=0.6, least_docs=2, evidence=1.0, iterations=5))
    assert [p.count("ArrowEvalPython") for p in plans] == [0, 0, 1, 1]
    assert max(blocks) <= 0.5  # an array of half a MB has a region of the heap to itself


def test_sums_of_words_are_held_in_parts(monkeypatch):
    """Lines are added word by word as before, without the sums of all pieces at once; a word with many pieces is not cut."""
    rng = np.random.default_rng(5)
    lines = np.append(rng.integers(-9, 9, (50, 4)), np.zeros((1, 4)), axis=0).astype(np.float32)
    pieces = np.array([1, 3, 40, 1, 1, 2, 7])
    first, word = np.cumsum(pieces) - pieces, np.array([0, 2, 3, 5, 6, 8, 9])
    adds = rng.integers(0, 51, latent.PIECE * pieces.sum())
    want = np.ones((11, 4), np.float32)
    np.add.at(want, np.repeat(word, latent.PIECE * pieces), lines[adds])
    sizes, plain, got = [], latent._vectors, np.ones((11, 4), np.float32)
    monkeypatch.setattr(latent, "HELD_SUMS", 5)
    monkeypatch.setattr(latent, "_vectors", lambda *a: (sizes.append(len(a[1])), plain(*a))[1])
    latent._add(got, word, first, adds, lines)
    assert np.array_equal(got, want) and sizes == [4, 40, 4, 7]


def test_workers_keep_small_tables_of_powers(monkeypatch):
    """Small slices leave small tables in a worker; longer texts still get the whole table."""
    monkeypatch.setattr(arrays, "_powers", {})
    data = np.random.default_rng(1).integers(0, 256, 3_000_000).astype(np.uint8)
    code = arrays.hash64(data[:1000], np.array([0, 10]), np.array([1000, 30]))
    assert sum(t.nbytes for t in arrays._powers.values()) < 1 << 16
    assert arrays.hash64(data, np.array([0, 10, 2_999_000]), np.array([1000, 30, 3_000_000]))[:2].tolist() == code.tolist()


def test_distinct_words_are_looked_up_once(monkeypatch):
    """A word that is repeated in a slice is looked up once, and every text still gets each of its features once."""
    texts = pa.array(["Good %% bad bad", None, "", "bad Good x%$# " * 300, "é中 ü", "%%% 12", "goodness"] * 3)
    terms, of, fresh = word_terms(texts)
    known, asked = Vocabulary(np.unique(terms)[::2]), []
    want = known.found(terms, of)
    plain = Vocabulary.numbers
    monkeypatch.setattr(Vocabulary, "numbers", lambda self, terms: (asked.append(len(terms)), plain(self, terms))[1])
    got, new = word_numbers(texts, known)
    assert all(np.array_equal(a, b) for a, b in zip(got, want)) and np.array_equal(new, fresh)
    assert asked[0] == 6 * 6  # good, bad, x, é中, ü, goodness; as words and by five beginnings
    pairs = set(zip(want[1].tolist(), known.terms[want[0]].tolist()))
    assert pairs == {(t, x) for t, x in zip(of.tolist(), terms.tolist()) if x in set(known.terms.tolist())}


def test_sums_reach_the_driver_as_bytes(spark, monkeypatch):
    """The sums of a pass come as a few values and are the sums of all tasks, whatever the number of lines."""
    p = latent.Latent(features=100, rank=4, extra=3)
    docs = spark.createDataFrame([(k, " ".join(f"w{k * j % 50}" for j in range(1, 60))) for k in range(40)], "doc_id long, text string")
    codes = latent.coded(docs.repartition(5), "doc_id", "text", p)
    a = np.zeros((0, 100))
    for r in codes.collect():
        code = np.frombuffer(r[1], "<u2").astype(np.int64)
        of = np.array([0, len(code)])
        a = np.append(a, [np.bincount(code[x:y], minlength=100) for x, y in zip(*passages(of, p.whole, p.whole)[:2])], axis=0)
    seen, plain = [], type(codes).collect
    monkeypatch.setattr(type(codes), "collect", lambda self: (seen.append(plain(self)), seen[-1])[1])
    x, weight = np.random.default_rng(2).standard_normal((100, 7)), np.arange(100) / 10
    assert np.allclose(latent._gathered(codes, x, weight, p), weight[:, None] * (a.T @ (a @ x)), rtol=1e-4, atol=1e-2)
    assert np.allclose(latent._gathered(codes, x, None, p), (a @ x).T @ (a @ x), rtol=1e-4, atol=1e-2)
    assert [len(rows) for rows in seen] == [7, 1] and all(isinstance(r[1], (bytes, bytearray)) for rows in seen for r in rows)


def test_alignment_needs_no_shuffle_of_texts(spark, monkeypatch):
    """Stretches are aligned in the task that finds them; only the keys that hold an item are joined."""
    plans, plain = [], latent.stored
    monkeypatch.setattr(latent, "stored", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), plain(df, name))[1])
    words = [f"v{k}" for k in range(300)]
    item = " ".join(words[:30])
    rows = [(k, " ".join(words[(k * 7 + j * (k + 1)) % 300] for j in range(80)) + (" " + item if k % 10 == 0 else "")) for k in range(60)]
    docs = spark.createDataFrame([*rows, (None, item), (7, item), (90, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    got = latent.contaminated(docs, bench, p=latent.Latent(features=1024, rank=32)).where("contaminated").collect()
    assert sorted(r["doc_id"] for r in got) == [0, 7, 7, 10, 20, 30, 40, 50] and all(r["items"] == [1] for r in got)
    assert not any("Join" in plan for plan in plans)
