"""Decontamination against brute force: copies that lack parts of an item."""

import random
import string

import numpy as np
import pytest

from ledgerline.llm import latent
from ledgerline.llm.latent import Latent, coded, common_subsequence, contaminated, document_frequencies, passages, right_factors

P = Latent(features=4096, rank=64)


def vocabulary(rng, n=900):
    return ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def sayer(rng, words):
    return lambda n: [rng.choice(words[:40] if rng.random() < 0.4 else words) for _ in range(n)]


def holds(words, item, p=P):
    """The stated rule, by every stretch of twice the item's length."""
    for at in range(max(1, len(words) - 2 * len(item) + 1)):
        near = words[at : at + 2 * len(item)]
        length = common_subsequence(item, near)
        if length == len(item) or len(item) >= p.short and length >= p.overlap * len(item):
            return True
        answer = item[-p.answer_words :]
        if len(item) >= p.short and length >= p.overlap_with_answer * len(item):
            if any(near[i : i + len(answer)] == answer for i in range(len(near))):
                return True
    return False


def without_opening(item, say):
    return item[len(item) * 27 // 100 :]


def other_opening(item, say):
    n = len(item) * 27 // 100
    return say(n) + item[n:]


def other_middle(item, say):
    n, half = len(item) * 18 // 100, len(item) // 2
    return item[: half - n // 2] + say(n) + item[half - n // 2 + n :]


def other_words(item, say):
    return [say(1)[0] if k % 6 == 3 else w for k, w in enumerate(item)]


@pytest.mark.parametrize("change", [without_opening, other_opening, other_middle, other_words])
def test_changed_copies_are_found(spark, change):
    rng = random.Random(12)
    say = sayer(rng, vocabulary(rng))
    items = [(i, say(rng.randint(40, 59))) for i in range(10)]
    rows = [(k, say(rng.randint(30, 200))) for k in range(30)]
    rows += [(1000 + i, say(rng.randint(30, 60)) + change(item, say) + say(rng.randint(30, 60))) for i, item in items]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in contaminated(docs, bench, p=P).where("contaminated").collect()}
    want = {k: [i for i, item in items if holds(w, item)] for k, w in rows}
    assert [k for k in want if want[k]] == [1000 + i for i, _ in items]
    assert got == {k: v for k, v in want.items() if v}


def test_short_items_at_every_offset(spark):
    rng = random.Random(3)
    words = vocabulary(rng, 300)
    items = [(n, [f"q{n}x{k}" if k % 3 == 0 else words[20 * n + k - 20] for k in range(n)]) for n in range(1, 16)]
    plain = [w for w in vocabulary(rng, 200) if w not in words]
    rows = [(100 * n + at, [rng.choice(plain) for _ in range(at)] + item + [rng.choice(plain) for _ in range(40 - at)]) for n, item in items for at in range(25)]
    rows += [(9000, [rng.choice(plain) for _ in range(60)]), (9001, items[6][1][:-1] + plain[:20]), (9002, items[11][1][2:] + plain[:20])]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in contaminated(docs, bench, p=P).where("contaminated").collect()}
    assert got == {**{100 * n + at: [n] for n, _ in items for at in range(25)}, 9002: [12]}


def test_projection_is_fitted_on_all_passages(spark, monkeypatch):
    docs = spark.range(250_000).selectExpr("id as doc_id", "concat('w', id % 700, ' v', id % 313) as text")
    bench = spark.createDataFrame([(1, "w5 v5")], "item_id long, text string")
    seen = []
    monkeypatch.setattr(latent, "right_factors", lambda codes, weight, p: seen.append(codes.count()) or np.zeros((p.features, 1), np.float32))
    contaminated(docs, bench)
    assert seen == [250_000]


def test_projection_holds_the_leading_directions(spark):
    rng = random.Random(8)
    words = vocabulary(rng, 400)
    texts = [" ".join(rng.choice(words[k % 7 * 50 : k % 7 * 50 + 90]) for _ in range(rng.randint(20, 90))) for k in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    p = Latent(features=1024, rank=7, extra=60)
    codes = coded(docs, "doc_id", "text", p)
    count, n = document_frequencies(codes, p)
    weight = np.log((1 + n) / (1 + count)).astype(np.float32)
    rows = []
    for r in codes.collect():
        code = np.frombuffer(r[1], "<u2").astype(np.int64)
        for a, b in zip(*passages(np.array([0, len(code)]), p.whole, p.whole)[:2]):
            rows.append(np.bincount(code[a:b], minlength=p.features) * weight)
    _, value, right = np.linalg.svd(np.array(rows), full_matrices=False)
    got = right_factors(codes, weight, p)
    assert np.allclose(1 / np.linalg.norm(got, axis=0)[:3], value[:3], rtol=0.02)
    assert len(rows) == n and got.shape == (1024, 7)
