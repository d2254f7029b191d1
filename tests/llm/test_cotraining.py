"""The text view of the classifier."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import cotraining
from ledgerline.llm.cotraining import CoTraining, co_train
from ledgerline.llm.views import Vocabulary, distinct_pairs, page_terms, word_terms


def test_whole_words_are_terms():
    """Whole words and each of their beginnings, once a text: words that differ late share all but the longest."""
    terms, of = distinct_pairs(*word_terms(pa.array(["Achlichch achlichen ACHLICHEN", "achlichch", "achlichen", "x"]))[:2])
    each = [set(terms[of == k].tolist()) for k in range(4)]
    assert each[0] >= (each[1] | each[2]) - (each[1] ^ each[0]) and len(each[1] & each[2]) == 4 + 1  # stems of 3 to 6, all words new
    assert len(each[1] - each[2]) == 2 and not each[3] & each[1] - set(terms[of == 3].tolist())


def test_views_of_odd_texts():
    texts = pa.array([None, "", " \n", "é中 ü", "a" * 70_000, "%%% ... #", "w " * 5000])
    none = pa.nulls(len(texts), pa.string())
    terms, of, fresh = word_terms(texts)
    assert fresh.tolist() == [11, 11, 11, 10, 10, 11, 0] and set(of.tolist()) == set(range(7))
    page = page_terms(texts, fresh, none, pa.array(["s", None, "", "s", "s", "s", "s"]), pa.nulls(len(texts), pa.float64()), 512)
    assert page.shape == (7, 8) and page.min() >= 0 and page.max() < 512 and page[0, 0] != page[1, 0] != page[2, 0]
    known = Vocabulary(terms[of == 3][:4])
    number, text = known.found(terms, of)
    assert (text == 3).sum() == len(set(terms[of == 3][:4].tolist())) and len(set(zip(number.tolist(), text.tolist()))) == len(number)
    assert len(Vocabulary(np.zeros(0, np.uint64)).found(terms, of)[0]) == 0


def junk(k):
    return k % 3 == 0


def frames(spark, n, extra=()):
    rng = random.Random(6)
    rows = []
    for k in range(n):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(40)]
        rows.append((k, " ".join(w + "%%" if junk(k) else w for w in words), "en", "low.example" if junk(k) else "fine.example", 300, "x"))
    ddl = "doc_id long, text string, lang string, source string, n_chars long, score string"
    return spark.createDataFrame([*rows, *extra], ddl), spark.createDataFrame([(k, int(not junk(k)), 0) for k in range(0, n, 4)], "doc_id long, quality int, toxic int")


def test_very_long_repeated_and_odd_rows(spark):
    many = [(9001, "5" * 5_000_000, None, None, None, None), (9002, "% " * 2_500_000, "en", "fine.example", 5_000_000, None)]
    many += [(9003, None, None, None, None, None), (None, "", "en", "", -5, None), (4, "repeated", "en", "fine.example", 8, None), (None, None, None, None, None, None)]
    docs, labels = frames(spark, 400, many)
    labels = labels.unionByName(spark.createDataFrame([(4, 1, 0), (None, 0, 1), (8, None, None)], labels.schema))
    scored = co_train(docs, labels, p=CoTraining(rounds=1, proof=5, sure=0.9)).scored(docs)
    rows = scored.collect()
    assert len(rows) == 406 and scored.columns == ["row", "toxic_score", "word_score", "page_score", "score", "kept"]
    assert all(0 <= r["score"] <= 1 and r["toxic_score"] == 0 for r in rows)
    assert sum(r["kept"] != junk(r["row"]["doc_id"]) for r in rows if (r["row"]["doc_id"] or 9000) < 400) >= 398


def test_pseudo_labels_come_from_all_unlabelled_rows(spark, monkeypatch):
    """Labels tell the words of two kinds apart; the metadata learn from pseudo-labels how a third source goes with them."""
    docs, labels = frames(spark, 900)
    third = docs.where("doc_id % 4 <> 0").withColumn("source", F.when(F.col("source") == "low.example", "third.example").otherwise(F.col("source")))
    docs = docs.where("doc_id % 4 = 0").unionByName(third)
    seen, real = [], cotraining._fit

    def fit(rows, view, size, p):
        seen.append((view, rows.count(), rows.agg(F.sum("weight")).first()[0]))
        return real(rows, view, size, p)

    monkeypatch.setattr(cotraining, "_fit", fit)
    trained = co_train(docs, labels, p=CoTraining(rounds=1, proof=5, sure=0.9))
    known = [n for view, n, _ in seen[:2]]
    assert [v for v, _, _ in seen] == ["words", "page", "words", "page"] and known[0] == known[1]  # no toxic rows, so no such head
    assert seen[3][1] > known[0] + 500 and seen[3][2] <= 2 * known[0] + 1e-6
    rows = trained.scored(docs).where("row.source = 'third.example'").agg(F.avg("page_score")).first()[0]
    alone = co_train(docs, labels, p=CoTraining(rounds=0, proof=5)).scored(docs).where("row.source = 'third.example'").agg(F.avg("page_score")).first()[0]
    assert rows >= alone


def test_ties_do_not_depend_on_row_order(spark):
    docs, labels = frames(spark, 300)
    p = CoTraining(rounds=0, terms=5)
    one, two = (co_train(d, labels, p=p).vocabulary.terms.tolist() for d in (docs, docs.orderBy(F.desc("doc_id")).repartition(5)))
    assert one == two and 0 < len(one) <= 10


def test_toxic_words_that_differ_late(spark):
    rng = random.Random(4)
    rows = []
    for k in range(600):
        toxic = k % 4 == 0
        ends = rng.sample(["aba", "ede", "ifi"], 2) if toxic else rng.sample(["ogo", "uhu", "aka"], 2)
        words = ["w" + str(rng.randint(0, 300)) for _ in range(30)] + ["achli" + e for e in ends]
        rng.shuffle(words)
        rows.append((k, " ".join(words), "de", "src", 200, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int, toxic int")
    labels = docs.where("doc_id < 400").select("doc_id", "quality", "toxic")
    scored = co_train(docs, labels, p=CoTraining(rounds=0)).scored(docs).where("row.doc_id >= 400")
    right = scored.select((F.col("kept") == (F.col("row.toxic") == 0)).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.97
