"""Document quality by co-training: a classifier of the words and one of the page's metadata teach each other."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.arrays import arrow_schema, slices
from ledgerline.llm.store import scratch, stored
from ledgerline.llm.views import Vocabulary, distinct_pairs, page_terms, word_numbers, word_terms

#: Rows of a fit that one task holds, about; bytes of text, and rows of stored numbers, that a task works on at a time.
FIT_ROWS, VIEW_BYTES, LOGIT_ROWS = 20_000, 128 << 10, 1_000
#: MB of rows that a fit keeps side by side: larger arrays fill whole regions of the executor's heap, which then grows to its limit.
FIT_BLOCK_MB = 0.25


@dataclass(frozen=True)
class CoTraining:
    """labelled_rows: labelled documents that the fit may use, drawn by a hash of the key; all unlabelled documents may get
    pseudo-labels, and all documents are scored. rounds: exchanges of pseudo-labels. sure: calibrated probability from which a
    view passes one on, and the precision that it must have on the calibration fold; proof: rows there that prove it.
    least_docs and evidence: labelled documents that a word feature needs, and its chi-square against either label; terms:
    features kept for each label. page_features: hashed features. penalty: L2. reject: probability from which a document is
    rejected."""

    labelled_rows: int = 20_000
    rounds: int = 2
    sure: float = 0.97
    proof: int = 20
    least_docs: int = 8
    evidence: float = 20.0
    terms: int = 2000
    page_features: int = 1 << 12
    iterations: int = 60
    penalty: float = 1e-4
    reject: float = 0.5


@dataclass(frozen=True)
class Head:
    """A fitted classifier: weights of the features of one view, then its calibration."""

    view: str
    weights: np.ndarray
    shift: float
    slope: float = 1.0
    base: float = 0.0

    def logits(self, numbers: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(of, self.weights[numbers], minlength=n) + self.shift

    def scaled(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.base, -500, 500)))


def _inputs(docs: DataFrame, text: str) -> list[Column]:
    """Text and metadata of a document; columns that docs lacks are null."""
    have = set(docs.columns)
    lang, source = (F.col(c).cast("string") if c in have else F.lit(None).cast("string") for c in ("lang", "source"))
    n_chars = F.col("n_chars").cast("double") if "n_chars" in have else F.lit(None).cast("double")
    return [F.coalesce(F.col(text).cast("string"), F.lit("")), lang, source, n_chars]


def _viewed(columns: list[pa.Array], vocabulary: Vocabulary, page_features: int) -> Iterator[tuple]:
    """(rows, word numbers and their rows, page numbers and their rows) of bounded slices."""
    batch = pa.RecordBatch.from_arrays(columns, ["text", "lang", "source", "n_chars"])
    for part in slices(iter([batch]), "text", VIEW_BYTES):
        n = part.num_rows
        words, fresh = word_numbers(part.column(0), vocabulary)
        page = page_terms(part.column(0), fresh, *(part.column(i) for i in (1, 2, 3)), page_features)
        yield n, words, (page.ravel(), np.repeat(np.arange(n), page.shape[1]))
    pa.default_memory_pool().release_unused()  # workers live on between stages


def _lists(numbers: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers.astype(np.int32)))


def numbered(docs: DataFrame, text: str, vocabulary: Vocabulary, page_features: int) -> Column:
    """(words, page): the numbers of a document's features in both views."""

    @F.arrow_udf("words array<int>, page array<int>")
    def run(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        parts = [[_lists(*words, n), _lists(*page, n)] for n, words, page in _viewed([a, b, c, d], vocabulary, page_features)]
        both = [pa.concat_arrays(of) if of else pa.array([], pa.list_(pa.int32())) for of in zip(*parts, strict=True)] if parts else [pa.array([], pa.list_(pa.int32()))] * 2
        return pa.StructArray.from_arrays(both, ["words", "page"])

    return run(*_inputs(docs, text))


def telling_terms(rows: DataFrame, p: CoTraining) -> np.ndarray:
    """The word terms that tell most about a label of rows (text, low, toxic), by chi-square; at most p.terms for each label.

    Tasks count how many texts of each label have a term, slice by slice, as 64-bit numbers; only these counts are shuffled.
    """
    ddl = "term long, n_low double, low double, n_toxic double, toxic double"
    kinds = arrow_schema(ddl)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", VIEW_BYTES):
            terms, of = distinct_pairs(*word_terms(part.column("text"))[:2])
            known, at = np.unique(terms, return_inverse=True)
            out = [pa.array(known.view(np.int64))]
            for goal in ("low", "toxic"):
                value = part.column(goal).to_numpy(zero_copy_only=False).astype(float)  # null: NaN
                there = ~np.isnan(value)
                out += [pa.array(np.bincount(at, v[of], minlength=len(known))) for v in (there.astype(float), np.where(there, value, 0.0))]
            yield pa.RecordBatch.from_arrays(out, schema=kinds)

    sums = [F.sum(c).alias(c) for c in ("n_low", "low", "n_toxic", "toxic")]
    counts = rows.select("text", "low", "toxic").mapInArrow(count, ddl).groupBy("term").agg(*sums)
    counts = stored(counts.where(f"n_low >= {p.least_docs} or n_toxic >= {p.least_docs}"), "terms")
    found: set[int] = set()
    for goal in ("low", "toxic"):
        n, bad = rows.where(F.col(goal).isNotNull()).agg(F.count("*"), F.coalesce(F.sum(goal), F.lit(0.0))).first()
        if not 0 < bad < n:
            continue
        chi = f"{n} * pow({goal} * {n - bad} - (n_{goal} - {goal}) * {bad}, 2) / ({bad * (n - bad)} * n_{goal} * greatest({n} - n_{goal}, 1))"
        best = counts.where(f"n_{goal} >= {p.least_docs}").withColumn("chi", F.expr(chi)).where(f"chi >= {p.evidence}")
        found.update(r[0] for r in best.orderBy(F.desc("chi"), "term").limit(p.terms).collect())
    return np.array(sorted(found), np.int64).view(np.uint64)


def _vector(numbers: Column, size: int) -> Column:
    """Sorted, distinct feature numbers in the form in which Parquet holds a sparse vector of ones, and is read as one."""
    ones = F.array_repeat(F.lit(1.0), F.size(numbers))
    return F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), numbers.alias("indices"), ones.alias("values"))


def _fit(rows: DataFrame, view: str, count: int, p: CoTraining) -> Head:
    """rows: (view, goal, weight), count of them."""
    model = LogisticRegression(
        featuresCol=view, labelCol="goal", weightCol="weight", maxIter=p.iterations, regParam=p.penalty, standardization=False, maxBlockSizeInMB=FIT_BLOCK_MB
    ).fit(rows.coalesce(count // FIT_ROWS + 1))
    return Head(view, model.coefficients.toArray(), float(model.intercept))


def _logits(head: Head) -> Column:
    """The head's logits of stored numbers. The function is marked as not deterministic, so that a filter by its result is not
    pushed below it: a second run over the rows would need a second Python worker for each task."""

    @F.arrow_udf("double")
    def run(numbers: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(numbers), LOGIT_ROWS):
            part = numbers.slice(start, LOGIT_ROWS)
            of = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
            out.append(head.logits(part.flatten().to_numpy(), of, len(part)))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return run.asNondeterministic()(F.unwrap_udt("words")["indices"] if head.view == "words" else F.col("marks"))


def _platt(rows: list[tuple[float, float]]) -> tuple[float, float]:
    """Slope and intercept that turn logits into probabilities, by damped Newton steps on a bounded fold. Labels are smoothed by
    one row each, so that a perfect separation keeps finite values."""
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    bad = y.sum()
    goal = np.where(y > 0, (bad + 1) / (bad + 2), 1 / (len(y) - bad + 2))
    both = np.stack([x, np.ones(len(x))])

    def loss(at: np.ndarray) -> float:
        z = at @ both
        return float((np.logaddexp(0, z) - goal * z).sum())

    at = np.array([0.0, float(np.log((bad + 1) / (len(y) - bad + 1)))])
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(at @ both, -35, 35)))
        slope = both @ (q - goal)
        step = np.linalg.solve((both * (q * (1 - q))) @ both.T + 1e-9 * np.eye(2), slope)
        scale = 1.0
        while scale > 1e-8 and loss(at - scale * step) > loss(at):
            scale /= 2
        at = at - scale * step
        if abs(scale * step).max() < 1e-7:
            break
    return max(float(at[0]), 0.0), float(at[1])


@dataclass(frozen=True)
class CoTrained:
    """Fitted heads by name. A head without rows of both kinds is missing."""

    p: CoTraining
    vocabulary: Vocabulary
    heads: dict[str, Head]

    def scored(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """row (all columns of docs), toxic_score, word_score, page_score, score, kept for every document.

        word_score and page_score are the calibrated probabilities of low quality by the two views, toxic_score that of toxic
        words. The views are averaged, and a document is bad for either reason: 1 - (1 - toxic) * (1 - (word + page) / 2).
        Null or empty texts are scored by their metadata; null metadata is a value of its own. A missing head scores 0, so
        without labels every document is kept. There is no shuffle; repeated rows and null keys are rows like any other.
        """
        vocabulary, heads, p = self.vocabulary, self.heads, self.p
        names = ["toxic_score", "word_score", "page_score", "score"]

        @F.arrow_udf(", ".join(f"{c} double" for c in names))
        def run(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
            found: list[list[np.ndarray]] = [[], [], []]
            for n, words, page in _viewed([a, b, c, d], vocabulary, p.page_features):
                for out, name in zip(found, ("toxic", "word", "page"), strict=True):
                    head = heads.get(name)
                    out.append(head.scaled(head.logits(*(page if head.view == "page" else words), n)) if head else np.zeros(n))
            toxic, word, page = (np.concatenate(f) if f else np.zeros(0) for f in found)
            score = 1 - (1 - toxic) * (1 - (word + page) / 2)
            return pa.StructArray.from_arrays([pa.array(x) for x in (toxic, word, page, score)], names)

        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        out = docs.select(row.alias("row"), run(*_inputs(docs, text)).alias("scores"))
        return out.select("row", "scores.*").withColumn("kept", F.col("score") < p.reject)


def co_train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", p: CoTraining = CoTraining()) -> CoTrained:
    """Fit the views. labels: (key, quality, toxic). Low quality is quality 0; a repeated key is low or toxic if any row says so;
    labels with a null key are left out, and a null label trains nothing. Documents with a null key are unlabelled.

    Labelled rows are drawn by a hash of the key up to the bound, and split: four fifths train, one fifth calibrates. The features
    of all other documents are numbered and stored once. In each round the classifier of words and the classifier of metadata
    score all unlabelled documents, and what each is sure of, high or low, trains the other in the next round, if its precision
    on the calibration fold bears that out; together these rows weigh no more than the labelled ones. Toxic words leave no mark
    on the metadata, so their classifier belongs to the words alone.
    """
    spark = docs.sparkSession
    spread = F.pmod(F.xxhash64("key", F.lit(41)), F.lit(1 << 30)) / (1 << 30)
    said = [F.max((F.col("quality") == 0).cast("double")).alias("low"), F.max((F.col("toxic") == 1).cast("double")).alias("toxic")]
    known = stored(labels.select(F.col(key).alias("key"), "quality", "toxic").where("key is not null").groupBy("key").agg(*said), "labels")
    share = min(1.0, p.labelled_rows / max(1, known.count()))
    fold = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(5)) == 0
    part = F.when(spread >= share, "spare").when(fold, "fold").otherwise("train")
    known = stored(known.withColumn("part", part), "known")

    # At most labelled_rows keys, but for chance, of 24 bytes each: they go to every task, so that no text is shuffled.
    chosen = F.broadcast(known.where("part = 'train'").select(F.col("key").alias("_chosen"), "low", "toxic"))
    body = docs.select(F.col(key).alias("_key"), _inputs(docs, text)[0].alias("text"))
    terms = telling_terms(body.join(chosen, F.col("_key") == F.col("_chosen")), p)
    vocabulary = Vocabulary(terms)

    views = docs.select(F.col(key).alias("_key"), numbered(docs, text, vocabulary, p.page_features).alias("v")).select("_key", "v.*")
    joined = views.join(known, F.col("_key") == F.col("key"), "left").withColumn("part", F.coalesce("part", F.lit("pool")))
    folder = scratch(spark, "views")
    page = F.array_sort(F.array_distinct("page"))  # two of a page's marks may share a number
    both = [_vector(F.col("words"), max(1, len(vocabulary))).alias("words"), _vector(page, p.page_features).alias("page"), F.col("page").alias("marks")]
    joined.where("part <> 'spare'").select(*both, "low", "toxic", "part").write.partitionBy("part").parquet(folder)
    kinds = StructType().add("words", VectorUDT()).add("page", VectorUDT())
    kinds = StructType([*kinds, *StructType.fromDDL("marks array<int>, low double, toxic double, part string")])
    sample = spark.read.schema(kinds).parquet(folder)
    train, fold, pool = (sample.where(F.col("part") == of) for of in ("train", "fold", "pool"))

    def goals(rows: DataFrame, goal: str) -> dict[float, int]:
        return {r[0]: r[1] for r in rows.groupBy(goal).count().collect() if r[0] is not None}  # two kinds at most

    known_goals = {goal: goals(train, goal) for goal in ("low", "toxic")}

    def head(view: str, goal: str, extra: tuple[DataFrame, dict[float, int]] | None) -> tuple[Head, list] | None:
        rows = train.where(F.col(goal).isNotNull()).select(view, F.col(goal).alias("goal"), F.lit(1.0).alias("weight"))
        told, more = extra or (None, {})
        rows = rows if told is None else rows.unionByName(told)
        if len(known_goals[goal].keys() | more.keys()) < 2:
            return None
        fitted = _fit(rows, view, sum(known_goals[goal].values()) + sum(more.values()), p)
        marks = fold.where(F.col(goal).isNotNull()).select(_logits(fitted).alias("x"), goal)
        marks = [(r[0], r[1]) for r in marks.collect()]  # a fifth of labelled_rows
        slope, base = _platt(marks) if marks else (1.0, 0.0)
        return Head(view, fitted.weights, fitted.shift, slope, base), marks

    def sure(found: tuple[Head, list], other: str) -> tuple[DataFrame, dict[float, int]] | None:
        own, marks = found
        proven = []
        for says in (0.0, 1.0):
            strong = [y == says for x, y in marks if (q := float(own.scaled(np.array(x)))) >= p.sure * says and 1 - q >= p.sure * (1 - says)]
            if len(strong) >= p.proof and sum(strong) >= p.sure * len(strong):
                proven.append(says)
        if not proven:
            return None
        q = 1 / (1 + F.exp(-F.lit(own.slope) * _logits(own) - F.lit(own.base)))
        says = F.when(F.col("q") >= p.sure, 1.0).when(F.col("q") <= 1 - p.sure, 0.0)
        told = pool.select(other, q.alias("q")).withColumn("goal", says).where(F.col("goal").isin(proven)).select(other, "goal")
        count = goals(told, "goal")
        weight = min(1.0, sum(known_goals["low"].values()) / max(1, sum(count.values())))
        return told.withColumn("weight", F.lit(weight)), count

    toxic = head("words", "toxic", None)
    to_word = to_page = None
    for turn in range(p.rounds + 1):
        word, page = head("words", "low", to_word), head("page", "low", to_page)
        if turn < p.rounds and word and page:
            to_word, to_page = sure(page, "words"), sure(word, "page")
    return CoTrained(p, vocabulary, {name: h[0] for name, h in (("toxic", toxic), ("word", word), ("page", page)) if h})
