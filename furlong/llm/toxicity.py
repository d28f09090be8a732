"""Toxicity: a counterfactual-regularised linear classifier.

A logistic model over the words of a text and their beginnings. For every labelled
sentence that names a group, a counterfactual is made by swapping the group's term
for another of its kind and language; training penalises the squared change of the
score, so that the mention of a group by itself does not move it. The penalty is a
quadratic form of the weights, whose matrix is summed on the executors over all
such sentences.

Defined cases: a null or empty text has the score of a text without any known
word; a text of any length is scored whole; repeated words count once; a labelled
row whose label or text is null is not learned from; several labels of one
document count as toxic if one of them is; with no labelled rows, or labels of
one kind only, the score of every text is that share. A sentence that names
several groups has all of them swapped at once. Only the named columns
are read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, keep_rows, map_rows
from furlong.session import cut

#: Most labelled documents that the model is fitted on; a hash of the id picks them.
MAX_TRAIN = 20_000
#: Size of the model: most features besides the terms below, those that go furthest with the label; each must be in so many documents and reach this chi-squared statistic.
MAX_WORDS = 300
MIN_CHI2 = 15.0
MIN_DOCS = 3
#: Weight of the penalty on score changes and of the squared weights.
LAMBDA = 1.0
RIDGE = 0.3
THRESHOLD = 0.3

#: Terms that name groups of people, by language and kind; a counterfactual takes the next term of its kind. A parameter of ``learn``.
IDENTITY = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male", "transgender", "nonbinary"),
    ("muslim", "christian", "jew", "hindu", "buddhist", "sikh", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"), ("jewish", "islamic", "catholic"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "indian", "chinese", "mexican", "american"), ("immigrant", "refugee"), ("immigrants", "refugees"),
    ("gay", "straight", "lesbian", "heterosexual", "bisexual", "homosexual"), ("old", "young"), ("disabled", "blind", "deaf", "autistic"),
    ("femme", "homme"), ("femmes", "hommes"), ("fille", "garçon"), ("filles", "garçons"), ("musulman", "chrétien", "juif", "bouddhiste"), ("musulmans", "chrétiens", "juifs", "bouddhistes"),
    ("noir", "blanc", "arabe", "africain", "asiatique"), ("immigré", "réfugié"), ("immigrés", "réfugiés"), ("homosexuel", "hétérosexuel"), ("vieux", "jeune"), ("aveugle", "sourd", "handicapé"),
    ("frau", "mann"), ("frauen", "männer"), ("mädchen", "junge"), ("muslim", "christ", "jude", "buddhist"), ("muslime", "christen", "juden", "buddhisten"),
    ("schwarze", "weiße", "araber", "afrikaner", "asiate"), ("einwanderer", "flüchtling"), ("schwul", "lesbisch", "heterosexuell"), ("alte", "junge"), ("blinde", "gehörlose", "behinderte"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("niña", "niño"), ("niñas", "niños"), ("musulmán", "cristiano", "judío", "budista"), ("musulmanes", "cristianos", "judíos", "budistas"),
    ("negro", "blanco", "árabe", "africano", "asiático"), ("inmigrante", "refugiado"), ("inmigrantes", "refugiados"), ("homosexual", "heterosexual"), ("viejo", "joven"), ("ciego", "sordo", "discapacitado"),
)


def swaps(kinds: tuple[tuple[str, ...], ...] = IDENTITY) -> dict[str, str]:
    """The next term of its kind for every term; a term of several kinds follows the first."""
    out: dict[str, str] = {}
    for terms in kinds:
        for i, term in enumerate(terms):
            out.setdefault(term, terms[(i + 1) % len(terms)])
    return out


#: Lengths of the beginnings of words that are features, too; they catch inflected and compound forms.
PREFIXES = (4, 5, 6)

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features(words: set[str]) -> set[str]:
    """The words, and the beginnings (marked by ^) of those that are longer."""
    return words | {f"^{w[:k]}" for k in PREFIXES for w in words if len(w) > k}


def counterfactual(words: set[str], swap: dict[str, str]) -> set[str]:
    """The words with each term that names a group swapped for the next of its kind."""
    return {swap.get(w, w) for w in words}


class ToxicityModel:
    def __init__(self, words: list[str], weights: np.ndarray, bias: float):
        self.weights, self.bias = dict(zip(words, map(float, weights), strict=True)), float(bias)

    def score(self, text: str | None) -> float:
        total = self.bias + sum(sorted(self.weights[f] for f in features(words_of(text)) & self.weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def change_of(before: set[str], after: set[str], place: dict[str, int]) -> list[tuple[int, int]]:
    """What a swap does to the features of the model: (feature, 1 if it goes, -1 if it comes)."""
    own, other = features(before), features(after)
    return [*((place[w], 1) for w in own - other if w in place), *((place[w], -1) for w in other - own if w in place)]


def squares(changes, n_words: int) -> np.ndarray:
    """The sum of the outer squares of sparse changes."""
    out = np.zeros((n_words, n_words))
    for change in changes:
        for i, x in change:
            for j, y in change:
                out[i, j] += x * y
    return out


def fit(rows: list[tuple[int, list[int]]], changes: np.ndarray, n_words: int, weight: float = LAMBDA, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Newton's method on the log loss, plus ``ridge`` times the squared weights, plus ``weight`` times the squared score changes, whose ``squares`` are ``changes``."""
    x = np.zeros((len(rows), n_words + 1), np.float32)
    x[:, n_words] = 1
    for i, (_, own) in enumerate(rows):
        x[i, own] = 1
    y = np.array([label for label, _ in rows], np.float64)
    penalty = np.diag([2 * ridge] * n_words + [1e-6])
    penalty[:n_words, :n_words] += 2 * weight * changes
    w = np.zeros(n_words + 1)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        gradient = x.T @ (p - y).astype(np.float32) + penalty @ w
        curvature = ((x * (p * (1 - p)).astype(np.float32)[:, None]).T @ x).astype(np.float64) + penalty
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:n_words], w[n_words]


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_train: int = MAX_TRAIN, identity: tuple[tuple[str, ...], ...] = IDENTITY) -> ToxicityModel:
    """Fit on at most ``max_train`` labelled documents; their words and swaps are counted on the executors, and only the chosen words and the sums go to the driver."""
    spark = docs.sparkSession
    bound_batches(spark)
    swap = swaps(identity)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("key")).agg((F.max(label) > 0).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(max_train)
    texts = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    # The sample's rows are bounded by max_train, so it may be broadcast.
    rows = texts.join(F.broadcast(sample), "key").select("label", "text")

    def tokens(batch: pa.RecordBatch) -> dict:
        values = batch.column("text").to_pylist()
        named = [[sorted(w) for s in SENTENCE.split(value) if not swap.keys().isdisjoint(w := words_of(s))] for value in values]
        return {"label": batch.column("label"), "words": pa.array([sorted(words_of(v)) for v in values], pa.list_(pa.string())), "sentences": pa.array(named, pa.list_(pa.list_(pa.string())))}

    rows = cut(map_rows(rows, tokens, "label int, words array<string>, sentences array<array<string>>"))
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or toxic in (0, n):
        share = toxic / n if n else 0.0
        return ToxicityModel([], np.zeros(0), float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -30, 30)))
    a, df = F.col("toxic_df"), F.col("df")
    expected = df * F.lit(toxic / n)
    spread = expected * (1 - F.lit(toxic / n)) * (1 - df / F.lit(float(n))) + F.lit(1e-9)

    def count(batch: pa.RecordBatch) -> dict:
        every, bad = Counter(), Counter()
        for label, own in zip(batch.column("label").to_pylist(), batch.column("words").to_pylist(), strict=True):
            found = features(set(own))
            every.update(found)
            if label:
                bad.update(found)
        return {"word": pa.array(every.keys(), pa.string()), "df": pa.array(every.values(), pa.float64()), "toxic_df": pa.array([float(bad[w]) for w in every], pa.float64())}

    chosen = (
        map_rows(rows.select("label", "words"), count, "word string, df double, toxic_df double")
        .groupBy("word")
        .agg(F.sum("df").alias("df"), F.sum("toxic_df").alias("toxic_df"))
        .where(F.col("df") >= MIN_DOCS)
        .withColumn("chi2", (a - expected) * (a - expected) / spread)
        .where(F.col("chi2") >= MIN_CHI2)
        .orderBy(F.desc("chi2"), "word")
        .limit(MAX_WORDS)
    )
    words = sorted({r["word"] for r in chosen.collect()} | swap.keys())
    place = {w: i for i, w in enumerate(words)}

    def sparse(batch: pa.RecordBatch) -> dict:
        own = [[place[w] for w in features(set(x)) if w in place] for x in batch.column("words").to_pylist()]
        return {"label": batch.column("label"), "own": pa.array(own, pa.list_(pa.int32()))}

    found = [(r["label"], list(r["own"])) for r in map_rows(rows.select("label", "words"), sparse, "label int, own array<int>").collect()]
    found.sort()

    def changed(batch: pa.RecordBatch) -> dict:
        total = Counter()
        for sentences in batch.column("sentences").to_pylist():
            for sentence in sentences:
                own = change_of(set(sentence), counterfactual(set(sentence), swap), place)
                for i, x in own:
                    for j, y in own:
                        total[i, j] += x * y
        return {"i": pa.array([k[0] for k in total], pa.int32()), "j": pa.array([k[1] for k in total], pa.int32()), "n": pa.array(total.values(), pa.int64())}

    # One bare swap for each term keeps groups alike that no labelled sentence names.
    changes = squares((change_of({a}, {b}, place) for a, b in swap.items()), len(words))
    # At most a number for each two features.
    for r in map_rows(rows.select("sentences"), changed, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        changes[r["i"], r["j"]] += r["n"]
    weights, bias = fit(found, changes, len(words))
    return ToxicityModel(words, weights, bias)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every whole text."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        scores = [shared.value.score(x) for x in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())}

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_rows(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def remove_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` without the documents that the model rejects; all columns stay as they are."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda batch: [shared.value.score(x) < THRESHOLD for x in batch.column(text).to_pylist()])
