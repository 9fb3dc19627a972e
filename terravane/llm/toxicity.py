"""Toxicity by class-conditional Kneser-Ney models.

Two models over the bytes of words, one counted on toxic and one on ordinary documents, interpolate with the same
lower orders: continuation counts pooled over both classes. So an expression that either class has hardly seen gets
its likelihood from shared counts and says little, and one that is frequent in toxic documents only says much. A
document is judged by length-normalised differences of the two log-likelihoods: over all its words, and over its most
toxic stretches, as a few words make a long text toxic. A logistic curve fitted on labelled documents that the
models have not counted turns these into a score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared
from .language_id import counted_grams, gram_counts, keys_of_pieces, portions, split_words

#: Bytes of context in the class-conditional order.
ORDER = 5
#: Labelled documents of a class, about, on which models are counted, and on which the curve is fitted (whole texts).
FIT_DOCUMENTS = 1500
CURVE_DOCUMENTS = 1500
DISCOUNT = 0.75
#: A word's log-likelihood ratio counts up to here among the most toxic ones, so that none outweighs all labels.
WORD_GAIN = 30.0
#: Bytes of words that are scored at once.
_PORTION = 1 << 16
#: The space before a word, as the oldest byte of a key: only keys that begin at a word's start have it.
_START = np.uint64(ord(" ") + 1)


def _discounted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, the number of each gram's context, each gram's discounted share, and each context's weight of backoff."""
    contexts, number = np.unique(keys >> np.uint64(9), return_inverse=True)
    total = np.bincount(number, counts, len(contexts))
    seen = np.bincount(number, counts > 0, len(contexts))
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(counts > 0, (counts - DISCOUNT * np.minimum(counts, 1)) / total[number], 0)
        back = np.where(total > 0, DISCOUNT * seen / total, 1.0)
    return contexts, number, share, back


class ToxicityModels:
    """The two models; ``difference`` gives a word's log-likelihood as toxic less that as ordinary."""

    def __init__(self, words: list[bytes], counts: np.ndarray, order: int = ORDER):
        """``counts``: a row for each word or piece, of its counts in ordinary and in toxic documents."""
        parts = [gram_counts(words, counts[:, c], order) for c in (0, 1)]
        self._build(np.concatenate([g for g, _ in parts]), np.repeat(np.arange(2), [len(g) for g, _ in parts]), np.concatenate([n for _, n in parts]), order)

    @classmethod
    def of_grams(cls, grams: np.ndarray, toxic: np.ndarray, n: np.ndarray, order: int = ORDER) -> ToxicityModels:
        """From the counts of grams of all orders, a row for each gram and class that has it."""
        self = cls.__new__(cls)
        self._build(grams, toxic, n, order)
        return self

    def _build(self, grams: np.ndarray, toxic: np.ndarray, n: np.ndarray, order: int) -> None:
        self.order, self.id, self.curve = order, uuid.uuid4().hex, np.zeros(4)
        #: By order: grams, contexts, discounted shares and backoff weights (a column for all or for each class).
        self.tables = []
        of_order = lambda k: (grams >> np.uint64(9 * k) != 0) & (grams >> np.uint64(9 * (k + 1)) == 0)
        for k in range(order):
            # Continuation count of a gram: how many different bytes, a word's first space included, stand before it.
            longer = np.unique(grams[of_order(k + 1)])
            lower, before = np.unique(longer & np.uint64((1 << 9 * (k + 1)) - 1), return_counts=True)
            contexts, _, share, back = _discounted(lower, before.astype(np.float64))
            self.tables.append((lower, contexts, share[:, None], back[:, None]))
        # The class-conditional gram of a byte has ``order`` bytes before it, or all back to the word's space.
        longest = of_order(order)
        for k in range(1, order):
            longest |= of_order(k) & (grams >> np.uint64(9 * k) == _START)
        known, row = np.unique(grams[longest], return_inverse=True)
        by_class = [_discounted(known, np.bincount(row[toxic[longest] == c], n[longest][toxic[longest] == c], len(known))) for c in (0, 1)]
        self.tables.append((known, by_class[0][0], np.stack([x[2] for x in by_class], axis=1), np.stack([x[3] for x in by_class], axis=1)))

    def difference(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words))
        for owners, pieces in portions(words, self.order, _PORTION):
            at, keys, depth = keys_of_pieces(pieces, self.order)
            chance = self._chances(keys, depth)
            out += np.bincount(owners[at], np.log(chance[:, 1]) - np.log(chance[:, 0]), len(words))
        return out[:, None].astype(np.float32)

    def _chances(self, keys: list[np.ndarray], depth: np.ndarray) -> np.ndarray:
        """Each byte's probability in ordinary and in toxic words."""
        chance = np.full((len(depth), 2), 1 / 257)
        for k, (grams, contexts, share, back) in enumerate(self.tables):
            key = np.where(depth > k, keys[k], 0) if k < self.order else np.choose(np.minimum(depth, self.order), keys)
            if not len(grams):
                continue
            row = np.minimum(np.searchsorted(grams, key), len(grams) - 1)
            known = (grams[row] == key) & (key != 0)
            above = np.minimum(np.searchsorted(contexts, key >> np.uint64(9)), len(contexts) - 1)
            here = (contexts[above] == key >> np.uint64(9)) & (key != 0)
            chance = np.where(here[:, None], np.where(known[:, None], share[row], 0) + back[above] * chance, chance)
        return chance

    def features(self, texts: list[bytes], seen: _shared.WordTable) -> np.ndarray:
        """For each text: 1, the mean difference a word, the mean of its two and of its one most toxic words."""
        words = [split_words(x) for x in texts]
        gain = seen.look_up([w for ws in words for w in ws])[:, 0].astype(np.float64)
        n = np.array([len(w) for w in words])
        out = np.zeros((len(texts), 4))
        out[:, 0] = 1
        starts = np.cumsum(n) - n
        for i in np.flatnonzero(n).tolist():
            own = gain[starts[i] : starts[i] + n[i]]
            best = np.partition(own, -2)[-2:] if n[i] > 1 else np.array([0.0, own[0]])
            out[i, 1:] = own.mean(), np.minimum(best, WORD_GAIN).mean(), min(best.max(), WORD_GAIN)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a lightly shrunk logistic regression by Newton's method; a class weighs as the root of its rows."""
    w = np.zeros(x.shape[1])
    each = np.where(y == 1, max(y.sum(), 1) ** -0.5, max((1 - y).sum(), 1) ** -0.5) * len(y) ** 0.5
    shrink = np.diag([1e-3, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + shrink, x.T @ (each * (p - y)) + shrink @ w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModels | None:
    """Models from documents (doc_id, text) and labels (doc_id, toxic: 0 or 1). None if a class has no label.

    Labels that are null or neither 0 nor 1 teach nothing, nor do those of a doc_id that has both; a label that repeats
    counts once. Documents of the same doc_id are each taken with its label. By a hash of doc_id a quarter of the labels
    is left for the curve; the models count on the others.
    """
    spark = docs.sparkSession
    marks = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.min(F.col("toxic").cast("int")).alias("toxic"), F.max(F.col("toxic").cast("int")).alias("other"))
    hashed = F.xxhash64("of")
    marks = marks.where("toxic = other").select("of", "toxic", hashed.alias("hash"), (F.pmod(hashed, F.lit(4)) == 0).alias("curve"))
    sizes = {(r["toxic"], r["curve"]): r["count"] for r in marks.groupBy("toxic", "curve").count().collect()}
    if any((toxic, False) not in sizes for toxic in (0, 1)):
        return None
    draw = F.pmod(F.shiftright("hash", 2), F.lit(1 << 30))
    chosen = F.lit(False)
    for (toxic, curve), n in sizes.items():
        most = int((1 << 30) * min(1.0, (CURVE_DOCUMENTS if curve else FIT_DOCUMENTS) / n))
        chosen = chosen | ((F.col("toxic") == toxic) & (F.col("curve") == curve) & (draw < most))
    # By its draw a sample of about 2 * (FIT_DOCUMENTS + CURVE_DOCUMENTS) labels, whatever the number of labels.
    marks = F.broadcast(marks.where(chosen).select("of", "toxic", "curve"))
    given = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = _shared.cut(given.join(marks, given["doc_id"] == marks["of"]).select("text", "toxic", "curve"))
    # Numbers only, as many as the sample has distinct grams.
    rows = counted_grams(sample.where("not curve"), "toxic", ORDER).toArrow()
    if not rows.num_rows:
        return None
    model = ToxicityModels.of_grams(rows["gram"].to_numpy().view(np.uint64), rows["toxic"].to_numpy(), rows["n"].to_numpy())
    del rows
    # At most two times CURVE_DOCUMENTS rows of five numbers, about.
    found = sample.where("curve" if any(c for _, c in sizes) else "true").mapInArrow(_features(_shared.share(spark, model)), "toxic int, mean double, two double, one double").toArrow()
    found = found.sort_by([(c, "ascending") for c in found.column_names])  # sums do not depend on the tasks' order
    x = np.column_stack([np.ones(found.num_rows), *(found[c].to_numpy() for c in ("mean", "two", "one"))])
    model.curve = _logistic(x, found["toxic"].to_numpy().astype(np.float64))
    return model


def _features(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        seen = _shared.per_worker(f"toxic:{m.id}", lambda: _shared.WordTable(m.difference, 1))
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                f = m.features(docs, seen)
                yield pa.RecordBatch.from_arrays([batch["toxic"].slice(i, j - i), *(pa.array(f[:, k]) for k in (1, 2, 3))], ["toxic", "mean", "two", "one"])

    return run


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        seen = _shared.per_worker(f"toxic:{m.id}", lambda: _shared.WordTable(m.difference, 1))
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                score = m.score(m.features(docs, seen))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return run


def _undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([0.0] * batch.num_rows), pa.array([0] * batch.num_rows, pa.int32())], ["doc_id", "score", "predicted"])


def score(docs: DataFrame, model: ToxicityModels | None) -> DataFrame:
    """(doc_id, score, predicted) for each row's whole text; predicted is 1 from 0.5 on.

    Null texts score as empty ones do, by the curve at no evidence; without a model every score is 0. Other columns are
    ignored; rows repeated or without doc_id keep their places.
    """
    given = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(given.dtypes)["doc_id"]
    run = _scores(_shared.share(docs.sparkSession, model)) if model else _undecided
    return given.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def _kept(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        seen = _shared.per_worker(f"toxic:{m.id}", lambda: _shared.WordTable(m.difference, 1))
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                clean = m.score(m.features(docs, seen)) < 0.5
                yield batch.slice(i, j - i).filter(pa.array(clean))

    return run


def keep(docs: DataFrame, model: ToxicityModels | None) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic; all of them without a model."""
    return docs.mapInArrow(_kept(_shared.share(docs.sparkSession, model)), docs.schema) if model else docs
