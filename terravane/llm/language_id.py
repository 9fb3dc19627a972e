"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ``ORDER`` bytes is counted and then frozen. A byte costs, in the
longest context that the tree knows, the code length of its count, or that of an escape and then its cost in the next
shorter context (method C: escape mass is the number of distinct bytes seen there); below the empty context all 257
symbols are alike. A text is coded as its words, each after a space and in the context of that space and its own bytes,
so a word's exact code lengths are the same wherever it stands. The language with the shortest code wins.

Counting is Spark's: each sampled text gives the byte grams of all orders, and their sums by language make the trees.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

ORDER = 4
#: The trees are fitted on about this many documents of each language (whole texts, chosen by a hash of the text).
FIT_DOCUMENTS = 500
#: Languages whose trees share tables; further ones have tables of their own, so all are learned and the size of a
#: model is in proportion to its languages.
LANGUAGES_AT_ONCE = 8
#: Words longer than this many bytes, as of scripts without spaces, are counted and coded by pieces.
PIECE_BYTES = 64
#: Marks a piece's side that is not the word's end; no word has this byte.
_CUT = b"\t"
#: Numbers in an array while words are coded, about.
_POSITIONS = 1 << 18

_LETTER = regex.compile(r"\p{L}")


def keys_of(words: list[bytes], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For words after a space each: (word's index, keys, bytes before) of all their bytes, the space that ends a word
    included; keys[k] packs a byte after k others, nine bits each, so keys of different orders differ.

    Key k is valid only where k bytes stand before the byte, in the word or as the space before it; it is 0 elsewhere.
    """
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1  # each word with the space after it, which it codes too
    word = np.repeat(np.arange(len(words)), n)
    depth = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + 1  # bytes before, the first space included
    keys = [joined[1:] + np.uint64(1)]
    for k in range(1, order + 1):
        back = joined[:-1] if k == 1 else np.concatenate([np.zeros(k - 1, np.uint64), joined[:-k]])[: len(joined) - 1]
        keys.append(np.where(depth >= k, keys[-1] + ((back + np.uint64(1)) << np.uint64(9 * k)), 0))
    return word, keys, depth


def pieces_of(word: bytes, order: int) -> list[bytes]:
    """A word as pieces of about ``PIECE_BYTES``. Each after the first repeats ``order`` bytes as context only."""
    if len(word) <= PIECE_BYTES:
        return [word]
    step = max(1, PIECE_BYTES - order)
    cuts = [*range(order + step, len(word), step), len(word)]
    return [(_CUT + word[a - order : b] if a else word[:b]) + (_CUT if b < len(word) else b"") for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def keys_of_pieces(pieces: list[bytes], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """``keys_of`` for the bytes that pieces of words stand for: over all pieces of a word, those of the whole word."""
    if not any(_CUT in x for x in pieces):
        return keys_of(pieces, order)
    word, keys, depth = keys_of([x.strip(_CUT) for x in pieces], order)
    after = np.array([x.startswith(_CUT) for x in pieces], bool)[word]
    open_ = np.array([x.endswith(_CUT) for x in pieces], bool)[word]
    last = np.append(word[1:] != word[:-1], True)
    coded = ~(after & (depth <= order)) & ~(open_ & last)
    return word[coded], [k[coded] for k in keys], depth[coded]


def portions(words: list[bytes], order: int, most: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(index of its word, piece) of all words' pieces, so many that they have about ``most`` bytes together."""
    owners, pieces, size = [], [], 0
    for i, word in enumerate(words):
        for x in pieces_of(word, order):
            owners.append(i)
            pieces.append(x)
            size += len(x) + 1
            if size >= most:
                yield np.array(owners), pieces
                owners, pieces, size = [], [], 0
    if pieces:
        yield np.array(owners), pieces


# --- counting ---------------------------------------------------------------------------------------------------------


def gram_counts(words: list[bytes], counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all orders in words or pieces that occur so often, once each, and how often each occurs."""
    at, keys, _ = keys_of_pieces(words, order)
    weight = np.asarray(counts, np.float64)[at]
    grams, totals = [], []
    for key in keys:
        found, number = np.unique(key, return_inverse=True)
        n = np.bincount(number, weight, len(found)).astype(np.int64)
        seen = (found != 0) & (n > 0)
        grams.append(found[seen])
        totals.append(n[seen])
    return np.concatenate(grams), np.concatenate(totals)


def split_words(text: bytes) -> list[bytes]:
    return text.lower().split()


def count_grams(key: str, order: int):
    """(key, gram, n) of each task's texts, from columns ``key`` (int) and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        for batch in batches:
            labels = batch[key].to_pylist()
            for i, j, docs in _shared.slices(batch["text"]):
                counts: dict[int, Counter] = {}
                for label, text in zip(labels[i:j], docs, strict=True):
                    counts.setdefault(label, Counter()).update(split_words(text))
                for label, words in counts.items():
                    n = np.fromiter(words.values(), np.int64, len(words))
                    for owners, pieces in portions(list(words), order, 1 << 20):
                        grams, totals = gram_counts(pieces, n[owners], order)
                        yield pa.RecordBatch.from_arrays([pa.array([label] * len(grams), pa.int32()), pa.array(grams.view(np.int64)), pa.array(totals)], [key, "gram", "n"])

    return run


def counted_grams(sample: DataFrame, key: str, order: int) -> DataFrame:
    """(key, gram, n): how often each gram of each order up to ``order`` occurs in the texts of each key. A sample's rows
    are few, so they are dealt out anew: tasks with many texts give fewer partial counts."""
    rows = sample.select(key, "text").repartition(8).mapInArrow(count_grams(key, order), f"{key} int, gram long, n long")
    return rows.groupBy(key, "gram").agg(F.sum("n").alias("n"))


# --- trees ------------------------------------------------------------------------------------------------------------


class ContextTrees:
    """Frozen trees of some languages: for each order its grams and contexts, with the bits of each gram and each escape."""

    def __init__(self, words: list[bytes], counts: np.ndarray, languages: list[str], order: int = ORDER):
        """``counts``: a row for each word or piece, of its counts in each language."""
        parts = [gram_counts(words, counts[:, k], order) for k in range(len(languages))]
        self._build(np.concatenate([g for g, _ in parts]), np.repeat(np.arange(len(parts)), [len(g) for g, _ in parts]), np.concatenate([n for _, n in parts]), languages, order)

    @classmethod
    def of_grams(cls, grams: np.ndarray, language: np.ndarray, n: np.ndarray, languages: list[str], order: int = ORDER) -> ContextTrees:
        """From the counts of grams, a row for each gram and language that has it."""
        self = cls.__new__(cls)
        self._build(grams, language, n, languages, order)
        return self

    def _build(self, grams: np.ndarray, language: np.ndarray, n: np.ndarray, languages: list[str], order: int) -> None:
        self.languages, self.order, self.id = languages, order, uuid.uuid4().hex
        self.grams, self.bits, self.contexts, self.escape = [], [], [], []
        for k in range(order + 1):
            own = np.flatnonzero((grams >> np.uint64(9 * k) != 0) & (grams >> np.uint64(9 * (k + 1)) == 0))
            known, row = np.unique(grams[own], return_inverse=True)
            seen = np.zeros((len(known), len(languages)))
            seen[row, language[own]] = n[own]
            # A context of k bytes is the k-gram that ends before the byte: its row is found with that gram's key.
            contexts, above = np.unique(known >> np.uint64(9), return_inverse=True)
            total, distinct = (np.stack([np.bincount(above, x[:, lang], len(contexts)) for lang in range(len(languages))], axis=1) for x in (seen, seen > 0))
            with np.errstate(divide="ignore", invalid="ignore"):
                mass = np.log2(total + distinct)
                self.bits.append(np.where(seen > 0, mass[above] - np.log2(seen), np.inf).astype(np.float32))
                # A context that a language has not seen costs it nothing: the coder starts from a known one.
                self.escape.append(np.where(total > 0, mass - np.log2(distinct), 0).astype(np.float32))
            self.grams.append(known)
            self.contexts.append(contexts)

    def cost(self, words: list[bytes]) -> np.ndarray:
        """Bits of each word in each language."""
        total = np.zeros((len(words), len(self.languages)), np.float32)
        for owners, pieces in portions(words, self.order, max(1024, _POSITIONS // len(self.languages))):
            at, bits = self._coded(pieces)
            for lang in range(len(self.languages)):
                total[:, lang] += np.bincount(owners[at], bits[:, lang], len(words))
        return total

    def _coded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each byte the index of its piece, and its bits in each language."""
        at, keys, _ = keys_of_pieces(pieces, self.order)
        out = np.zeros((len(at), len(self.languages)), np.float32)
        open_ = np.ones(out.shape, bool)
        for k in range(self.order, -1, -1):
            key = keys[k]
            if not len(self.grams[k]):
                continue
            row = np.minimum(np.searchsorted(self.grams[k], key), len(self.grams[k]) - 1)
            known = (self.grams[k][row] == key) & (key != 0)
            bits = np.where(known[:, None], self.bits[k][row], np.inf)
            row = np.minimum(np.searchsorted(self.contexts[k], key >> np.uint64(9)), len(self.contexts[k]) - 1)
            here = (self.contexts[k][row] == key >> np.uint64(9)) & (key != 0)
            escape = np.where(here[:, None], self.escape[k][row], 0)
            done = open_ & np.isfinite(bits)
            out += np.where(open_, np.where(done, bits, escape), 0)
            open_ &= ~done
        out += np.where(open_, np.float32(np.log2(257)), 0)
        return at, out


class Languages:
    """Trees of any number of languages. What a text costs in one does not depend on the others of its trees."""

    def __init__(self, trees: list[ContextTrees]):
        self.trees, self.id = trees, uuid.uuid4().hex
        self.languages = [x for t in trees for x in t.languages]

    def cost(self, words: list[bytes]) -> np.ndarray:
        """Bits of each word in each language."""
        return np.concatenate([t.cost(words) for t in self.trees], axis=1)


def fit(docs: DataFrame, order: int = ORDER) -> Languages | None:
    """Trees of the languages in ``docs`` (text, lang); rows without text or lang teach nothing, rows that repeat teach
    as often as they stand there. None if no row teaches."""
    spark = docs.sparkSession
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = known.groupBy("lang").count().orderBy("lang").collect()  # a row for each language
    if not sizes:
        return None
    names = [r["lang"] for r in sizes]
    most = spark.createDataFrame([(k, r["lang"], int((1 << 30) * min(1.0, FIT_DOCUMENTS / r["count"]))) for k, r in enumerate(sizes)], "language int, of_lang string, most long")
    chosen = known.join(F.broadcast(most), (F.col("lang") == F.col("of_lang")) & (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("most")))
    counted = counted_grams(chosen, "language", order)
    if len(names) > LANGUAGES_AT_ONCE:
        counted = _shared.cut(counted)
    trees = []
    for i in range(0, len(names), LANGUAGES_AT_ONCE):
        languages = names[i : i + LANGUAGES_AT_ONCE]
        # Some hundred thousand numbers a language: the distinct grams of a sample of bounded rows.
        rows = counted.where(F.col("language").between(i, i + len(languages) - 1)).toArrow()
        if rows.num_rows:
            trees.append(ContextTrees.of_grams(rows["gram"].to_numpy().view(np.uint64), rows["language"].to_numpy() - i, rows["n"].to_numpy(), languages, order))
    return Languages(trees) if trees else None


# --- decisions --------------------------------------------------------------------------------------------------------


def _judge(trees: Languages, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each text's language, ``und`` without letters, and the winner's share, 0 for ``und``."""
    seen = _shared.per_worker(f"ppm:{trees.id}", lambda: _shared.WordTable(trees.cost, len(trees.languages)))
    words = [split_words(x) for x in texts]
    n = np.array([len(w) for w in words])
    bits = np.zeros((len(texts), len(trees.languages)))
    costs = seen.look_up([w for ws in words for w in ws])
    if len(costs):
        full = np.flatnonzero(n)
        bits[full] = np.add.reduceat(costs, (np.cumsum(n) - n)[full], axis=0, dtype=np.float64)
    # The share of the winner if languages were equally likely, at the text's mean bits a word times eight words at
    # most: bits of one text's words are far from independent.
    apart = (bits - bits.min(axis=1, keepdims=True)) / np.maximum(n, 1)[:, None] * np.clip(n, 1, 8)[:, None]
    share = 1 / np.exp2(-np.minimum(apart, 1000)).sum(axis=1)
    und = np.array([_LETTER.search(x.decode("utf-8", "replace")) is None for x in texts], bool)
    names = np.array(trees.languages, object)[bits.argmin(axis=1)]
    names[und] = "und"
    return names, np.where(und, 0.0, share)


def _slices(model: Languages, column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Stretches of texts whose words' values take a bounded room, however many languages there are."""
    return _shared.slices(column, (1 << 20) * 8 // max(8, len(model.languages)))


def _classify(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, docs in _slices(model.value, batch["text"]):
                names, share = _judge(model.value, docs)
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(i, j - i) for c in batch.schema.names if c != "text"), pa.array(names, pa.string()), pa.array(share)], [*(c for c in batch.schema.names if c != "text"), "lang_pred", "score"])

    return run


def _unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(["und"] * batch.num_rows), pa.array([0.0] * batch.num_rows)], [*kept, "lang_pred", "score"])


def identify(docs: DataFrame, model: Languages | None) -> DataFrame:
    """(doc_id, lang_pred, score) for each row's whole text: the learned language of the shortest code and its share.

    ``und`` and score 0 where the text is null or has no letter, and everywhere if no language was learned. Ties go to
    the language that sorts first. Other columns are ignored; rows repeated or without doc_id keep their places.
    """
    given = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(given.dtypes)["doc_id"]
    run = _classify(_shared.share(docs.sparkSession, model)) if model else _unknown
    return given.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def _kept(model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, docs in _slices(model.value, batch["text"]):
                names, share = _judge(model.value, docs)
                yield batch.slice(i, j - i).filter(pa.array((names != "und") & (share >= least)))

    return run


def keep(docs: DataFrame, model: Languages | None, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, that have letters and a best language of at least this share; all of them
    without a model."""
    return docs.mapInArrow(_kept(_shared.share(docs.sparkSession, model), least), docs.schema) if model else docs
