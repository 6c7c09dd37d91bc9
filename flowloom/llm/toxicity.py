"""Toxicity of texts after noisy-channel deobfuscation.

Suspect stretches (letters mixed with look-alike digits and signs, letters repeated three times or
more, letters spelled with separators) become character lattices.  Viterbi decoding under a character
language model of the whole corpus picks the most likely reading.  Words and word beginnings of the
original and the restored text are then scored by a model learned from labelled documents.

Defined cases: null and empty texts have no words and get the model's base score; documents without
labels are scored like all others; repeated rows score alike; a null id is not held out; without
labels of both kinds every score is the share of label 1 (0 without labels); an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.sized import keep
from flowloom.llm.shingles import text_groups

# Readings of signs that stand for letters.  Fixed values.
LOOK_ALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou",
}
#: Symbols of the language model: 0 a boundary, 1-26 a-z, 27 any other letter.
SYMBOLS = 28
CONTEXTS = SYMBOLS**3
#: Log probabilities of the channel: a sign for a letter, a stretched letter, a separator inside a word.
SIGN, STRETCH, GAP = math.log(0.3), math.log(0.5), math.log(0.5)

_SIGNS = re.escape("".join(LOOK_ALIKE))
#: Letters spelled one by one.
SPELLED = re.compile(r"(?<![a-z])[a-z](?:[ ._\-*]{1,2}[a-z]){2,}(?![a-z])")
#: What makes a run of letters and signs suspect: signs before a letter, a letter three times.
ODD = re.compile(rf"[{_SIGNS}]+[a-z]|([a-z])\1\1")
LETTERS, RUN_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyz"), frozenset(LOOK_ALIKE)
WORD = re.compile(r"[^\W\d_]+")

_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[0xC3:0xF5] = 27
_DROP = np.zeros(256, dtype=bool)
_DROP[0x80:0xC0] = True


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four-symbol sequences, summed over the batches of a task."""
    total = np.zeros(SYMBOLS**4, dtype=np.int64)
    for batch in batches:
        for _, data, offsets in text_groups(batch.column("text")):
            joined = np.insert(data, offsets[1:-1], 32) if len(offsets) > 2 else data
            codes = _CODE[joined[~_DROP[joined]]]
            codes = np.concatenate([[0, 0, 0], codes, [0]])
            total += np.bincount(((codes[:-3] * SYMBOLS + codes[1:-2]) * SYMBOLS + codes[2:-1]) * SYMBOLS + codes[3:], minlength=SYMBOLS**4)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"])


def language_model(documents: DataFrame, weight: float = 5.0) -> np.ndarray:
    """Log probability of a symbol after three others, from the counts of all documents.

    The table has ``SYMBOLS ** 4`` cells whatever the corpus size, which bounds what is collected and sent out.
    """
    counted = documents.select("text").mapInArrow(_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**4)
    counts[counted["gram"].to_numpy()] = counted["n"].to_numpy()
    counts = counts.reshape((SYMBOLS,) * 4)
    chance = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, 5):
        here = counts.sum(axis=tuple(range(4 - order)))
        chance = (here + weight * chance) / (here.sum(axis=-1, keepdims=True) + weight)
    return np.log(chance).astype(np.float32).ravel()


def stretches(lowered: str) -> list[tuple[int, int]]:
    """Places of the suspect stretches of a text, in order and apart.

    A spelled stretch, or a whole run of letters and signs in which a sign stands before a letter or a
    letter stands three times.
    """
    out = [m.span() for m in SPELLED.finditer(lowered)] if SPELLED.search(lowered) else []
    spelled, done, n = len(out), 0, len(lowered)
    for m in ODD.finditer(lowered):
        a, b = m.span()
        if a < done:
            continue
        while a and (lowered[a - 1] in LETTERS or lowered[a - 1] in RUN_SIGNS):
            a -= 1
        while b < n and (lowered[b] in LETTERS or lowered[b] in RUN_SIGNS):
            b += 1
        done = b
        out.append((a, b))
    if spelled:
        out.sort()
        out = [x for k, x in enumerate(out) if not k or x[0] >= max(y[1] for y in out[max(0, k - 3) : k])]
    return out


def _symbol(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 0


class Restorer:
    """Reads suspect stretches of lower-cased text under a language model."""

    def __init__(self, model: np.ndarray, cached: int = 200_000) -> None:
        self.model = model
        self.read = functools.lru_cache(cached)(self._read)
        self.dull: set[str] = set()

    def lattice(self, stretch: str) -> list[list[tuple[str, float]]]:
        """Per position the readings and their log probability."""
        spelled = re.fullmatch(r"[a-z](?:[ ._\-*]{1,2}[a-z]){2,}", stretch)
        out: list[list[tuple[str, float]]] = []
        for run in re.finditer(r"(.)\1*", stretch, re.S):
            char, n = run[1], len(run[0])
            if spelled and not char.isalpha():
                out.append([("", 0.0), (" ", GAP)])
            elif char.isalpha() and n >= 3:
                out.append([(char, STRETCH), (char * 2, STRETCH)])
            elif char in LOOK_ALIKE:
                out += [[(char, 0.0), *((c, SIGN) for c in LOOK_ALIKE[char])]] * n
            else:
                out += [[(char, 0.0)]] * n
        return out

    def _read(self, stretch: str) -> str:
        best: dict[int, tuple[float, str]] = {0: (0.0, "")}
        model = self.model
        for options in [*self.lattice(stretch), [(" ", 0.0)]]:
            after: dict[int, tuple[float, str]] = {}
            for state, (score, text) in best.items():
                for reading, cost in options:
                    to, value = state, score + cost
                    for char in reading:
                        cell = to * SYMBOLS + _symbol(char)
                        value += float(model[cell])
                        to = cell % CONTEXTS
                    if to not in after or value > after[to][0]:
                        after[to] = (value, text + reading)
            best = after
        return max(best.values())[1].rstrip(" ")

    def restored(self, lowered: str) -> list[str]:
        """Readings of the suspect stretches of a text."""
        return [self.read(lowered[a:b]) for a, b in stretches(lowered)]

    def restore(self, text: str) -> str:
        """The whole text, lower-cased, with suspect stretches read."""
        lowered, out, at = text.lower(), [], 0
        for a, b in stretches(lowered):
            out += [lowered[at:a], self.read(lowered[a:b])]
            at = b
        return "".join([*out, lowered[at:]])

    def words(self, text: str) -> set[str]:
        """Words of the lower-cased text and of the readings of its suspect stretches."""
        lowered = text.lower()
        words = set(WORD.findall(lowered))
        for reading in self.restored(lowered):
            words.update(WORD.findall(reading))
        return words

    def terms(self, text: str) -> set[str]:
        """Short whole words (ending in ``$``) and word beginnings of text and readings."""
        words = self.words(text)
        out = {w[:4] for w in words}
        out.update([w[:5] for w in words])
        out.update([w + "$" for w in words if len(w) <= 12])
        return out

    def known_terms(self, text: str, known: dict, cached: int = 1_000_000) -> set[str]:
        """The terms of a text that are among ``known``; words without any are remembered."""
        if len(self.dull) > cached:
            self.dull.clear()
        out = set()
        for w in self.words(text) - self.dull:
            found = [t for t in (w[:4], w[:5], w + "$" if len(w) <= 12 else "") if t in known]
            if found:
                out.update(found)
            else:
                self.dull.add(w)
        return out


def deobfuscate(documents: DataFrame, model: np.ndarray) -> DataFrame:
    """``doc_id, restored``: lower-cased whole texts with suspect stretches read; null stays null."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        restorer = Restorer(shared.value)
        for batch in batches:
            texts = [None if t is None else restorer.restore(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "restored"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, "doc_id long, restored string")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


@dataclass
class Model:
    """Counts of the terms worth keeping and the weights of the document features."""

    language: np.ndarray
    n_toxic: int = 0
    n_clean: int = 0
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    base: float = 0.0

    def odds(self, toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
        return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))

    def features(self, terms: set[str], own: int | None = None) -> list[float]:
        """Strongest term, sum of the strongest eight, number of strong terms; ``own`` takes out a training row's own label."""
        t, c = (own == 1), (own == 0)
        found = []
        for term in terms & self.counts.keys():
            toxic, clean = self.counts[term]
            found.append(max(0.0, self.odds(max(0, toxic - t), max(0, clean - c), max(1, self.n_toxic - t), max(1, self.n_clean - c))))
        found.sort(reverse=True)
        return [found[0] if found else 0.0, math.fsum(found[:8]), math.log1p(sum(v > 2 for v in found))]

    def score(self, terms: set[str]) -> float:
        if not self.weights:
            return self.base
        value = self.weights[0] + math.fsum(w * x for w, x in zip(self.weights[1:], self.features(terms), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def training_rows(documents: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``text, toxic`` of at most ``max_rows`` labelled documents that are not held out, chosen by a hash of the id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(keep(known)), "doc_id").select("text", "toxic")


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 40_000, max_terms: int = 20_000, min_z: float = 4.0) -> Model:
    """Fit on a bounded sample of labelled rows; the language model counts all documents.

    ``max_rows`` bounds the labelled rows, ``max_terms`` the terms that are kept (by significance).
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    spark = documents.sparkSession
    model = Model(language_model(documents))
    language = spark.sparkContext.broadcast(model.language)
    rows = training_rows(documents, labels, max_rows)

    def count_terms(batches):
        restorer = Restorer(language.value)
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                side = toxic if label else clean
                side.update(restorer.terms(text or ""))
                side[""] += 1
        terms = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), "t": pa.array([toxic[x] for x in terms], pa.int64()), "c": pa.array([clean[x] for x in terms], pa.int64())})

    counted = keep(rows.mapInArrow(count_terms, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    totals = counted.filter("term = ''").first()
    if totals is None:
        return model
    model.n_toxic, model.n_clean = int(totals["t"]), int(totals["c"])
    model.base = model.n_toxic / (model.n_toxic + model.n_clean)
    if not model.n_toxic or not model.n_clean:
        return model
    odds = F.log((F.col("t") + 0.5) / (model.n_toxic + 1)) - F.log((F.col("c") + 0.5) / (model.n_clean + 1))
    z = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    strong = counted.filter("term <> '' AND t >= 3").withColumn("z", z).filter(F.col("z") >= min_z).orderBy(F.desc("z"), "term").limit(max_terms)
    model.counts = {r["term"]: (r["t"], r["c"]) for r in strong.collect()}
    shared = spark.sparkContext.broadcast(model)

    def featurize(batches):
        restorer = Restorer(shared.value.language)
        for batch in batches:
            labels_here = batch.column("toxic").to_pylist()
            rows_here = [shared.value.features(restorer.known_terms(t or "", shared.value.counts), y) for t, y in zip(batch.column("text").to_pylist(), labels_here, strict=True)]
            yield pa.RecordBatch.from_pydict({"x": pa.array(rows_here, pa.list_(pa.float64())), "label": pa.array([float(y) for y in labels_here], pa.float64())})

    features = keep(rows.mapInArrow(featurize, "x array<double>, label double")).select(array_to_vector("x").alias("features"), "label")
    fitted = LogisticRegression(maxIter=40, regParam=1e-4).fit(features)
    model.weights = [float(fitted.intercept), *map(float, fitted.coefficients)]
    return model


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_hash, score`` per document, from its whole text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        restorer = Restorer(shared.value.language)
        for batch in batches:
            scores = [shared.value.score(restorer.known_terms(t or "", shared.value.counts)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(scores, pa.float64())], names=["doc_id", "text_hash", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, score double")


def report(spark: SparkSession, documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    scored = score_documents(documents, train(documents, labels, **options))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def remove_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The documents, all columns, that score below ``threshold``; rows are dropped where they are scored, nothing is joined."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels, **options))

    def run(batches):
        restorer = Restorer(shared.value.language)
        for batch in batches:
            scores = [shared.value.score(restorer.known_terms(t or "", shared.value.counts)) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([x < threshold for x in scores], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
