"""Toxicity by multiple-instance learning: documents carry the labels, sentences the scores.

A sentence has a logistic score over words and pieces of words; the score of a document is the noisy-or of its sentences
and of a small leak, ``1 - (1 - leak) * product(1 - score of a sentence)``. Only documents are labelled, so the weights are
trained through the noisy-or, and the sentence scores they leave tell which sentences offend. Sentences without any learned
feature score zero, which keeps long clean texts clean.

The classifier is fitted on at most ``SAMPLE`` labelled rows, those of least seeded hash. Features are chosen by counts
over that sample, made in Spark; what the driver holds is bounded by the sample and by ``FEATURES``. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_arrow, slices
from gridloom.sources.scratch import written

#: Most labelled rows that the classifier is fitted on.
SAMPLE = 20_000
#: Most features, and in how many toxic documents of the sample one has to occur.
FEATURES, LEAST_DOCUMENTS = 512, 3
#: A feature has to be so many times as frequent in toxic documents as in others.
LEAST_RATIO = 4.0
#: Counts a task holds before it hands them on.
HELD_COUNTS = 150_000
#: Letters of a piece of a word, marks for its start and end included.
PIECE = 5
#: Steps, step size and penalty of the fit.
STEPS, RATE, PENALTY = 400, 0.1, 2e-4
_WORD = re.compile(r"[^\W\d_]+")
_OTHER = re.compile(r"[\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features_of(words: Iterable[str]) -> set[str]:
    """Each word between marks, and every piece of it."""
    found = set()
    for word in words:
        marked = f"^{word}$"
        found.add(marked)
        found.update(marked[i : i + PIECE] for i in range(len(marked) - PIECE + 1))
    return found


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each run of characters without a full stop, exclamation or question mark, or line end."""
    return [m.span() for m in _SENTENCE.finditer(text)]


@dataclass(frozen=True)
class Model:
    """Features with their weights, the bias of a sentence that has one, and the leak of a document."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    leak: float

    def scorer(self) -> _Scorer:
        return _Scorer(self)


class _Scorer:
    def __init__(self, model: Model):
        self.model, self.find = model, None
        if model.features:
            self.find = ahocorasick.Automaton()
            for feature, weight in zip(model.features, model.weights):
                self.find.add_word(feature, (feature, weight))
            self.find.make_automaton()

    def marked(self, text: str) -> str:
        return "^" + _OTHER.sub("$^", text.lower()) + "$"

    def sentence(self, text: str) -> float:
        """Score of a sentence; features count once."""
        found = dict(value for _, value in self.find.iter(self.marked(text)))
        return float(1 / (1 + np.exp(-(self.model.bias + sum(found.values()))))) if found else 0.0

    def document(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of the document, and its sentences (start, end, score) that have a feature."""
        scored = []
        if self.find is not None and next(self.find.iter(self.marked(text)), None) is not None:
            scored = [(a, b, s) for a, b in sentences(text) if (s := self.sentence(text[a:b])) > 0]
        return 1 - (1 - self.model.leak) * float(np.prod([1 - s for *_, s in scored])), scored


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column, most: int) -> DataFrame:
    """``text, label`` of at most ``most`` documents with a label for which ``train`` (of the id) holds."""
    one = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64(id_col, F.lit(17)), id_col).limit(most)  # bounded, hence broadcast
    return docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), id_col).select("text", "label")


def choose_features(sample: DataFrame, most: int = FEATURES, least: int = LEAST_DOCUMENTS) -> list[str]:
    """Features most tied to toxic documents, by counts of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def counted() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts[::-1])], ["feature", "toxic", "clean"])
            for c in counts:
                c.clear()
            return batch

        for batch in slices(batches, 0):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[1 if label else 0].update(features_of(set(_WORD.findall(text.lower()))))
                if len(counts[0]) + len(counts[1]) > HELD_COUNTS:
                    yield counted()
        yield counted()

    counted = map_arrow(sample, count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n_toxic, n_all = sample.agg(F.sum((F.col("label") > 0).cast("int")), F.count("*")).first()
    if not n_toxic:
        return []
    n_clean = max(1, n_all - n_toxic)
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    expected = (F.col("toxic") + F.col("clean")) * (n_toxic / n_all)
    tied = counted.where((F.col("toxic") >= least) & (ratio >= LEAST_RATIO)).withColumn("z", (F.col("toxic") - expected) / F.sqrt(expected + 1))
    return [r.feature for r in tied.orderBy(F.desc("z"), "feature").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train: Column | None = None, most: int = SAMPLE) -> Model:
    """The model for the labelled documents for whose id ``train`` holds. Without toxic ones all scores are the leak."""
    sample = written(labelled_sample(docs, labels, id_col, text_col, label_col, F.lit(True) if train is None else train, most), "labelled")
    features = choose_features(sample)
    place = {f: i for i, f in enumerate(features)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Model(tuple(features), (0.0,) * len(features), 0.0, 0.0).scorer()
        for batch in slices(batches, 0):
            bags, times = [], []
            for text in batch.column(0).to_pylist():
                own = Counter()
                if finder.find is not None and next(finder.find.iter(finder.marked(text)), None) is not None:
                    for a, b in sentences(text):
                        found = {place[f] for _, (f, _) in finder.find.iter(finder.marked(text[a:b]))}
                        if found:
                            own[tuple(sorted(found))] += 1
                bags.append([list(s) for s in own])
                times.append(list(own.values()))
            columns = [batch.column(1), pa.array(bags, pa.list_(pa.list_(pa.int32()))), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "bag", "times"])

    bags = map_arrow(sample, encode, "label int, bag array<array<int>>, times array<int>")
    with_some = bags.where(F.size("bag") > 0).collect()
    rest = {r.label: r["count"] for r in bags.where(F.size("bag") == 0).groupBy("label").count().collect()}
    n_none, toxic_none = sum(rest.values()), sum(v for k, v in rest.items() if k)
    leak = (toxic_none + 0.5) / (n_none + 50)
    labels_of = np.array([1.0 if r.label else 0.0 for r in with_some])
    weights, bias = train_noisy_or([r.bag for r in with_some], labels_of, len(features), leak, times=[r.times for r in with_some])
    return Model(tuple(features), tuple(weights.tolist()), bias, leak)


def train_noisy_or(bags: list[list[list[int]]], labels: np.ndarray, n_features: int, leak: float, steps: int = STEPS, times: list[list[int]] | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of the sentence score, by gradient steps (Adam) on the likelihood of the documents' labels.

    ``times`` says how many sentences of its document each entry of a bag stands for; without it, one.
    """
    theta = np.zeros(n_features + 1)
    theta[-1] = -1.0
    if not bags:
        return theta[:-1], float(theta[-1])
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    often = np.ones(len(doc)) if times is None else np.array([n for own in times for n in own], float)
    lengths = [len(s) for b in bags for s in b]
    sentence, feature = np.repeat(np.arange(len(doc)), lengths), np.array([f for b in bags for s in b for f in s])
    first = second = 0.0
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence, theta[feature], len(doc))
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_clean = np.log1p(-leak) - np.bincount(doc, often * np.logaddexp(0, z), len(bags))
        clean = np.minimum(np.exp(log_clean), 1 - 1e-9)
        slope = ((1 - labels) - labels * clean / (1 - clean))[doc] * -score * often  # of the log-likelihood, by z
        up = np.append(np.bincount(feature, slope[sentence], n_features), slope.sum()) / len(bags)
        up[:-1] -= PENALTY * theta[:-1]
        first, second = 0.9 * first + 0.1 * up, 0.99 * second + 0.01 * up * up
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """``id_col, score, predicted, offending`` and the columns named in ``keep``, with ``keep_text`` the text as it came, a row per
    row, without a shuffle.

    ``offending`` lists start, end and score of the sentences that score ``threshold`` or more. A null or empty text scores
    the leak. Ids, null or repeated, come back as they are; columns not named are dropped.
    """
    kept = [F.struct(*keep).alias("_kept")] if keep else []
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), *kept)
    more = (["_text"] if keep_text else []) + (["_kept"] if keep else [])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in slices(batches, 1):
            scores, spans = zip(*(scorer.document(text or "") for text in batch.column(1).to_pylist()))
            columns = [
                batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                pa.array([[{"start": a, "end": b, "score": s} for a, b, s in found if s >= threshold] for found in spans], pa.list_(span)),
            ]
            columns += [batch.column(batch.schema.get_field_index(c)) for c in more]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "score", "predicted", "offending", *more])

    schema = "_id long, score double, predicted int, offending array<struct<start:int,end:int,score:double>>"
    schema += "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in more)
    return map_arrow(source, run, schema).select(
        F.col("_id").alias(id_col), "score", "predicted", "offending", *([F.col("_text").alias(text_col)] if keep_text else []), *(["_kept.*"] if keep else []),
    )
