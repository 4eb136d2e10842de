"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic if at least one of its sentences is, so sentence scores are combined by noisy-or, and the weights
are those under which the documents' labels are likeliest. The learned sentence scores then say where the toxic
sentences lie. Features are character n-grams of words, so that inflected and compound forms share them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import textbytes
from tillmark.llm.rows import held_out

#: Labelled documents of each label that the model learns from, about (a hash of the id below a threshold chooses them).
TRAINING_DOCUMENTS = 4000

#: Tasks that count features of those documents; fixed, as the sample is.
TRAINING_TASKS = 8

#: Lengths (in bytes, word boundary marks included) of the n-grams of words and the buckets they are hashed into.
WIDTHS = (4, 5, 6)
BUCKETS = 1 << 18

#: N-grams that the model has weights for: those that toxic documents have most in excess.
FEATURES = 512

#: Sentences at least this likely to be toxic are returned as offending.
OFFENDING = 0.5

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True

SCORED = "doc_id long, score double"
SENTENCES = "offending array<struct<start: long, end: long, score: double>>"


@dataclass(frozen=True)
class Model:
    """The weight of each bucket (0 for most) and the score of a sentence without any feature, as log-odds."""

    weights: np.ndarray
    bias: float


@dataclass
class Sentences:
    start: np.ndarray
    end: np.ndarray
    first_sentence: np.ndarray
    first_word: np.ndarray
    distinct: textbytes.Distinct


def read_sentences(data: np.ndarray, first: np.ndarray) -> Sentences:
    """Sentences that have a word: they end after ``.``, ``!``, ``?`` or a line feed, or with the document."""
    start, end, _ = textbytes.words(data, first)
    # A word may hold the end of a sentence; it belongs to the sentence it begins in.
    border = np.union1d(first[:-1], np.flatnonzero(_ENDS[data]) + 1)
    border = border[border < len(data)]
    after = np.append(border, len(data))[1:]
    at = np.searchsorted(start, border)
    some = np.searchsorted(start, after) > at
    border, after, at = border[some], after[some], at[some]
    document = np.searchsorted(first, border, "right") - 1
    lowered = textbytes.LOWER[data]
    distinct = textbytes.Distinct(lowered, start, end, textbytes.Hasher(lowered)(start, end))
    return Sentences(
        border,
        after,
        np.searchsorted(document, np.arange(len(first))),
        np.append(at, len(start)),
        distinct,
    )


def _features(sentences: Sentences) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and distinct word of every n-gram of the distinct words."""
    grams = [sentences.distinct.grams(width, BUCKETS) for width in WIDTHS]
    return np.concatenate([g[0] for g in grams]), np.concatenate([g[1] for g in grams])


def _sentence_scores(sentences: Sentences, model: Model) -> np.ndarray:
    """Log-odds of each sentence."""
    bucket, word = _features(sentences)
    weight = np.bincount(word, model.weights[bucket], len(sentences.distinct.hashes))[sentences.distinct.inverse]
    total = np.concatenate([[0.0], np.cumsum(weight)])
    return model.bias + total[sentences.first_word[1:]] - total[sentences.first_word[:-1]]


def _soft_plus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _fit(
    first: np.ndarray, columns: np.ndarray, sentence: np.ndarray, toxic: np.ndarray, weight: np.ndarray, n_features: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that make the labels likeliest under noisy-or, by Adam steps.

    ``first`` says where each document's sentences begin; ``columns`` are the features of ``sentence``.
    """
    parameters = np.zeros(n_features + 1)
    parameters[-1] = -4.0
    moment, square = np.zeros_like(parameters), np.zeros_like(parameters)
    n = int(first[-1])
    document = textbytes.owner(first)
    for step in range(1, 301):
        z = parameters[-1] + np.bincount(sentence, parameters[columns], n)
        # The chance that no sentence is toxic is exp(-none).
        none = np.bincount(document, _soft_plus(z), len(toxic))
        pull = np.where(toxic, np.exp(-none) / np.maximum(-np.expm1(-none), 1e-12), -1.0) * weight
        slope = pull[document] * np.exp(-_soft_plus(-z))
        gradient = np.append(np.bincount(columns, slope[sentence], n_features), slope.sum())
        gradient[:-1] -= 0.3 * parameters[:-1]
        gradient /= max(1, len(toxic))
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        parameters += 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return parameters[:-1], float(parameters[-1])


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAINING_DOCUMENTS) -> Model:
    """Learn from the texts of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) outside the held-out fold.

    About ``per_label`` documents of each label are used, and weighted so that each label counts as it is frequent.
    Rows with a NULL in any of these columns teach nothing; a doc_id labelled more than once counts as toxic if any
    label says so. Where one label is missing, every sentence scores close to 0.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model(np.zeros(BUCKETS), -20.0)
    steps = 1 << 20
    rate = {label: min(1.0, per_label / total) for label, total in totals.items()}
    threshold = F.when(F.col("toxic") == 1, F.lit(int(rate[1] * steps))).otherwise(F.lit(int(rate[0] * steps)))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < threshold)
    # Bounded: an id and a label for each document of the sample.
    sample = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    sample = sample.select("text", "toxic")
    sample = sample.repartition(TRAINING_TASKS).persist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for at, end, data, first in textbytes.blocks(batch.column("text")):
                sentences = read_sentences(data, first)
                bucket, word = _features(sentences)
                order = np.argsort(word, kind="stable")
                bucket = bucket[order]
                of_word = np.searchsorted(word[order], np.arange(len(sentences.distinct.hashes) + 1))
                words_of = sentences.first_word[sentences.first_sentence]
                for d in range(end - at):
                    own = np.unique(sentences.distinct.inverse[words_of[d] : words_of[d + 1]])
                    if len(own):
                        present = np.unique(np.concatenate([bucket[of_word[w] : of_word[w + 1]] for w in own]))
                        counts[int(toxic[at + d] == 1), present] += 1
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], ["counts"])

    # TRAINING_TASKS rows of a fixed size.
    counts = sum(
        np.frombuffer(row["counts"], np.int64).reshape(2, BUCKETS)
        for row in sample.mapInArrow(count, "counts binary").collect()
    )
    n = {label: max(1, round(rate[label] * totals[label])) for label in (0, 1)}
    share = {label: (counts[label] + 0.5) / (n[label] + 1) for label in (0, 1)}
    excess = (share[1] - share[0]) / np.sqrt(share[1] * (1 - share[1]) / n[1] + share[0] * (1 - share[0]) / n[0] + 1e-9)
    features = np.sort(np.argsort(-excess, kind="stable")[:FEATURES])
    features = features[excess[features] > 2]
    column = np.full(BUCKETS, -1, np.int32)
    column[features] = np.arange(len(features))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for at, end, data, first in textbytes.blocks(batch.column("text")):
                sentences = read_sentences(data, first)
                bucket, word = _features(sentences)
                chosen = column[bucket] >= 0
                order = np.argsort(word[chosen], kind="stable")
                bucket, word = column[bucket[chosen][order]], word[chosen][order]
                of_word = np.searchsorted(word, np.arange(len(sentences.distinct.hashes) + 1))
                some = np.diff(of_word) > 0
                sentence_of = textbytes.owner(sentences.first_word)
                rows = []
                words_of = sentences.first_word[sentences.first_sentence]
                for d in range(end - at):
                    here = np.arange(words_of[d], words_of[d + 1])
                    here = here[some[sentences.distinct.inverse[here]]]
                    found, where = [], []
                    for w in here:
                        own = bucket[of_word[sentences.distinct.inverse[w]] : of_word[sentences.distinct.inverse[w] + 1]]
                        found.append(own)
                        where.append(np.full(len(own), sentence_of[w] - sentences.first_sentence[d], np.int32))
                    packed = [np.concatenate(x).astype(np.int32).tobytes() if x else b"" for x in (found, where)]
                    n_sentences = int(sentences.first_sentence[d + 1] - sentences.first_sentence[d])
                    rows.append((*packed, n_sentences, int(toxic[at + d])))
                names = ["columns", "sentence", "n_sentences", "toxic"]
                kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(4)], names)

    # A bounded sample again: a few numbers for each sentence of about 2 * per_label documents.
    rows = sample.mapInArrow(collect, "columns binary, sentence binary, n_sentences int, toxic int").collect()
    sample.unpersist()
    first = np.concatenate([[0], np.cumsum([row["n_sentences"] for row in rows])])
    columns = np.concatenate([np.frombuffer(row["columns"], np.int32) for row in rows])
    where = [np.frombuffer(row["sentence"], np.int32) + at for row, at in zip(rows, first[:-1], strict=True)]
    toxic = np.array([row["toxic"] == 1 for row in rows])
    weight = np.where(toxic, 1 / rate[1], 1 / rate[0])
    learned, bias = _fit(first, columns, np.concatenate(where), toxic, weight / weight.mean(), len(features))
    weights = np.zeros(BUCKETS)
    weights[features] = learned
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, offending: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and score, the chance that a sentence of it is toxic.

    With ``offending`` also the byte ranges of sentences that are likelier toxic than not, with their scores. NULL and
    empty texts have no sentence and score 0. Ids may be NULL, rows may repeat, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, first in textbytes.blocks(batch.column("text")):
                sentences, n = read_sentences(data, first), end - at
                z = _sentence_scores(sentences, shared.value)
                document = textbytes.owner(sentences.first_sentence)
                scores = -np.expm1(-np.bincount(document, _soft_plus(z), n))
                columns, names = [batch.column("doc_id").slice(at, n), pa.array(scores)], ["doc_id", "score"]
                if offending:
                    chance = np.exp(-_soft_plus(-z))
                    listed: list[list[dict]] = [[] for _ in range(n)]
                    for s in np.flatnonzero(chance >= OFFENDING):
                        d = document[s]
                        span = {"start": sentences.start[s] - first[d], "end": sentences.end[s] - first[d]}
                        listed[d].append(span | {"score": chance[s]})
                    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
                    columns, names = [*columns, pa.array(listed, pa.list_(kind))], [*names, "offending"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"{SCORED}, {SENTENCES}" if offending else SCORED
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
