"""Language identification: script ranges, per-word scores, and Viterbi with a switching penalty.

Letters are the code points of a Unicode letter category. Words end at white space and where the script changes; in
scripts that are written without spaces they are short runs of code points. The script of a word, read from ranges of code points, leaves
only the languages that are written in it; letters outside of the ranges leave all languages. Those are scored by character n-grams of the word, and the best labelling of a document's words under a penalty for each change
of language gives spans of one language each. A document's language is the one that most of its letters lie in.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import chains, textbytes
from tillmark.llm.decontaminate import UNSPACED
from tillmark.llm.rows import held_out, releasing, slices

#: Documents per language that the model learns from, about (a hash of the id below a threshold chooses them).
TRAINING_DOCUMENTS = 3000

#: Tasks that count n-grams of those documents; fixed, as the sample is.
TRAINING_TASKS = 8

#: Lengths (in bytes) of the n-grams of words and the number of buckets they are hashed into.
WIDTHS = (2, 3, 4)
BUCKETS = 1 << 16

#: What a change of language costs, in units of log-likelihood of words.
SWITCH = 6.0

#: N-grams of a word overlap; their scores are added at this weight.
WEIGHT = 0.5

#: A language is a candidate for words of a script that holds at least this share of its letters in training.
SCRIPT_SHARE = 0.01

#: What a word costs under a language that is not written in its script.
WRONG_SCRIPT = -20.0

UNDETERMINED = "und"

#: Documents in which no language has this share of the letters are a mixture, which filtering drops.
LEAST_SCORE = 0.5

#: Bytes of rows, and of their texts, that are worked on at a time; the work takes about sixty times as much memory.
BATCH_BYTES = 1 << 24
BLOCK_BYTES = 1 << 20

LABELLED = "doc_id long, lang_pred string, score double"
SPANS = "spans array<struct<start: long, end: long, lang: string>>"

#: First and last code point of ranges, by script; what is no letter in them doesn't count.
SCRIPT_RANGES = (
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC0, 0x24F), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)

#: Code points of a word in scripts that are written without spaces.
RUN = 4

#: Stands for all scripts outside of the ranges, so it tells nothing about the language.
OTHER = "other"

SCRIPTS = (*dict.fromkeys(name for name, _, _ in SCRIPT_RANGES), OTHER)

NO_LETTER = 255


@dataclass(frozen=True)
class Model:
    """``scores`` has a row per bucket and a column per language; ``allowed`` a row per script."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray


@functools.cache
def _script_of() -> np.ndarray:
    """The script of each code point that is a letter by its Unicode category, and ``NO_LETTER`` for all others."""
    scripts = np.full(0x110000, SCRIPTS.index(OTHER), np.uint8)
    for name, low, high in SCRIPT_RANGES:
        scripts[low : high + 1] = SCRIPTS.index(name)
    return np.where(textbytes.categories() == ord("L"), scripts, np.uint8(NO_LETTER))


@functools.cache
def _written_in() -> np.ndarray:
    """The script that each letter, or mark in a script's range, is written in; ``NO_LETTER`` for all others."""
    inside = np.zeros(0x110000, bool)
    scripts = _script_of().copy()
    for name, low, high in SCRIPT_RANGES:
        scripts[low : high + 1] = SCRIPTS.index(name)
        inside[low : high + 1] = True
    kind = textbytes.categories()
    return np.where((kind == ord("L")) | inside & (kind == ord("M")), scripts, np.uint8(NO_LETTER))


@functools.cache
def _unspaced() -> np.ndarray:
    """Whether each code point is a letter or mark of a script that is written without spaces."""
    unspaced = np.zeros(0x110000, bool)
    for low, high in UNSPACED:
        unspaced[low : high + 1] = True
    return unspaced & np.isin(textbytes.categories(), np.frombuffer(b"LM", np.uint8))


#: The lowest first byte of code points beyond the Latin letters at the start of Unicode.
_BEYOND_LATIN = 0xCA


def script_cuts(data: np.ndarray) -> np.ndarray:
    """Places before which words end though there is no white space: see the module's text.

    Texts without letters of other scripts than Latin have none and are not looked at letter by letter.
    """
    beyond = np.flatnonzero(data >= _BEYOND_LATIN)
    if not len(beyond) or (_written_in()[textbytes.code_points(data, beyond)] == NO_LETTER).all():
        return np.zeros(0, np.int64)
    start = np.flatnonzero((data & 0xC0) != 0x80)
    points = textbytes.code_points(data, start)
    script, unspaced = _written_in()[points], _unspaced()[points]
    cut = np.zeros(len(start), bool)
    both = (script[1:] != NO_LETTER) & (script[:-1] != NO_LETTER)
    cut[1:] = both & (script[1:] != script[:-1]) | (unspaced[1:] != unspaced[:-1])
    number = np.arange(len(start))
    begin = np.maximum.accumulate(np.where(cut, number, 0))
    return start[cut | unspaced & ((number - begin) % RUN == 0)]


@dataclass
class Words:
    """The words of a block: where they lie, letters of each script in them, and the distinct ones spelled out."""

    start: np.ndarray
    end: np.ndarray
    first_word: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    distinct: textbytes.Distinct


def read_words(data: np.ndarray, first: np.ndarray) -> Words:
    start, end, first_word = textbytes.runs(textbytes.SPACE[data], first, script_cuts(data))
    lowered = textbytes.LOWER[data]
    distinct = textbytes.Distinct(lowered, start, end, textbytes.Hasher(lowered)(start, end))
    # Scripts of the distinct words only; the others repeat them.
    counts = np.zeros((len(distinct.hashes), len(SCRIPTS)), np.int64)
    if len(distinct.spelled):
        place = np.flatnonzero((distinct.spelled & 0xC0) != 0x80)
        of = _script_of()[textbytes.code_points(distinct.spelled, place)]
        letter = of != NO_LETTER
        word = np.searchsorted(distinct.first, place[letter], "right") - 1
        np.add.at(counts, (word, of[letter]), 1)
    letters, script = counts.sum(axis=1), counts.argmax(axis=1)
    return Words(start, end, first_word, letters[distinct.inverse], script[distinct.inverse], distinct)


def train(docs: DataFrame, per_language: int = TRAINING_DOCUMENTS) -> Model:
    """Learn from text and lang of a bounded sample of the rows of ``docs`` (doc_id, text, lang) outside the held-out fold.

    About ``per_language`` documents of each language are used. Rows with a NULL id, text or lang teach nothing. The
    model grows with the number of languages, not with the number of documents.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    totals = known.groupBy("lang").count().collect()
    languages = tuple(sorted(row["lang"] for row in totals))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    steps = 1 << 20
    within = F.create_map(*[
        F.lit(value)
        for row in totals
        for value in (row["lang"], int(min(1.0, per_language / row["count"]) * steps))
    ])
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < within[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = {lang: np.zeros(BUCKETS, np.int64) for lang in languages}
        scripts = {lang: np.zeros(len(SCRIPTS), np.int64) for lang in languages}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist())
            for at, end, data, first in textbytes.blocks(batch.column("text")):
                words = read_words(data, first)
                lang_of_word = langs[at:end][textbytes.owner(words.first_word)]
                for lang in np.unique(langs[at:end]):
                    mine = (lang_of_word == lang) & (words.letters > 0)
                    times = np.bincount(words.distinct.inverse[mine], minlength=len(words.distinct.hashes))
                    for width in WIDTHS:
                        bucket, word = words.distinct.grams(width, BUCKETS)
                        grams[lang] += np.bincount(bucket, times[word], BUCKETS).astype(np.int64)
                    scripts[lang] += np.bincount(words.script[mine], words.letters[mine], len(SCRIPTS)).astype(np.int64)
        columns = [list(languages), [grams[x].tobytes() for x in languages], [scripts[x].tobytes() for x in languages]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "grams", "scripts"])

    # TRAINING_TASKS rows per language, of a fixed size each.
    counted = sample.repartition(TRAINING_TASKS).mapInArrow(count, "lang string, grams binary, scripts binary").collect()
    grams = np.zeros((BUCKETS, len(languages)))
    letters = np.zeros((len(SCRIPTS), len(languages)))
    for row in counted:
        column = languages.index(row["lang"])
        grams[:, column] += np.frombuffer(row["grams"], np.int64)
        letters[:, column] += np.frombuffer(row["scripts"], np.int64)
    scores = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    scores -= scores.mean(axis=1, keepdims=True)
    allowed = letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
    allowed[SCRIPTS.index(OTHER)] = True
    return Model(languages, (WEIGHT * scores).astype(np.float32), allowed)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """A row per word and a column per language; words without letters tell nothing."""
    n = len(words.distinct.hashes)
    scores = np.zeros((n, len(model.languages)), np.float32)
    for width in WIDTHS:
        bucket, word = words.distinct.grams(width, BUCKETS)
        for column in range(len(model.languages)):
            scores[:, column] += np.bincount(word, model.scores[bucket, column], n).astype(np.float32)
    scores = scores[words.distinct.inverse]
    allowed = model.allowed[words.script]
    # A script that no language was seen in tells nothing either.
    scores = np.where(allowed | ~allowed.any(axis=1, keepdims=True), scores, WRONG_SCRIPT)
    return np.where((words.letters > 0)[:, None], scores, np.float32(0))


@dataclass
class _Labelled:
    """What is found for rows ``at`` to ``at + n`` of a batch."""

    at: int
    n: int
    language: np.ndarray
    score: np.ndarray
    first: np.ndarray
    words: Words
    document: np.ndarray
    labels: np.ndarray


def _labelled(texts: pa.Array, model: Model) -> Iterator[_Labelled]:
    n_languages = len(model.languages)
    penalty = (-SWITCH * (1 - np.eye(n_languages))).astype(np.float32)
    names = np.array([*model.languages, UNDETERMINED], dtype=object)
    for at, end, data, first in textbytes.blocks(texts, BLOCK_BYTES):
        words, n = read_words(data, first), end - at
        document = textbytes.owner(words.first_word)
        share = np.zeros((n, n_languages + 1))
        labels = np.full(len(document), n_languages)
        if n_languages:
            labels = chains.viterbi(word_scores(words, model), words.first_word, penalty)
            np.add.at(share, (document, labels), words.letters)
        best, total = share.argmax(axis=1), share.sum(axis=1)
        best = np.where(total > 0, best, n_languages)
        score = share[np.arange(n), best] / np.maximum(total, 1)
        yield _Labelled(at, n, names[best], score, first, words, document, labels)


def _spans(found: _Labelled, model: Model) -> list[list[dict]]:
    listed: list[list[dict]] = [[] for _ in range(found.n)]
    turn = np.diff(found.document, prepend=-1).astype(bool) | np.diff(found.labels.astype(int), prepend=-1).astype(bool)
    change = np.flatnonzero(turn).tolist()
    for a, b in zip(change, [*change[1:], len(turn)], strict=False):
        d = found.document[a]
        if found.language[d] != UNDETERMINED:
            start, end = found.words.start[a] - found.first[d], found.words.end[b - 1] - found.first[d]
            listed[d].append({"start": start, "end": end, "lang": model.languages[found.labels[a]]})
    return listed


def label_spans(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, lang_pred and score (share of the letters in that language).

    With ``spans`` also the byte ranges of one language each, from the first to the last word. Texts that are NULL or
    have no letter, and all texts if no language was learned, are ``und`` with score 0 and no spans. Ties go to the
    language that comes first by name. Ids may be NULL, rows may repeat, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            for found in _labelled(batch.column("text"), shared.value):
                ids = batch.column("doc_id").slice(found.at, found.n)
                columns = [ids, pa.array(found.language, pa.string()), pa.array(found.score)]
                fields = ["doc_id", "lang_pred", "score"]
                if spans:
                    columns, fields = [*columns, pa.array(_spans(found, shared.value), kind)], [*fields, "spans"]
                yield pa.RecordBatch.from_arrays(columns, fields)

    schema = f"{LABELLED}, {SPANS}" if spans else LABELLED
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(run), schema)


def keep_identified(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a language that holds ``least_score`` of its letters.

    NULL texts and texts without a letter go. No row is moved between tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            for found in _labelled(batch.column("text"), shared.value):
                kept = (found.language != UNDETERMINED) & (found.score >= least_score)
                yield batch.slice(found.at, found.n).filter(pa.array(kept.astype(bool)))

    return docs.mapInArrow(releasing(run), docs.schema)
