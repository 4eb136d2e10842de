"""Quality rules: lines labelled content or boilerplate by a linear-chain conditional random field.

Viterbi decoding labels the lines of each document; the share of its words that lie in content lines decides whether it
is kept. A few counts over the whole text (``base``) can fail it beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import chains, textbytes

#: Labelled documents that the field is trained on, about (a hash of the id below a threshold chooses them).
TRAINING_DOCUMENTS = 4000

#: Tasks that turn those documents into features; fixed, as the sample is.
TRAINING_TASKS = 8

#: A document is kept if at least this share of its words lies in content lines.
CONTENT_SHARE = 0.5

#: How likely a line is of the kind that its document's label names.
AGREEMENT = 0.65

FEWEST_WORDS = 50
MOST_REPEATED = 0.5

CONTENT, BOILERPLATE = 0, 1

JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0xC3, 0xF5)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\"')")] = True
#: Bytes that begin a code point.
_LEAD = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Field:
    """Weights per feature and label, and what going from one label to the next adds."""

    weights: np.ndarray
    transition: np.ndarray


#: Without labelled documents of both kinds every line counts as content.
NO_FIELD = Field(np.zeros((0, 2)), np.zeros((2, 2)))


@dataclass
class Lines:
    """Counts per document and features per line that has a word."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    first_line: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def _repeated_windows(hashes: np.ndarray, first_word: np.ndarray) -> np.ndarray:
    """Which words lie in a window of three words that occurs twice or more in the same document."""
    covered = np.zeros(len(hashes), bool)
    document = textbytes.owner(first_word)
    if len(hashes) < 3:
        return covered
    windows = textbytes.shingles(hashes, 3)
    inside = np.flatnonzero(document[:-2] == document[2:])
    keys = textbytes.mix(windows[inside] + document[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    found = inside[counts[inverse] > 1]
    for k in range(3):
        covered[found + k] = True
    return covered


def measure(data: np.ndarray, first: np.ndarray) -> Lines:
    """Counts and features of a block of documents."""
    start, end, first_word = textbytes.words(data, first)
    hasher = textbytes.Hasher(data)
    repeated = _repeated_windows(hasher(start, end), first_word)
    space = textbytes.SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[first] = True
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.union1d(first[:-1], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start, len(data))[1:]
    # A line ends before its line feed, or where its document ends.
    line_end = line_end - (data[line_end - 1] == 0x0A)
    at, after = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
    some = after > at
    line_start, line_end, at, after = line_start[some], line_end[some], at[some], after[some]
    line_words = after - at
    document = np.searchsorted(first, line_start, "right") - 1
    keys = textbytes.mix(hasher(line_start, line_end) + document.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, earliest, inverse = np.unique(keys, return_index=True, return_inverse=True)
    duplicate = earliest[inverse] != np.arange(len(keys))
    n = len(first) - 1
    chars = textbytes.sums(_LEAD[data] & ~space, line_start, line_end)
    counted = {
        name: textbytes.sums(table[data], line_start, line_end) / np.maximum(chars, 1)
        for name, table in (("symbol", _SYMBOL), ("digit", _DIGIT), ("upper", _UPPER), ("letter", _LETTER))
    }
    last = data[end[after - 1] - 1] if len(after) else np.zeros(0, np.uint8)
    again = textbytes.sums(repeated, at, after) / np.maximum(line_words, 1)
    average = chars / np.maximum(line_words, 1)
    features = np.stack(
        [
            np.ones(len(line_start)),
            line_words <= 2,
            (line_words > 2) & (line_words <= 5),
            line_words > 12,
            counted["symbol"] > 0.02,
            counted["symbol"] > 0.1,
            counted["symbol"] > 0.2,
            counted["digit"] > 0.1,
            counted["digit"] > 0.3,
            counted["upper"] > 0.3,
            counted["letter"] < 0.7,
            counted["letter"] < 0.5,
            _STOP[last],
            duplicate,
            again > 0.5,
            average > 15,
            average < 2.5,
        ],
        axis=1,
    ).astype(float)
    return Lines(
        np.diff(first_word),
        textbytes.sums(_LEAD[data] & ~space, first[:-1], first[1:]),
        textbytes.sums(_SYMBOL[data], first[:-1], first[1:]),
        np.bincount(document[duplicate], minlength=n),
        textbytes.sums(repeated, first_word[:-1], first_word[1:]),
        np.searchsorted(document, np.arange(n + 1)),
        line_words,
        features,
    )


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """Train the field on a bounded sample of labelled documents.

    Which lines are content and which boilerplate is learned: lines of good documents are mostly content, lines of the
    others mostly not (``AGREEMENT``), and a line that looks like those of the other kind of document belongs to them.

    ``docs`` has doc_id and text, ``labels`` has doc_id and quality (1: good). About ``TRAINING_DOCUMENTS`` of them are
    used. Rows with a NULL in any of these columns are left out. Where one of the two kinds is missing the result
    takes every line for content.
    """
    labelled = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    labelled = labelled.agg(F.max("quality").alias("quality"))
    total = labelled.count()
    share = min(1.0, TRAINING_DOCUMENTS / max(1, total))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # Bounded: an id and a label for each document of the sample.
    sample = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality = batch.column("quality").to_numpy(zero_copy_only=False)
            for at, end, data, first in textbytes.blocks(batch.column("text")):
                lines = measure(data, first)
                rows = zip(lines.first_line, lines.first_line[1:], quality[at:end], strict=False)
                packed = [(lines.features[a:b].astype(np.uint8).tobytes(), int(q)) for a, b, q in rows if b > a]
                columns = [pa.array([p for p, _ in packed], pa.binary()), pa.array([q for _, q in packed], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["features", "quality"])

    # A bounded sample: about TRAINING_DOCUMENTS documents, a few bytes per line of each.
    rows = sample.repartition(TRAINING_TASKS).mapInArrow(features, "features binary, quality int").collect()
    if len({row["quality"] for row in rows}) < 2:
        return NO_FIELD
    width = measure(np.zeros(0, np.uint8), np.zeros(1, np.int64)).features.shape[1]
    chains_of = [np.frombuffer(row["features"], np.uint8).reshape(-1, width) for row in rows]
    first = np.concatenate([[0], np.cumsum([len(chain) for chain in chains_of])])
    kinds = np.repeat([CONTENT if row["quality"] else BOILERPLATE for row in rows], np.diff(first))
    features = np.concatenate(chains_of).astype(float)
    return Field(*chains.train_latent_field(features, first, kinds, 2, AGREEMENT))


def label_lines(lines: Lines, field: Field) -> np.ndarray:
    if not len(field.weights):
        return np.zeros(len(lines.line_words), np.uint8)
    return chains.viterbi(lines.features @ field.weights, lines.first_line, field.transition)


def judge(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the base counts, base_failed, kept and content_share.

    A NULL text has no words, so it fails. Ids may be NULL and rows may repeat; other columns are ignored; an empty
    table gives an empty result. A document without words has a content share of 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, first in textbytes.blocks(batch.column("text")):
                lines = measure(data, first)
                content = np.where(label_lines(lines, field) == CONTENT, lines.line_words, 0)
                inside = textbytes.sums(content, lines.first_line[:-1], lines.first_line[1:])
                share = inside / np.maximum(lines.n_words, 1)
                failed = (lines.n_words < FEWEST_WORDS) | (lines.n_repeat_words > MOST_REPEATED * lines.n_words)
                counts = [lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words]
                columns = [batch.column("doc_id").slice(at, end - at), *(pa.array(c.astype(np.int64)) for c in counts)]
                columns += [pa.array(failed), pa.array(~failed & (share >= CONTENT_SHARE)), pa.array(share)]
                yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in JUDGED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, JUDGED)
