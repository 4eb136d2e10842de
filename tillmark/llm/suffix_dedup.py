"""Removal of repeated passages, found by suffix arrays with common prefixes of neighbours.

Every byte is removed that is covered by a string of ``LENGTH`` bytes which also starts in a document with a smaller
id. Strings are brought together as follows.

1. Each string of ``LENGTH`` bytes has an anchor, its run of ``ANCHOR`` bytes with the smallest hash. Neighbouring
   strings mostly have the same one and form a stretch. Equal strings have equal anchors.
2. Hashes of anchors, packed by bucket, show which of them occur in more than one document.
3. Only stretches at such anchors are sent on, to the bucket of their anchor; copies within a batch are sent once.
4. There, a suffix array over the different stretches is made by two-stage sorting. Neighbours with a common prefix of
   ``LENGTH`` bytes are equal strings; the smallest id among them decides which documents lose theirs.

Copies of whole texts are settled by a hash of the text beforehand, so a group of copies takes part once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm import textbytes
from tillmark.llm.buckets import Batches, bucket_count, map_groups
from tillmark.llm.rows import free_name, releasing, slices
from tillmark.llm.suffix_array import common_prefixes, suffix_array
from tillmark.operators.joins import split_key

#: Bytes of the strings that are compared.
LENGTH = 50

#: Bytes of an anchor.
ANCHOR = 20

#: Bytes of stretches that one suffix array is made over; an anchor with more of them gets one of its own.
ARRAY_BYTES = 1 << 20

#: Bytes of text that stretches are looked for in at a time; the work takes about fifty times as much memory.
BLOCK_BYTES = 1 << 20

#: Bytes of rows that are packed together.
BATCH_BYTES = 1 << 23

#: Bits of an anchor's hash that are compared. Anchors that agree in them by chance cost time, not correctness.
HASH_BITS = 48

PACKED_ANCHORS = "bucket int, ids binary, counts binary, low binary, high binary"
SHARED = "doc_id long, anchor long"
STRETCHES = "bucket int, anchors binary, lengths binary, content binary, ids binary, which binary, starts binary"
MARKS = "doc_id long, start long, end long"
TRIMMED = "doc_id long, text_key string, n_removed long, n_spans long, kept binary"

#: Stands between stretches; no UTF-8 text has this byte.
_MARK = 0xFF


def stretches(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, textbytes.StretchHasher]:
    """First byte, last byte + 1, hash of the anchor and document of each stretch of a block, and the block's hasher.

    A stretch is a maximal run of strings of ``LENGTH`` bytes with the same anchor; the leftmost of equal anchors counts.
    """
    hasher = textbytes.StretchHasher(data)
    nothing = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return nothing, nothing, nothing.astype(np.uint64), nothing, hasher
    place = np.arange(len(data) - ANCHOR + 1)
    hashes = hasher(place, place + ANCHOR)
    least, where = hashes, place.astype(np.int32)
    span, width = 1, LENGTH - ANCHOR + 1
    while span < width:
        step = min(span, width - span)
        smaller = least[step:] < least[:-step]
        where = np.where(smaller, where[step:], where[:-step])
        least = np.where(smaller, least[step:], least[:-step])
        span += step
    document = textbytes.owner(first)[: len(where)]
    string = np.flatnonzero(first[document + 1] - np.arange(len(where)) >= LENGTH)
    anchor, document = where[string], document[string]
    begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])]))
    begins = begins[: len(string)]
    ends = np.append(begins[1:], len(string)) - 1 if len(begins) else begins
    kept = hashes[anchor[begins]] & np.uint64((1 << HASH_BITS) - 1)
    return string[begins], string[ends] + LENGTH, kept, document[begins], hasher


def _bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return (textbytes.mix(anchor) % np.uint64(buckets)).astype(np.int64)


def _split(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of equal keys: key, first, last + 1."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return [(int(keys[a]), int(a), int(b)) for a, b in zip(at, [*at[1:], len(keys)], strict=True)]


def pack_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """The anchors of each document, once each, packed into one row for each batch and bucket."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, BATCH_BYTES):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            anchors, owners = [], []
            for at, _, data, first in textbytes.blocks(batch.column("text"), BLOCK_BYTES):
                _, _, anchor, document, _ = stretches(data, first)
                order = np.lexsort((anchor, document))
                anchor, document = anchor[order], document[order]
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])])
                anchors.append(anchor[new[: len(anchor)]])
                owners.append(document[new[: len(anchor)]] + at)
            anchor = np.concatenate([np.zeros(0, np.uint64), *anchors])
            document = np.concatenate([np.zeros(0, np.int64), *owners])
            bucket = _bucket_of(anchor, buckets)
            order = np.argsort(bucket, kind="stable")
            anchor, document, bucket = anchor[order], document[order], bucket[order]
            rows = []
            for b, start, end in _split(bucket):
                own, counts = np.unique(document[start:end], return_counts=True)
                part = anchor[start:end]
                low, high = part.astype(np.uint32), (part >> np.uint64(32)).astype(np.uint16)
                rows.append((b, *(x.tobytes() for x in (ids[own], counts.astype(np.uint32), low, high))))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in PACKED_ANCHORS.split(", ")])

    return docs.mapInArrow(releasing(run), PACKED_ANCHORS)


def _shared(tables) -> Batches:
    for table in tables:
        anchors, ids = [], []
        for row in table.to_pylist():
            low, high = np.frombuffer(row["low"], np.uint32), np.frombuffer(row["high"], np.uint16)
            anchors.append(low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32))
            ids.append(np.repeat(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.uint32)))
        del table
        anchor, doc = np.concatenate(anchors), np.concatenate(ids)
        order = np.argsort(anchor, kind="stable")
        anchor, doc = anchor[order], doc[order]
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        number = np.cumsum(new) - 1
        # An anchor of more than one document; the same document may have come in several batches.
        other = np.zeros(number[-1] + 1, bool)
        other[number[doc != doc[new][number]]] = True
        chosen = other[number]
        anchor, doc = anchor[chosen], doc[chosen]
        # A row that is repeated asks once, else its list would grow with each repeat of it.
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])[: len(doc)]
        columns = [pa.array(doc[new]), pa.array(anchor[new].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "anchor"])


def pack_stretches(docs: DataFrame, buckets: int) -> DataFrame:
    """The stretches of ``docs`` (doc_id, text, anchors) at the anchors listed, packed for each block and bucket."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, BATCH_BYTES):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            listed = batch.column("anchors")
            asked = listed.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            asked_by = np.repeat(np.arange(len(ids)), listed.value_lengths().to_numpy(zero_copy_only=False))
            factor = np.uint64(0x9E3779B97F4A7C15)
            wanted = np.unique(textbytes.mix(asked + asked_by.astype(np.uint64) * factor))
            rows = []
            for at, _, data, first in textbytes.blocks(batch.column("text"), BLOCK_BYTES):
                start, end, anchor, document, hasher = stretches(data, first)
                key = textbytes.mix(anchor + (document + at).astype(np.uint64) * factor)
                near = np.minimum(np.searchsorted(wanted, key), max(0, len(wanted) - 1))
                chosen = wanted[near] == key if len(wanted) else np.zeros(len(key), bool)
                start, end, anchor, document = start[chosen], end[chosen], anchor[chosen], document[chosen]
                content = hasher(start, end)
                bucket = _bucket_of(anchor, buckets)
                order = np.lexsort((content, anchor, bucket))
                start, end, anchor, document = start[order], end[order], anchor[order], document[order]
                content, bucket = content[order], bucket[order]
                for b, low, high in _split(bucket):
                    own = slice(low, high)
                    new = np.concatenate([[True], (content[own][1:] != content[own][:-1]) | (anchor[own][1:] != anchor[own][:-1])])
                    s, e = start[own][new], end[own][new]
                    texts = b"".join([data[x:y].tobytes() for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                    packed = [anchor[own][new], (e - s).astype(np.uint16)]
                    where = (start[own] - first[document[own]]).astype(np.uint32)
                    packed_after = [ids[document[own] + at], (np.cumsum(new) - 1).astype(np.uint32), where]
                    rows.append((b, *(x.tobytes() for x in packed), texts, *(x.tobytes() for x in packed_after)))
            kinds = [pa.int32(), *[pa.binary()] * 6]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in STRETCHES.split(", ")])

    return docs.mapInArrow(releasing(run), STRETCHES)


def earliest(content: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every string of ``LENGTH`` bytes of every stretch the smallest owner of an equal string.

    ``content`` holds the stretches one after the other, ``owners`` the smallest document that has each. Returns the
    owners string by string and where each stretch's strings begin (one more at the end).
    """
    n = len(lengths)
    begins = np.cumsum(lengths + 1) - lengths - 1
    text = np.full(int((lengths + 1).sum()), _MARK, np.uint8)
    stretch = np.repeat(np.arange(n), lengths)
    place = np.arange(len(content)) + stretch
    text[place] = content
    strings = lengths - LENGTH + 1
    first = np.concatenate([[0], np.cumsum(strings)])
    number = np.full(len(text), -1, np.int64)
    whole = np.arange(first[-1]) - np.repeat(first[:-1], strings) + np.repeat(begins, strings)
    number[whole] = np.arange(first[-1])
    order = suffix_array(text)
    order = order[number[order] >= 0]
    equal = common_prefixes(text, order, LENGTH) >= LENGTH
    owner = np.repeat(owners, strings)[number[order]]
    group = np.flatnonzero(~equal)
    least = np.minimum.reduceat(owner, group) if len(group) else owner
    result = np.empty(len(order), np.int64)
    result[number[order]] = np.repeat(least, np.diff(np.append(group, len(order))))
    return result, first


def _marks_of(content, lengths, at, owners, ids, which, starts) -> np.ndarray:
    """Byte ranges (document, start, end) that go, from some stretches and their occurrences."""
    least, first = earliest(content, lengths, owners)
    strings = np.diff(first)[which]
    begin = np.cumsum(strings) - strings
    offset = np.arange(int(strings.sum())) - np.repeat(begin, strings)
    occurrence = np.repeat(np.arange(len(which)), strings)
    gone = least[first[which][occurrence] + offset] < ids[occurrence]
    occurrence, offset = occurrence[gone], offset[gone]
    new = np.concatenate([[True], (occurrence[1:] != occurrence[:-1]) | (offset[1:] != offset[:-1] + 1)])[: len(offset)]
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(offset)) - 1 if len(a) else a
    base = starts[occurrence[a]]
    return np.stack([ids[occurrence[a]], base + offset[a], base + offset[b] + LENGTH], axis=1)


def _marks(tables) -> Batches:
    for table in tables:
        anchors, lengths, content, ids, which, starts, seen = [], [], [], [], [], [], 0
        for row in table.to_pylist():
            anchors.append(np.frombuffer(row["anchors"], np.uint64))
            lengths.append(np.frombuffer(row["lengths"], np.uint16).astype(np.int64))
            content.append(np.frombuffer(row["content"], np.uint8))
            ids.append(np.frombuffer(row["ids"], np.int64))
            which.append(np.frombuffer(row["which"], np.uint32).astype(np.int64) + seen)
            starts.append(np.frombuffer(row["starts"], np.uint32).astype(np.int64))
            seen += len(anchors[-1])
        del table
        anchor, length, text, doc, which, start = map(np.concatenate, (anchors, lengths, content, ids, which, starts))
        begin = np.cumsum(length) - length
        # The same stretch from several batches counts once, for the smallest document.
        key = textbytes.mix(textbytes.StretchHasher(text)(begin, begin + length) + textbytes.mix(anchor))
        order = np.lexsort((key, anchor))
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        kept = order[new]
        which = number[which]
        owner = np.full(len(kept), np.iinfo(np.int64).max)
        np.minimum.at(owner, which, doc)
        by_stretch = np.lexsort((start, doc, which))
        which, doc, start = which[by_stretch], doc[by_stretch], start[by_stretch]
        # The same place of the same document comes from each of its repeated rows.
        new = np.concatenate([[True], (which[1:] != which[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])])
        which, doc, start = which[new], doc[new], start[new]
        # Whole anchors to one suffix array after the other.
        total = np.cumsum(length[kept])
        ends = np.flatnonzero(np.append(anchor[kept][1:] != anchor[kept][:-1], True)) + 1
        at = 0
        while at < len(kept):
            limit = (total[at - 1] if at else 0) + ARRAY_BYTES
            within = ends[(ends > at) & (total[ends - 1] <= limit)]
            end = int(within[-1]) if len(within) else int(ends[ends > at][0])
            part = kept[at:end]
            low, high = np.searchsorted(which, [at, end])
            pieces = np.repeat(begin[part] - (np.cumsum(length[part]) - length[part]), length[part])
            rows = _marks_of(
                text[pieces + np.arange(len(pieces))],
                length[part],
                at,
                owner[at:end],
                doc[low:high],
                which[low:high] - at,
                start[low:high],
            )
            columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "end"])
            at = end


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs covered by byte ranges (start, end), which may overlap or touch."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    furthest = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > furthest[:-1]])
    return np.stack([spans[new, 0], furthest[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]], axis=1)


def whole_characters(text: bytes, spans: np.ndarray) -> np.ndarray:
    """The runs without the parts of characters at their borders."""
    result = []
    for start, end in spans.tolist():
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if end > start:
            result.append((start, end))
    return np.array(result, np.int64).reshape(-1, 2)


def cut(text: bytes, spans: np.ndarray) -> bytes:
    """What is left of a text without some runs."""
    bounds = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))


def _runs(spans: pa.ListScalar) -> np.ndarray:
    start, end = (part.to_numpy(zero_copy_only=False) for part in spans.values.flatten())
    return merged(np.stack([start, end], axis=1))


def trim(docs: DataFrame) -> DataFrame:
    """Cut the ``spans`` out of each text."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, BATCH_BYTES):
            rows = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                data, runs = text.encode(), _runs(spans)
                removed = int((runs[:, 1] - runs[:, 0]).sum())
                rows.append((hashlib.sha256(data).hexdigest(), removed, len(runs), cut(data, runs)))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            names = [part.split()[0] for part in TRIMMED.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return docs.select("doc_id", "text", "spans").mapInArrow(releasing(run), TRIMMED)


def _content() -> Column:
    return F.coalesce("text", F.lit(""))


def keys(docs: DataFrame) -> DataFrame:
    """doc_id, key of the text and its length in bytes."""
    text = _content()
    return docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("text_key"), F.octet_length(text).cast("long").alias("n_bytes"))


def first_copies(keyed: DataFrame) -> DataFrame:
    """The smallest id of each text, over ids that stand for one text only."""
    known = keyed.where("doc_id IS NOT NULL").groupBy("doc_id")
    single = known.agg(F.min("text_key").alias("first_key"), F.max("text_key").alias("last_key"))
    single = single.where("first_key = last_key")
    return single.groupBy("first_key").agg(F.min("doc_id").alias("first_id"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL").select("doc_id", _content().alias("text"))


def spans_to_remove(docs: DataFrame) -> DataFrame:
    """of (a doc_id) and spans (byte ranges, which may overlap) of the first copy of each text that loses some."""
    # The documents are dealt out by id for each join; one exchange serves all of them.
    texts = _texts(docs)
    # Buckets are held in memory one at a time, so they are made half as large as partitions.
    buckets = 2 * bucket_count(docs)
    firsts = first_copies(keys(docs)).select("first_id")
    reps = texts.join(firsts, texts["doc_id"] == firsts["first_id"], "left_semi")
    shared = map_groups(pack_anchors(reps, buckets), ["bucket"], _shared, SHARED)
    shared = shared.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list("anchor").alias("anchors"))
    asked = texts.join(shared, texts["doc_id"] == shared["of"]).select("doc_id", "text", "anchors")
    marks = map_groups(pack_stretches(asked, buckets), ["bucket"], _marks, MARKS)
    return marks.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A NULL text counts as empty; a text of fewer than ``LENGTH`` bytes loses nothing. Rows with a NULL id lose nothing
    and take nothing from others. Rows that repeat an id and its text get the same result; an id that stands for
    several texts takes nothing from others, and its texts lose only if they are whole copies of an earlier one. Other
    columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = keys(docs)
    firsts = first_copies(keyed)
    judged = keyed.join(firsts, split_key(keyed["text_key"], firsts["first_key"]), "left").drop("first_key")
    marks = spans_to_remove(docs)
    texts = _texts(docs)
    cuts = trim(texts.join(marks, texts["doc_id"] == marks["of"])).select(
        F.col("doc_id").alias("cut_id"),
        F.col("text_key").alias("cut_key"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    # Repeated rows are cut alike; each of them is joined with one cut.
    cuts = cuts.dropDuplicates(["cut_id", "cut_key"])
    same = (judged["doc_id"] == cuts["cut_id"]) & (judged["text_key"] == cuts["cut_key"])
    rows = judged.join(cuts, same, "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    own = F.col("doc_id") == F.col("first_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).when(own, F.coalesce("n_removed", F.lit(0))).otherwise(0).alias("n_removed"),
        F.when(copy, 1).when(own, F.coalesce("n_spans", F.lit(0))).otherwise(0).cast("long").alias("n_spans"),
        F.when(copy, nothing).when(own, F.coalesce("kept_sha256", "text_key")).otherwise(F.col("text_key")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, n_chars and any others) without repeated passages; see ``remove_repeats``.

    Spans are narrowed to whole characters, so that what is left is text, and n_chars follows. Rows of which nothing
    but white space is left go, as do later copies of a text. Rows that lose nothing stay as they are.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = keys(narrow)
    firsts = first_copies(keyed)
    copies = keyed.where(F.col("n_bytes") >= LENGTH).join(firsts, split_key(keyed["text_key"], firsts["first_key"]))
    copies = copies.where("doc_id > first_id").select(F.col("doc_id").alias("of"), "text_key").distinct()
    # What happens to a document: its spans go, or the texts with one of these keys.
    decided = spans_to_remove(narrow).select("of", "spans", F.lit(None).cast("string").alias("text_key"))
    no_spans = F.lit(None).cast(decided.schema["spans"].dataType).alias("spans")
    decided = decided.unionByName(copies.select("of", no_spans, "text_key"))
    schema = docs.schema
    of, cuts, texts_gone = (free_name(docs, name) for name in ("of", "removed_spans", "removed_texts"))
    decided = decided.groupBy(F.col("of").alias(of)).agg(
        F.first("spans", ignorenulls=True).alias(cuts), F.collect_set("text_key").alias(texts_gone)
    )
    wide = docs.join(decided, docs["doc_id"] == decided[of], "left").drop(of)

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, BATCH_BYTES):
            kept, texts, lengths = [], batch.column("text").to_pylist(), batch.column("n_chars").to_pylist()
            spans, removed = batch.column(cuts), batch.column(texts_gone).to_pylist()
            for row, text in enumerate(texts):
                data = (text or "").encode()
                gone = bool(removed[row]) and hashlib.sha256(data).hexdigest() in removed[row]
                if not gone and spans[row].is_valid:
                    texts[row] = cut(data, whole_characters(data, _runs(spans[row]))).decode()
                    lengths[row] = len(texts[row])
                    gone = not texts[row].strip()
                kept.append(not gone)
            columns = {name: batch.column(name) for name in schema.names}
            columns["text"] = pa.array(texts, batch.column("text").type)
            columns["n_chars"] = pa.array(lengths, batch.column("n_chars").type)
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array(kept))

    return wide.mapInArrow(releasing(run), schema)
