"""Source divergence audit: how far the sources of each language differ in the terms they use.

Tasks count terms by sorting: terms of up to 8 and up to 16 bytes are packed into one and two 64-bit words, sorted by
radix and counted by runs, longer ones are sorted by their bytes, length by length. What a task sends is one row per
language, source and term. Shares of terms, smoothed so that none is zero, are then compared in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm import terms as T
from tillmark.llm.rows import slices
from tillmark.operators.joins import split_key
from tillmark.session import scratch_path

#: Documents of a language that a term must be in to be kept.
LEAST_DOCUMENTS = 10

#: Terms reported for each source.
TOP_TERMS = 10

# The ASCII bytes between terms, the scale of shares and what each count is raised by.
SEPARATOR = T.separators((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
SCALE = 10**9
RAISED = 2

#: Rows of counts that a task holds before it sends them, and bytes of long terms.
HELD_ROWS, HELD_BYTES = 1 << 20, 32 << 20

#: Sources compared with each other at a time, and counts that one such comparison takes.
SOURCE_BLOCK, COMPARED_COUNTS = 256, 200_000

#: Shares worked on at a time.
CELLS = 1 << 20

COUNTS = "lang string, source string, term string, times long, documents long"
PAIRS = "lang string, source string, item string, apart long, seen long, unseen_apart long, kept_terms long"


class TermCounts:
    """Times and documents per group and term, summed up over runs of documents."""

    def __init__(self) -> None:
        #: By number of words: rows of keys (group, words), times and documents, as sums of runs that aren't merged yet.
        self._runs: dict[int, list[list[np.ndarray]]] = {1: [], 2: []}
        self._rows = 0
        self._long: dict[tuple[int, bytes], list[int]] = {}
        self._long_bytes = 0

    @property
    def full(self) -> bool:
        if self._rows > HELD_ROWS:
            self._rows = 0
            for n, runs in self._runs.items():
                if runs:
                    self._runs[n] = [_summed(*_joined(runs))]
                    self._rows += len(self._runs[n][0][0])
        return self._rows > HELD_ROWS // 2 or self._long_bytes > HELD_BYTES

    def add(self, found: T.Terms, group: np.ndarray) -> None:
        """Count the terms of a run of documents; ``group`` is the group of each document."""
        document = found.document
        bounds = ((1, 0, T.ONE_WORD), (2, T.ONE_WORD, T.TWO_WORDS))
        for n, above, upto in bounds:
            which = np.flatnonzero((found.length > above) & (found.length <= upto))
            if len(which):
                keys = [group[document[which]], *(found.word(which, 8 * k) for k in range(n))]
                order = T.radix_order(keys)
                keys = [key[order] for key in keys]
                # Equal terms stay in order of document, so a run's documents are where the document changes.
                other = document[which][order]
                begin = T.run_starts(keys)
                new = np.zeros(len(other), np.int64)
                new[T.run_starts([*keys, other])] = 1
                times = np.diff(np.append(begin, len(other)))
                self._runs[n].append([*(key[begin] for key in keys), times, np.add.reduceat(new, begin)])
                self._rows += len(begin)
        for which, rows in found.long_rows(np.flatnonzero(found.length > T.TWO_WORDS)):
            # By bytes, then by group: within a run of both, documents are in order.
            order = np.argsort(rows, kind="stable")
            order = order[T.radix_order([group[document[which[order]]]])]
            own, other, rows = group[document[which[order]]], document[which[order]], rows[order]
            begin = T.run_starts([own, rows])
            new = np.zeros(len(rows), np.int64)
            new[T.run_starts([own, rows, other])] = 1
            times, documents = np.diff(np.append(begin, len(rows))), np.add.reduceat(new, begin)
            for k, at in enumerate(begin):
                key = (int(own[at]), bytes(rows[at]))
                if key not in self._long:
                    self._long[key] = [0, 0]
                    self._long_bytes += len(key[1]) + 200
                self._long[key][0] += int(times[k])
                self._long[key][1] += int(documents[k])

    def taken(self, names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        """All counts so far as rows of ``COUNTS``; counting then starts anew. ``names`` are those of the groups."""
        for runs in self._runs.values():
            if runs:
                group, *words, times, documents = _summed(*_joined(runs))
                yield _batch(names, group, T.spelled_out(words), times, documents)
        if self._long:
            group = np.array([key[0] for key in self._long])
            spelled = pa.array([key[1] for key in self._long], pa.large_binary()).cast(pa.large_string())
            times, documents = np.array(list(self._long.values()), np.int64).T
            yield _batch(names, group, spelled, times, documents)
        self.__init__()


def _joined(runs: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    columns = [np.concatenate(parts) for parts in zip(*runs, strict=True)]
    return columns[:-2], columns[-2:]


def _summed(keys: list[np.ndarray], sums: list[np.ndarray]) -> list[np.ndarray]:
    order = T.radix_order(keys)
    keys = [key[order] for key in keys]
    begin = T.run_starts(keys)
    return [*(key[begin] for key in keys), *(np.add.reduceat(one[order], begin) for one in sums)]


def _batch(names, group: np.ndarray, spelled: pa.Array, times: np.ndarray, documents: np.ndarray) -> pa.RecordBatch:
    langs, sources = (pa.array([name[k] for name in names], pa.string()) for k in (0, 1))
    at = pa.array(group.astype(np.int64))
    columns = [langs.take(at), sources.take(at), spelled.cast(pa.string()), pa.array(times), pa.array(documents)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "times", "documents"])


def count_terms(docs: DataFrame) -> DataFrame:
    """Rows of ``COUNTS``: each task's sums, several for one term where a task sends before its end.

    Every task also sends a row with the empty term (times and documents 0) for each language and source it has seen,
    so that groups without terms are known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        counts = TermCounts()
        for batch in slices(batches):
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            group = np.array([numbers.setdefault(pair, len(numbers)) for pair in pairs], np.uint32)
            for at, found in T.of_texts(batch.column("text"), SEPARATOR):
                counts.add(found, group[at : at + len(found.first) - 1])
                if counts.full:
                    yield from counts.taken(list(numbers))
        yield from counts.taken(list(numbers))
        none = np.zeros(len(numbers), np.int64)
        yield _batch(list(numbers), np.arange(len(numbers)), pa.array([""] * len(numbers), pa.string()), none, none)

    named = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")]
    return docs.select(*named, "text").mapInArrow(run, COUNTS)


def kept_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, term, times and lang_times (of the whole language) of the kept terms, one row each, without zeros.

    The empty term stands for a group as a whole. ``leads`` is 1 in one row of each term of a language, else 0.
    """
    # Dealt out by language and term once; sums per source, then per language, need no other shuffle.
    dealt = count_terms(docs).repartition("lang", "term")
    sums = dealt.groupBy("lang", "term", "source").agg(F.sum("times").alias("times"), F.sum("documents").alias("documents"))
    term = Window.partitionBy("lang", "term")
    first = F.row_number().over(term.orderBy("source")) == 1
    whole = sums.withColumns(
        {
            "lang_times": F.sum("times").over(term),
            "lang_documents": F.sum("documents").over(term),
            "leads": (first & (F.col("term") != "")).cast("int"),
        }
    )
    kept = whole.filter((F.col("lang_documents") >= least_documents) | (F.col("term") == ""))
    return kept.select("lang", "source", "term", "times", "lang_times", "leads")


def group_totals(
    kept: DataFrame, source_block: int = SOURCE_BLOCK, compared_counts: int = COMPARED_COUNTS
) -> DataFrame:
    """One row per language and source: number (from 0 within the language), block, total, and for the language
    kept_terms, lang_total, blocks, salts."""
    sums = kept.groupBy("lang", "source").agg(
        F.sum("times").alias("total"), F.sum("leads").alias("leads"), F.count(F.lit(1)).alias("counts")
    )
    lang = Window.partitionBy("lang")
    number = F.row_number().over(lang.orderBy("source")) - 1
    return sums.select(
        "lang",
        "source",
        number.alias("number"),
        F.floor(number / source_block).cast("int").alias("block"),
        "total",
        F.sum("leads").over(lang).alias("kept_terms"),
        F.sum("total").over(lang).alias("lang_total"),
        F.ceil(F.count(F.lit(1)).over(lang) / source_block).cast("int").alias("blocks"),
        F.ceil(F.sum("counts").over(lang) / compared_counts).cast("int").alias("salts"),
    )


def _share(times: Column, total: Column) -> Column:
    """1 + floor(SCALE * (times + 2) / (total + 2 * kept_terms)); in decimals, as the product may not fit 64 bits."""
    scaled = (times + RAISED).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", scaled, (total + RAISED * F.col("kept_terms")).cast("decimal(20,0)"))


def shares(times: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * times / total), by long division in steps that fit 64 bits; ``times`` is at most ``total``."""
    whole, rest = np.int64(0), times
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _compared(counts: pa.Table, totals: pa.Table, low: int, high: int) -> pa.Table:
    """Every pair of a source of block ``low`` and one of block ``high``, over the terms of ``counts``."""
    totals = totals.sort_by("number")
    block, number, total, kept = (totals.column(name).to_numpy() for name in ("block", "number", "total", "kept_terms"))
    raised = total + RAISED * kept
    ahead, behind = np.flatnonzero(block == low), np.flatnonzero(block == high)
    sums = np.zeros((len(number), len(number)), np.int64)
    encoded = counts.column("term").combine_chunks().dictionary_encode()
    code, seen = encoded.indices.to_numpy(zero_copy_only=False), len(encoded.dictionary)
    order = np.argsort(code, kind="stable")
    code, times = code[order], counts.column("times").to_numpy()[order]
    column = np.searchsorted(number, counts.column("number").to_numpy())[order]
    step = max(1, CELLS // max(1, len(number)))
    for at in range(0, seen, step):
        part = slice(*np.searchsorted(code, (at, at + step)))
        dense = np.full((min(step, seen - at), len(number)), RAISED, np.int64)
        dense[code[part] - at, column[part]] += times[part]
        p = shares(dense, raised)
        for a in ahead:
            others = behind[behind > a]
            sums[a, others] += apart(p[:, a, None], p[:, others]).sum(axis=0)
    rows = np.array([(a, b) for a in ahead for b in behind[behind > a]], np.int64).reshape(-1, 2)
    a, b = rows.T
    # A term that none of these sources has: the same share in each, and none if no term is kept.
    absent = shares(np.full(len(number), RAISED), raised) if len(kept) and kept[0] else np.ones(len(number), np.int64)
    source = totals.column("source").combine_chunks()
    columns = {
        "source": source.take(pa.array(a)),
        "item": source.take(pa.array(b)),
        "apart": pa.array(sums[a, b]),
        "seen": pa.array(np.full(len(rows), seen, np.int64)),
        "unseen_apart": pa.array(apart(absent[a], absent[b])),
        "kept_terms": pa.array(kept[a]),
    }
    return pa.table(columns)


def source_pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language) and value: how far their shares are apart over all terms.

    Sources are compared in blocks, each pair of blocks in as many tasks as its language's counts
    take (``salts``, by term), so neither a language of many sources nor one of many terms meets in one task. Every
    source goes to each of them with its total, which is what a source without a term needs.
    """
    keys = ["lang", "low", "high", "salt"]
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    def dealt(frame: DataFrame, salt: Column, *columns: str) -> DataFrame:
        placed = frame.withColumn("other_block", other).withColumn("salt", salt)
        blocks = (F.least("block", "other_block").alias("low"), F.greatest("block", "other_block").alias("high"))
        return placed.select("lang", *blocks, F.col("salt").cast("int"), *columns)

    salt = F.pmod(F.xxhash64("term"), F.col("salts"))
    counts = dealt(_with_totals(kept.filter("term != ''"), totals), salt, "term", "number", "times")
    # Both sides come from the totals; columns of their own tell them apart.
    totals = totals.select(*[F.col(name).alias(name) for name in totals.columns])
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    sources = dealt(totals, salts, "source", "block", "number", "total", "kept_terms")

    def run(key, counts: pa.Table, sources: pa.Table) -> pa.Table:
        lang, low, high, _ = (part.as_py() for part in key)
        compared = _compared(counts, sources, low, high)
        return compared.add_column(0, "lang", pa.array([lang] * compared.num_rows, pa.string()))

    parts = counts.groupBy(*keys).cogroup(sources.groupBy(*keys)).applyInArrow(run, PAIRS)
    sums = parts.groupBy("lang", "source", "item").agg(
        F.sum("apart").alias("apart"),
        F.sum("seen").alias("seen"),
        F.max("unseen_apart").alias("unseen_apart"),
        F.max("kept_terms").alias("kept_terms"),
    )
    value = F.col("apart") + (F.col("kept_terms") - F.col("seen")) * F.col("unseen_apart")
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    both = sums.select("lang", value.alias("value"), F.explode(ways).alias("way"))
    return both.select("lang", "way.source", "way.item", "value")


def _with_totals(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """The counts with what ``group_totals`` says of their group; a source that has most counts can be split."""
    groups = totals.withColumnsRenamed({"lang": "group_lang", "source": "group_source"})
    same = split_key(F.col("source"), F.col("group_source")) & (F.col("lang") == F.col("group_lang"))
    return kept.join(groups, same).drop("group_lang", "group_source")


def telling_terms(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (a term that the source has more of than its language) and value: how far apart."""
    rows = _with_totals(kept.filter("term != '' AND times > 0"), totals)
    rows = rows.withColumns(
        {"p": _share(F.col("times"), F.col("total")), "q": _share(F.col("lang_times"), F.col("lang_total"))}
    )
    gap = F.col("p") - F.col("q")
    value = F.call_function("div", gap * gap, F.col("p") + F.col("q"))
    return rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))


def audit(
    docs: DataFrame,
    folder: str | None = None,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    source_block: int = SOURCE_BLOCK,
    compared_counts: int = COMPARED_COUNTS,
) -> DataFrame:
    """lang, source, part, item, value, rank: parts ``pair`` (all other sources of the language) and ``term`` (the
    ``top_terms`` that tell a source from its language most), ranked by value, then by item in order of bytes.

    ``docs`` has text, lang and source, NULL counting as empty; an empty name is a language or source like any other.
    Other columns are ignored. Whole texts count, repeated rows as often as they are there. Of a term each language
    keeps those in ``least_documents`` of its rows or more. A source whose texts hold no term is compared like any
    other (value 0 if its language keeps no term); a language's only source has no pairs. An empty table gives no rows.

    Counts of kept terms are written to ``folder`` (by default one of their own under the shared folder) and read again
    by the totals and both parts. Texts aren't moved.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "source-audit")
    kept_counts(docs, least_documents).write.parquet(f"{folder}/kept")
    kept = spark.read.parquet(f"{folder}/kept")
    group_totals(kept, source_block, compared_counts).write.parquet(f"{folder}/totals")
    totals = spark.read.parquet(f"{folder}/totals")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(kept, totals).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    terms = telling_terms(kept, totals).withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(order))
    return pairs.select(*columns).unionAll(terms.filter(F.col("rank") <= top_terms).select(*columns))
