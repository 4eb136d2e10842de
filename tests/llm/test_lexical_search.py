import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import documents, odd_rows, with_clashing_columns, words

from tillmark.llm import lexical_search as s
from tillmark.llm import terms as T

ITEMS = "item_id long, text string"


def terms_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(s.TERM_PATTERN, lower)


def brute_force(docs, items, top=10):
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    counts = [(doc_id, found, sum(found.values())) for doc_id, found in counts if found]
    number, total = len(counts), sum(n for _, _, n in counts)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms_of(text))
    rows = []
    for item_id, wanted in asked.items():
        scores = []
        for doc_id, found, n in counts:
            score = 0
            for term in wanted & found.keys():
                df = sum(term in other for _, other, _ in counts)
                w = math.floor(1000 * math.log((2 * number + 2) / (2 * df + 1)))
                m = 100 - 90 + (90 * n * number) // total
                score += w * ((10**9 * found[term]) // (1000 * found[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort(key=lambda row: (row[0], row[1], row[2] or 0))
        rows += [(item_id, k + 1, row[2], -row[0]) for k, row in enumerate(scores[:top])]
    return sorted(rows, key=str)


def found(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_odd_rows_ties_and_repeated_rows(spark):
    rng = random.Random(3)
    rows = [*odd_rows(2000), *[(100 + k, words(rng, rng.randrange(1, 40), 60)) for k in range(60)]]
    # Ties beyond the tenth place, ids that repeat, long terms and such of two words.
    rows += [(300 - k, "w1 w2 tie") for k in range(25)] + [(300, "w1 w2 tie")] * 2
    rows += [(400, "é" * 3000 + " sixteenbytesterm seventeenbytesxyz"), (401, "SEVENTEENBYTESXYZ Ünder12345678")]
    items = [(1, "w1 W2 tie w3"), (2, None), (3, ""), (4, "seventeenbytesxyz sixteenbytesterm ünder12345678 Ünder12345678")]
    items += [(None, "w5 w6"), (None, "w7"), (5, "é" * 3000), (6, "nowhere"), (6, "w9 w9 w9"), (7, "id text words")]
    items += [(10 + k, words(rng, 30, 60)) for k in range(20)]
    docs = with_clashing_columns(documents(spark, rows)).withColumnRenamed("kept", "rank").repartition(5)
    asked = with_clashing_columns(spark.createDataFrame(items, ITEMS))
    assert found(s.search(docs, asked)) == brute_force(rows, items)
    assert found(s.search(docs, asked, top=1)) == brute_force(rows, items, 1)


def test_several_indexes(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, words(rng, 30, 80)) for k in range(40)]
    items = [(k, words(rng, 12, 100)) for k in range(30)]
    monkeypatch.setattr(s, "INDEX_BYTES", 1000)
    assert len(list(s._indexes(spark.createDataFrame(items, ITEMS)))) > 3
    assert found(s.search(documents(spark, rows), spark.createDataFrame(items, ITEMS))) == brute_force(rows, items)


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a b")])
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert found(s.search(none, items)) == []
    assert found(s.search(some, items.limit(0))) == []
    assert found(s.search(documents(spark, [(1, None), (2, "...")]), items)) == []


@pytest.mark.parametrize("cells", [1, 7, 100, 1 << 21])
@pytest.mark.parametrize("doubles", [True, False])
def test_small_chunks(cells, doubles, monkeypatch):
    monkeypatch.setattr(s, "CELLS", cells)
    rng = random.Random(9)
    rows = [(k, words(rng, rng.randrange(0, 30), 40)) for k in range(50)]
    items = [(k, words(rng, 8, 50)) for k in range(12)]
    index = s.Index(sorted({(item, term) for item, text in items for term in terms_of(text)}))
    column = pa.array([text for _, text in rows])
    counts = [s.Counts.of(part, index) for _, part in T.of_texts(column, s.SEPARATOR)][0]
    holding = np.bincount(counts.term, minlength=len(index))
    heaps = s.Heaps(index, s.Statistics.of(int(np.count_nonzero(counts.n)), int(counts.n.sum()), holding), 10)
    heaps._doubles = doubles
    heaps.add([doc_id for doc_id, _ in rows], counts)
    got = heaps.batch().to_pylist()
    want = [(item, doc_id, score) for item, _, doc_id, score in brute_force(rows, items)]
    assert sorted((row["item_id"], row["doc_id"], row["score"]) for row in got) == sorted(want)


def test_lengths_beyond_64_bits_are_exact():
    statistics = s.Statistics(10**12, 10**15, np.zeros(0, np.int64))
    n = np.array([10**9, 1], np.int64)
    assert statistics.damping(n).tolist() == [10 + 90 * 10**9 * 10**12 // 10**15, 10]


def test_no_shuffle_of_texts(spark):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    plan = s.search(documents(spark, [(1, "a b")]), items)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "text" in line]
