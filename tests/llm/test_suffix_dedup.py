import hashlib
import random

import numpy as np
from llm_rows import documents, odd_rows, with_clashing_columns, words
from pyspark.sql import functions as F

from tillmark.llm import suffix_dedup as d
from tillmark.llm.suffix_array import common_prefixes, suffix_array


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(400):
        text = bytes(rng.choice(rng.choice([b"ab\xff", b"abcdz", b"a"])) for _ in range(rng.randrange(60)))
        data = np.frombuffer(text, np.uint8)
        order = suffix_array(data)
        assert order.tolist() == sorted(range(len(text)), key=lambda at: text[at:])
        shared = common_prefixes(data, order, 50)
        for k in range(1, len(text)):
            a, b = text[order[k] :], text[order[k - 1] :]
            n = 0
            while n < min(len(a), len(b), 50) and a[n] == b[n]:
                n += 1
            assert shared[k] == n


def brute(rows):
    """Every string of every document in a table with the smallest document that has it."""
    least = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - d.LENGTH + 1):
            string = data[at : at + d.LENGTH]
            least[string] = min(doc_id, least.get(string, doc_id))
    result = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - d.LENGTH + 1):
            if least[data[at : at + d.LENGTH]] < doc_id:
                gone[at : at + d.LENGTH] = b"\1" * d.LENGTH
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        result.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result)


def passages(n=150):
    rng = random.Random(12)
    common = [words(rng, 14, 3000) for _ in range(6)] + ["é" * 40, "ab" * 60, "x" * 200]
    rows = []
    for i in range(n):
        parts = [words(rng, rng.randrange(30), 3000) for _ in range(4)] + rng.sample(common, rng.randrange(4))
        rng.shuffle(parts)
        rows.append((i, rng.choice(["\n", " ", ""]).join(parts)))
    rows += [(n + k, rows[k * 3][1]) for k in range(20)]
    rows += [(n + 20 + k, rows[k * 3][1][25:-25]) for k in range(20)]
    # Just long enough to be a repeat, and a byte too short.
    rows += [(900, "q" * 49), (901, "q" * 49), (902, "r" * 50), (903, "r" * 50), (904, "r" * 51)]
    return rows


def test_equal_to_a_table_of_all_strings(spark):
    rows = passages()
    found = d.remove_repeats(documents(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_small_batches_and_blocks_give_the_same(spark, monkeypatch, setting):
    rows = passages(60)
    monkeypatch.setattr(d, "BATCH_BYTES", 3000)
    monkeypatch.setattr(d, "BLOCK_BYTES", 900)
    setting(spark__sql__execution__arrow__maxRecordsPerBatch="7", spark__sql__autoBroadcastJoinThreshold="-1")
    found = d.remove_repeats(documents(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_small_suffix_arrays_give_the_same(spark, monkeypatch):
    texts = documents(spark, passages(60)).select("doc_id", "text").coalesce(1)
    shared = d.map_groups(d.pack_anchors(texts, 1), ["bucket"], d._shared, d.SHARED)
    shared = shared.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    packed = d.pack_stretches(texts.join(shared, "doc_id"), 1).toArrow()
    marks = []
    for size in (1 << 20, 200):
        monkeypatch.setattr(d, "ARRAY_BYTES", size)
        parts = list(d._marks([packed]))
        marks.append(sorted(tuple(row.values()) for part in parts for row in part.to_pylist()))
    assert len(parts) > 20 and marks[0] == marks[1] and marks[0]


def test_odd_rows(spark):
    frame = with_clashing_columns(documents(spark, odd_rows()))
    found = d.remove_repeats(frame).collect()
    assert len(found) == len(odd_rows())
    # Ids that are there once, or with one text, get what a table of all strings says.
    known = [(i, t) for i, t in odd_rows() if i not in (None, 10)]
    expected = brute(known)
    assert sorted(tuple(r) for r in found if r["doc_id"] not in (None, 10)) == expected
    assert all(r["n_removed"] == 0 for r in found if r["doc_id"] in (None, 10))
    assert d.remove_repeats(documents(spark, [])).count() == 0


def test_repeated_rows_that_lose_a_passage_stay_as_many(spark):
    rng = random.Random(21)
    shared = words(rng, 15)
    rows = [(1, words(rng, 9) + shared), (2, words(rng, 8) + shared + words(rng, 8)), (3, shared + words(rng, 9))]
    rows = [rows[0], *[rows[1]] * 3, *[rows[2]] * 2]
    frame = documents(spark, rows)
    for repeated in (frame.coalesce(1), frame.repartition(4)):
        found = sorted(map(tuple, d.remove_repeats(repeated).collect()))
        assert found == brute(rows) and found[1][2] > 0
    spans = {row["of"]: len(row["spans"]) for row in d.spans_to_remove(frame.repartition(4)).collect()}
    once = {row["of"]: len(row["spans"]) for row in d.spans_to_remove(frame.distinct()).collect()}
    assert spans == once


def test_the_texts_that_are_left(spark):
    rng = random.Random(2)
    shared = "é" * 30 + words(rng, 12)
    rows = [(1, "first " + shared), (2, words(rng, 5) + "ü" + shared + "ü"), (3, "first " + shared), (4, shared), (5, "short")]
    frame = with_clashing_columns(documents(spark, rows + odd_rows()[:1] + [(5, "short")]))
    kept = d.without_repeats(frame)
    assert kept.columns == frame.columns
    texts = sorted((r["doc_id"] or 0, r["text"], r["n_chars"]) for r in kept.collect())
    second = rows[1][1].replace(shared, "")
    assert texts == sorted(
        [(0, odd_rows()[0][1], len(odd_rows()[0][1])), (1, rows[0][1], len(rows[0][1])), (2, second, len(second))]
        + [(5, "short", 5)] * 2
    )
    assert d.without_repeats(documents(spark, [])).count() == 0


def test_no_cross_join(spark, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = d.remove_repeats(documents(spark, passages(60)))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
