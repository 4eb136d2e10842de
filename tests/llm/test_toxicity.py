import random
import zlib

import numpy as np
from llm_rows import documents, odd_rows, with_clashing_columns, words

from tillmark.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=600):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        sentences = [words(rng, 8, 3000) + "." for _ in range(rng.randrange(3, 12))]
        toxic = i % 4 == 0
        if toxic:
            sentences.insert(rng.randrange(len(sentences)), f"you {rng.choice(['grobian', 'grobians', 'blockhead'])} {words(rng, 4, 3000)}!")
        rows.append((i, " ".join(sentences)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_documents_are_scored(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    found = {row["doc_id"]: row for row in toxicity.score(docs, model, offending=True).collect()}
    unseen = [(n, toxic) for n, _, toxic in labels if zlib.crc32(str(n).encode()) % 5 == 0]
    right = sum((found[n]["score"] >= 0.5) == bool(toxic) for n, toxic in unseen)
    assert len(unseen) > 90 and right >= 0.97 * len(unseen)
    # The sentence that made it toxic is found, and no other.
    texts = dict(rows)
    spans = [(texts[n].encode()[s["start"] : s["end"]].decode(), s["score"]) for n, t in unseen if t for s in found[n]["offending"]]
    assert spans and sum("you " in text for text, _ in spans) >= 0.97 * len(spans)
    # Noisy-or of the sentences found bounds the document's score from below.
    for n, _ in unseen:
        chances = [s["score"] for s in found[n]["offending"]]
        assert found[n]["score"] >= 1 - np.prod([1 - c for c in chances]) - 1e-9


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus(200)
    docs = documents(spark, rows)
    wrong = [(n, q, 1 - t if zlib.crc32(str(n).encode()) % 5 == 0 else t) for n, q, t in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, LABELS)) for x in (labels, wrong))
    assert a.bias == b.bias and np.array_equal(a.weights, b.weights)


def test_odd_rows_and_missing_labels(spark):
    frame = with_clashing_columns(documents(spark, odd_rows(3000)))
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (6, 1, 0)], LABELS)
    model = toxicity.train(frame, labels)
    found = toxicity.score(frame, model).collect()
    assert len(found) == len(odd_rows()) and all(0 <= row["score"] < 0.5 for row in found)
    rows, some = corpus(80)
    model = toxicity.train(documents(spark, rows + odd_rows(100)), spark.createDataFrame([*some, (None, 1, 1), (3, 1, None), (3, 1, 0)], LABELS))
    by_id = {row["doc_id"]: row["score"] for row in toxicity.score(frame, model, offending=True).collect()}
    assert by_id[1] == by_id[2] == by_id[3] == 0.0
    assert toxicity.score(documents(spark, []), model).count() == 0
