import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from llm_rows import documents, odd_rows, with_clashing_columns, words

from tillmark.llm import chains, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = list(zip(found, found[1:], found[2:], strict=False))
    often = Counter(windows)
    covered = {at + k for at, window in enumerate(windows) if often[window] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    return len(found), sum(map(len, found)), symbols, duplicates, len(covered), failed


def test_base_counts(spark):
    rng = random.Random(1)
    rows = odd_rows() + [(n, words(rng, rng.randrange(120), 12).replace(" w3", "\n#w3 é")) for n in range(100, 160)]
    found = quality.judge(with_clashing_columns(documents(spark, rows)), quality.NO_FIELD).collect()
    got = sorted(
        repr((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
        for r in found
    )
    assert got == sorted(repr((doc_id, *brute(text))) for doc_id, text in rows)
    # Without a field every line is content.
    assert all(r["kept"] == (not r["base_failed"]) for r in found)


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = rng.integers(0, 6, 4)
        first = np.concatenate([[0], np.cumsum(lengths)])
        scores, transition = rng.normal(size=(first[-1], 3)), rng.normal(size=(3, 3))
        labels = chains.viterbi(scores, first, transition)
        for a, b in zip(first, first[1:], strict=False):
            def value(path, a=a):
                own = sum(scores[a + t, s] for t, s in enumerate(path))
                return own + sum(transition[s, t] for s, t in zip(path, path[1:], strict=False))

            best = max(product(range(3), repeat=int(b - a)), key=value)
            assert value(tuple(labels[a:b])) == pytest.approx(value(best))


def test_expectations_sum_over_all_labellings():
    rng = np.random.default_rng(4)
    scores, transition, first = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), np.array([0, 3, 5])
    share, pairs = chains.expected(scores, first, transition)
    expected, steps = np.zeros((5, 2)), np.zeros((2, 2))
    for a, b in ((0, 3), (3, 5)):
        weights = {}
        for path in product(range(2), repeat=b - a):
            value = sum(scores[a + t, s] for t, s in enumerate(path))
            weights[path] = np.exp(value + sum(transition[s, t] for s, t in zip(path, path[1:], strict=False)))
        total = sum(weights.values())
        for path, weight in weights.items():
            for t, s in enumerate(path):
                expected[a + t, s] += weight / total
            for s, t in zip(path, path[1:], strict=False):
                steps[s, t] += weight / total
    assert np.allclose(share, expected) and np.allclose(pairs, steps)


def test_the_field_learns_boilerplate_from_labels(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for n in range(300):
        good = n % 3 > 0
        lines = []
        for _ in range(12):
            line = words(rng, 9, 5000).capitalize() + "."
            lines.append(line if good else " ".join(f"{w}$$$" for w in line.split()))
        rows.append((n, "\n".join(lines)))
        labels.append((n, int(good), 0))
    docs = documents(spark, rows)
    field = quality.train(docs, spark.createDataFrame([*labels, (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"))
    found = {row["doc_id"]: row for row in quality.judge(docs, field).collect()}
    assert sum(found[n]["kept"] == bool(good) for n, good, _ in labels) >= 0.98 * len(labels)


def test_both_kinds_of_line_in_one_document(spark):
    """Good documents hold some boilerplate and the others some content; only documents are labelled."""
    rng = random.Random(8)

    def line(kind):
        if kind == quality.CONTENT:
            return words(rng, 10, 5000).capitalize() + "."
        return rng.choice((" | ".join(words(rng, 6, 5000).split()), "## " + words(rng, 2, 50).upper() + " >>"))

    rows, labels, kinds = [], [], {}
    for n in range(400):
        good, of = n % 4 > 0, []
        while len(of) < 14:
            other = rng.random() < 0.25
            of += [quality.CONTENT if good != other else quality.BOILERPLATE] * rng.randrange(1, 4)
        rows.append((n, "\n".join(line(kind) for kind in of)))
        labels.append((n, int(good), 0))
        kinds[n] = of
    docs = documents(spark, rows)
    field = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    right = total = 0
    for n, text in rows:
        lines = quality.measure(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        found = quality.label_lines(lines, field)
        right, total = right + int((found == kinds[n]).sum()), total + len(found)
    assert right >= 0.9 * total
    share = {row["doc_id"]: row["content_share"] for row in quality.judge(docs, field).collect()}
    mixed = [n for n, of in kinds.items() if len(set(of)) == 2]
    assert len(mixed) > 250 and sum(0 < share[n] < 1 for n in mixed) >= 0.9 * len(mixed)


def test_labels_behind_noisy_copies():
    """Chains in runs of two hidden labels, whose one given label is the more frequent one's."""
    rng = np.random.default_rng(2)
    hidden, first = [], [0]
    for n in range(300):
        rare = rng.random(6) < 0.2
        hidden += np.repeat(np.where(rare, 1 - n % 2, n % 2), 2).tolist()
        first.append(len(hidden))
    hidden, first = np.array(hidden), np.array(first)
    features = np.stack([np.ones(len(hidden)), rng.random(len(hidden)) < np.where(hidden == 1, 0.9, 0.1)], axis=1).astype(float)
    given = np.repeat(np.arange(300) % 2, 12)
    weights, transition = chains.train_latent_field(features, first, given, 2, 0.65)
    assert (chains.viterbi(features @ weights, first, transition) == hidden).mean() > 0.88


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    field = quality.train(documents(spark, []), labels)
    assert field is quality.NO_FIELD and quality.judge(documents(spark, []), field).count() == 0


def test_regular_structure_does_not_deceive_hashes():
    """Words and lines of two letters in the order of Thue and Morse, and the same with the letters exchanged."""
    from tillmark.llm import textbytes

    for length in (16, 17, 512, 1024, 2048, 4096, 8192):
        order = [bin(n).count("1") % 2 for n in range(length)]
        for one, other in (("a", "b"), ("aXbYcZdQ", "bXaYcZdQ")):
            left = "".join((one, other)[bit] for bit in order).encode()
            right = "".join((other, one)[bit] for bit in order).encode()
            data = np.frombuffer(left + b" " + right + b" " + left, np.uint8)
            n = len(left)
            hashes = textbytes.Hasher(data)(np.array([0, n + 1, 2 * n + 2]), np.array([n, 2 * n + 1, 3 * n + 2]))
            assert hashes[0] == hashes[2] != hashes[1]


def test_hashes_of_short_stretches_tell_zeros_and_lengths_apart():
    from tillmark.llm import textbytes

    data = np.frombuffer(b"a\0a\0\0" + b"x" * 40, np.uint8)
    spans = [(0, 0), (0, 1), (0, 2), (2, 3), (2, 4), (2, 5), (5, 21), (5, 22), (6, 22), (len(data), len(data))]
    hashes = textbytes.Hasher(data)(*np.array(spans).T).tolist()
    assert hashes[1] == hashes[3] and hashes[2] == hashes[4] and hashes[6] == hashes[8] and hashes[0] == hashes[9]
    assert len(set(hashes)) == 6
