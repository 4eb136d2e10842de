import random

import pytest
from llm_rows import documents, odd_rows, with_clashing_columns, words

from tillmark.llm import decontaminate as d

ITEMS = "item_id long, text string"


def brute_tiles(pattern, text, least):
    """Longest common run of unmarked tokens, again and again, by trying every pair of places."""
    in_pattern, in_text, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for p in range(len(pattern)):
            for t in range(len(text)):
                n = 0
                while (
                    p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n]
                    and p + n not in in_pattern and t + n not in in_text
                ):
                    n += 1
                if n > best[2]:
                    best = (p, t, n)
        p, t, n = best
        if n < least:
            return tiles
        tiles.append(best)
        in_pattern.update(range(p, p + n))
        in_text.update(range(t, t + n))


def test_tiles_are_those_of_trying_every_pair():
    rng = random.Random(6)
    for _ in range(300):
        pattern = [rng.randrange(4) for _ in range(rng.randrange(25))]
        text = [rng.choice([*pattern[k : k + 1], rng.randrange(4)]) for k in range(rng.randrange(40))]
        least = rng.randrange(2, 6)
        found = d.greedy_tiles(pattern, text, least)
        expected = brute_tiles(pattern, text, least)
        assert [n for _, _, n in found] == [n for _, _, n in expected]
        assert all(pattern[p : p + n] == text[t : t + n] for p, t, n in found)


def test_passages_are_found_moved_and_in_other_case(spark):
    rng = random.Random(1)
    items = [(n, " ".join(words(rng, 9, 900).capitalize() + "." for _ in range(4))) for n in range(30)]
    rows, expected = [], set()
    for n in range(200):
        text = words(rng, 150, 100_000)
        if n % 5 == 0:
            item, passage = items[n % 30]
            sentences = passage.split(". ")
            rng.shuffle(sentences)
            text = f"{text}\n{'! '.join(sentences).upper()} {words(rng, 50, 100_000)}"
            expected.add((n, item))
        rows.append((n, text))
    rows.append((900, " ".join(items[3][1].split()[:12])))
    found = d.leaks(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(row["doc_id"], row["item_id"]) for row in found} == expected
    assert all(row["coverage"] == 1.0 and row["matched_tokens"] == 36 for row in found)
    clean = d.keep_clean(documents(spark, rows), spark.createDataFrame(items, ITEMS))
    assert {row["doc_id"] for row in clean.collect()} == {n for n, _ in rows} - {n for n, _ in expected}


def test_several_passes_find_the_same(spark, monkeypatch):
    rng = random.Random(2)
    items = spark.createDataFrame([(n, words(rng, 20, 500)) for n in range(40)], ITEMS)
    docs = documents(spark, [(row["item_id"], "so " + row["text"] + " on") for row in items.collect()])
    once = sorted(map(tuple, d.leaks(docs, items).collect()))
    monkeypatch.setattr(d, "BENCHMARK_BYTES", 500)
    assert sorted(map(tuple, d.leaks(docs, items).collect())) == once and len(once) == 40
    assert d.keep_clean(docs, items).count() == 0


def test_scripts_without_spaces_and_their_punctuation(spark):
    passages = [
        "敏捷的棕色狐狸跳过了那只懒惰的狗", "いろはにほへとちりぬるを", "สุนัขจิ้งจอกสีน้ำตาลกระโดด", "កញ្ជ្រោងពណ៌ត្នោតលោត",
        "「one two」—three four… five six", "𠀀𠀁𠀂𠀃𠀄𠀅",
    ]
    around = ["前文很长", "まえ。", "ก่อน", "មុន", "“zero“", "𠁀"]
    rows = [(n, around[n] + passage + around[n]) for n, passage in enumerate(passages)] + [(8, "前文很长。"), (9, "zero")]
    rows.append((10, "one, two; three four! five six"))
    items = spark.createDataFrame(list(enumerate(passages)), ITEMS)
    found = d.leaks(documents(spark, rows), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(n, n) for n in range(6)} | {(10, 4)}
    assert all(r["coverage"] == 1.0 for r in found)
    assert sorted(r["doc_id"] for r in d.keep_clean(documents(spark, rows), items).collect()) == [8, 9]


def test_short_items_are_counted(spark):
    items = spark.createDataFrame([(1, "one two"), (2, "狐狸跳过"), (3, "a b c d e"), (4, None)], ITEMS)
    assert d.too_short(["one two", "狐狸跳过", "a b c d e", None]) == [True, True, False, True]
    with pytest.warns(UserWarning, match="^2 benchmark items of fewer than 5 tokens"):
        assert d.leaks(documents(spark, [(1, "one two 狐狸跳过")]), items).count() == 0


def test_odd_rows(spark):
    items = [(None, odd_rows()[0][1]), (1, None), (2, ""), (3, "one id"), (4, odd_rows()[9][1]), (4, odd_rows()[9][1])]
    frame = with_clashing_columns(documents(spark, odd_rows()))
    benchmark = spark.createDataFrame(items, ITEMS)
    found = d.leaks(frame, benchmark).collect()
    # The row without an id, and twice a repeated row with a repeated item.
    assert sorted(map(repr, ((r["doc_id"], r["item_id"]) for r in found))) == sorted(map(repr, [(None, None)] + [(8, 4)] * 4))
    kept = d.keep_clean(frame, benchmark)
    assert kept.columns == frame.columns and kept.count() == len(odd_rows()) - 3
    empty = spark.createDataFrame([], ITEMS)
    assert d.leaks(frame, empty).count() == 0 and d.keep_clean(frame, empty).count() == len(odd_rows())
    assert d.leaks(documents(spark, []), benchmark).count() == 0


def test_repetitive_texts_take_little_memory():
    """An item of one word forty times, and texts of that word: as many agreeing places as the product of both."""
    import tracemalloc

    from tillmark.llm import decontaminate

    peaks = []
    for n in (20_000, 40_000):
        tracemalloc.start()
        assert decontaminate.greedy_tiles([7] * 40, [7] * n) == [(0, 0, 40)]
        peaks.append(tracemalloc.get_traced_memory()[1] / n)
        tracemalloc.stop()
    assert max(peaks) < 400


def test_tiles_are_those_of_all_matches():
    """Against a search that looks at every pair of places, on sequences that repeat a lot."""
    import random

    from tillmark.llm import decontaminate

    def all_pairs(pattern, text, least):
        in_pattern, in_text, tiles = [False] * len(pattern), [False] * len(text), []
        while True:
            best = []
            for p in range(len(pattern)):
                for t in range(len(text)):
                    run = 0
                    while (
                        p + run < len(pattern) and t + run < len(text) and pattern[p + run] == text[t + run]
                        and not in_pattern[p + run] and not in_text[t + run]
                    ):
                        run += 1
                    best.append((run, p, t))
            longest = max((run for run, _, _ in best), default=0)
            if longest < least:
                return tiles
            for run, p, t in best:
                if run == longest and not any(in_pattern[p : p + run]) and not any(in_text[t : t + run]):
                    in_pattern[p : p + run] = in_text[t : t + run] = [True] * run
                    tiles.append((p, t, run))

    rng = random.Random(6)
    for _ in range(150):
        pattern = rng.choices(range(rng.choice((1, 2, 3, 9))), k=rng.randrange(0, 30))
        text = rng.choices(range(3), k=rng.randrange(0, 40)) + pattern[rng.randrange(0, 10) :]
        found = decontaminate.greedy_tiles(pattern, text, 3)
        assert sorted(found) == sorted(all_pairs(pattern, text, 3))
