"""The store of ingested transactions: merging, the kept histogram and replay, also where a step dies."""

import random
from collections import Counter

import pytest
from retail_rows import countries
from test_streaming import FIRST, SECOND, Shop

from tillmark import versions
from tillmark.operators import outliers
from tillmark.plans.registry import QUERIES
from tillmark.sinks import transactions as t
from tillmark.sources.layers import read_quantity_histogram, read_valid_transactions
from tillmark.streaming import ingest


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def statistics(df):
    return Counter(map(tuple, df.collect()))


def assert_right(shop):
    """Rows as a fresh ingest has them, and the kept histogram as one of those rows."""
    assert shop.stored() == shop.expected()
    kept = outliers.histogram_statistics(read_quantity_histogram(shop.spark, shop.lake))
    assert statistics(kept) == statistics(outliers.group_statistics(read_valid_transactions(shop.spark, shop.lake)))


def add_batches(shop, n, start=0):
    for i in range(start, start + n):
        shop.add(f"{i:03d}.txt", FIRST + SECOND.replace("4,A,5", f"4,A,{i}"))
    shop.ingest(maxFilesPerTrigger=1)


def entries(shop):
    return t.contents(versions.latest(shop.spark, shop.lake))["entries"]


def test_merging(shop):
    add_batches(shop, 5)
    assert [entry["level"] for entry in entries(shop)] == [0] * 5
    assert t.compact(shop.spark, shop.lake, fan_in=2) == 3
    assert sorted(entry["level"] for entry in entries(shop)) == [0, 2]
    assert_right(shop)
    before = set(folder.name for folder in (shop.folder / "lake").glob("data=*"))
    dead = t.tidy(shop.spark, shop.lake, keep=1, seconds=0)
    assert dead and before - set(dead) == set(folder.name for folder in (shop.folder / "lake").glob("data=*"))
    assert_right(shop)
    # A merged batch isn't stored again, and batches go on.
    run = next(iter(t.contents(versions.latest(shop.spark, shop.lake))["batches"]))
    raw = shop.spark.createDataFrame([], "InvoiceNo string, StockCode string, Quantity int, InvoiceDate string, CustomerID string, Country string")
    assert ingest.store_batch(raw, shop.countries, shop.lake, run, 0) == {"valid": 0, "quarantine": 0}
    add_batches(shop, 1, 5)
    assert_right(shop)


@pytest.mark.parametrize("step", ["_write_rows", "_histogram_by_quality", "_entry", "_swap"])
def test_a_merge_that_dies_at_any_step(shop, monkeypatch, step):
    add_batches(shop, 2)
    monkeypatch.setattr(t, step, lambda *_, **__: 1 / 0)
    if step == "_histogram_by_quality":
        # Not part of a merge: a batch that dies there isn't in, and is stored by the next call.
        shop.add("9.txt", FIRST)
        with pytest.raises(Exception, match="division"):
            shop.ingest()
        monkeypatch.undo()
        shop.ingest()
    else:
        with pytest.raises(ZeroDivisionError):
            t.compact(shop.spark, shop.lake, fan_in=2)
        monkeypatch.undo()
    assert_right(shop)
    t.compact(shop.spark, shop.lake, fan_in=2)
    t.tidy(shop.spark, shop.lake, keep=1, seconds=0)
    assert_right(shop)


def test_a_merge_of_a_batch_that_was_replaced_meanwhile(shop, monkeypatch):
    add_batches(shop, 2)
    raw = shop.spark.read.schema("InvoiceNo string, StockCode string, Quantity int, InvoiceDate string, CustomerID string, Country string").csv(f"{shop.raw}/000.txt")
    run = next(iter(t.contents(versions.latest(shop.spark, shop.lake))["batches"]))
    write = t._write_rows

    def replaces(*arguments):
        monkeypatch.undo()
        ingest.store_batch(raw, shop.countries, shop.lake, run, 0)
        write(*arguments)

    monkeypatch.setattr(t, "_write_rows", replaces)
    assert t.compact(shop.spark, shop.lake, fan_in=2) == 0
    assert_right(shop)
    assert t.compact(shop.spark, shop.lake, fan_in=2) == 1
    assert_right(shop)


def test_folders_stay_few_after_200_batches():
    content, most, rewritten = {"entries": [], "rulings": {}}, 0, Counter()
    for number in range(200):
        content["entries"].append({"level": 0, "reference": "r", "batches": [number]})
        while merged := t.merge_candidates(content):
            batches = [batch for entry in merged for batch in entry["batches"]]
            rewritten.update(batches)
            content["entries"] = [entry for entry in content["entries"] if entry not in merged]
            content["entries"].append({"level": merged[0]["level"] + 1, "reference": "r", "batches": batches})
        most = max(most, len(content["entries"]))
    assert sorted(batch for entry in content["entries"] for batch in entry["batches"]) == list(range(200))
    assert most <= 3 * (t.FAN_IN - 1) and max(rewritten.values()) <= 3


def test_histogram_whatever_the_order_of_batches(shop):
    rng = random.Random(1)
    batches = []
    for number in range(4):
        text = "".join(f"{n},{rng.choice('AB')},{rng.choice(['', 1, 2, 70])},01/02/2024 10:00,1,{rng.choice(['1101', '9999'])}-1\n" for n in range(20))
        shop.add(f"{number}.txt", text)
        batches.append(text)
    parse = lambda number: shop.spark.read.schema("InvoiceNo string, StockCode string, Quantity int, InvoiceDate string, CustomerID string, Country string").csv(f"{shop.raw}/{number}.txt")
    for number in (2, 0, 3, 0, 1, 2):
        ingest.store_batch(parse(number), shop.countries, shop.lake, "run", number)
    assert t.contents(versions.latest(shop.spark, shop.lake))["batches"] == {"run": [[0, 3]]}
    assert_right(shop)


def test_statistics_read_no_transaction(shop, capsys):
    add_batches(shop, 1)
    kept = read_quantity_histogram(shop.spark, shop.lake)
    rows = {entry["rows"] for entry in entries(shop)}
    assert not [file for file in kept.inputFiles() if any(folder in file for folder in rows)]


def test_ranges_of_ids():
    ranges = []
    for number in (5, 3, 4, 9, 0, 3):
        ranges = t.with_id(ranges, number)
    assert ranges == [[0, 0], [3, 5], [9, 9]]
    assert [n for n in range(11) if t.holds(ranges, n)] == [0, 3, 4, 5, 9]


def test_replay(shop):
    add_batches(shop, 2)
    uk, france, new = ("1101", "United Kingdom"), ("1102", "France"), ("9999", "New Country")
    for step, listed in enumerate([[uk, france, new], [new], [uk, new, (None, "none")], [uk, france]]):
        shop.countries = countries(shop.spark, listed)
        moved = ingest.replay_countries(shop.countries, shop.lake)
        assert sum(moved.values()) > 0
        assert_right(shop)
        # Again: nothing differs, nothing moves.
        number = versions.latest(shop.spark, shop.lake).number
        assert ingest.replay_countries(shop.countries, shop.lake) == {"valid": 0, "quarantine": 0}
        assert versions.latest(shop.spark, shop.lake).number == number
        # Batches that come later, checked by the new table, and merging, which puts rows where they belong.
        add_batches(shop, 1, 2 + step)
        assert_right(shop)
        if step == 1:
            t.compact(shop.spark, shop.lake, fan_in=2)
            t.tidy(shop.spark, shop.lake, keep=1, seconds=0)
            assert_right(shop)
    t.compact(shop.spark, shop.lake, fan_in=2)
    assert_right(shop)


def test_a_replay_that_dies(shop, monkeypatch):
    add_batches(shop, 1)
    before = shop.stored()
    shop.countries = countries(shop.spark, [("9999", "New Country")])
    monkeypatch.setattr(versions.storage, "create_text", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.replay_countries(shop.countries, shop.lake)
    monkeypatch.undo()
    assert shop.stored() == before
    assert ingest.replay_countries(shop.countries, shop.lake) == {"valid": 1, "quarantine": 3}
    assert_right(shop)


def test_replay_reads_rows_of_changed_keys_only(shop, monkeypatch):
    add_batches(shop, 1)
    seen = []
    real = t._write_delta

    def spy(stored, differing, folder):
        real(stored, differing, folder)
        keys = [row.CountryID for row in differing.collect()]
        plan = stored.filter(stored.CountryID.isin(keys))._jdf.queryExecution().executedPlan().toString()
        seen.append((sorted(keys), "PushedFilters: [In(CountryID" in plan or "EqualTo(CountryID" in plan))

    monkeypatch.setattr(t, "_write_delta", spy)
    ingest.replay_countries(countries(shop.spark, [("1101", "United Kingdom"), ("9999", "New")]), shop.lake)
    assert seen == [(["1102", "9999"], True)]


def test_queries_are_registered():
    assert {"ingest_compacted", "ingest_quantity_stats", "ingest_replayed", "daily_sales_incremental"} <= set(QUERIES)
