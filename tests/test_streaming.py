import datetime as dt
from collections import Counter

import pytest
from retail_rows import countries

from tillmark import schemas
from tillmark.operators import bronze, reference_check, trends
from tillmark.sinks.layers import write_layer
from tillmark.sources import files
from tillmark.sources.layers import read_layer, read_quarantine, read_valid_transactions
from tillmark.sources.messages import read_archive, stream_archive
from tillmark.streaming import ingest
from tillmark.streaming.trends import start_trends

FIRST = "1,A,2,01/02/2024 10:00,17850,1101-1\n2,B,x,bad,17850,1101-1\n3,B,4,02/03/2024 11:00,13047,9999-2\n"
SECOND = "4,A,5,03/03/2024 09:30,17850,1102-1\n5,A,1,03/03/2024 09:31,17850\n"


class Shop:
    """Raw files, a lake and what should be in it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "raw").mkdir()
        self.raw, self.lake = str(folder / "raw"), str(folder / "lake")
        self.countries = countries(spark, [("1101", "United Kingdom"), ("1102", "France"), ("1102", "France again")])

    def add(self, name, text):
        (self.folder / "raw" / name).write_text(text)

    def ingest(self, checkpoint="checkpoint", **options):
        raw = files.stream_transactions(self.spark, self.raw, **options)
        return ingest.ingest_new_files(raw, self.countries, self.lake, str(self.folder / checkpoint))

    def stored(self):
        return tuple(
            Counter(map(tuple, read(self.spark, self.lake).collect()))
            for read in (read_valid_transactions, read_quarantine)
        )

    def expected(self):
        parsed = bronze.parse_transactions(files.read_transactions(self.spark, self.raw))
        return tuple(
            Counter(map(tuple, df.collect()))
            for df in reference_check.split_by_reference(parsed, self.countries, "CountryID")
        )


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_each_file_is_stored_once(shop):
    shop.add("1.txt", FIRST)
    assert shop.ingest() == {"batches": 1, "valid": 2, "quarantine": 1}
    assert shop.stored() == shop.expected()
    assert shop.ingest() == {"batches": 0, "valid": 0, "quarantine": 0}
    shop.add("2.txt", SECOND)
    assert shop.ingest() == {"batches": 1, "valid": 1, "quarantine": 1}
    assert shop.stored() == shop.expected()


def test_stored_schema(shop):
    shop.add("1.txt", FIRST)
    shop.ingest()
    assert read_valid_transactions(shop.spark, shop.lake).schema == schemas.TRANSACTIONS


def test_many_batches(shop):
    for i in range(5):
        shop.add(f"{i}.txt", FIRST + SECOND)
    assert shop.ingest(maxFilesPerTrigger=2) == {"batches": 3, "valid": 15, "quarantine": 10}
    assert shop.stored() == shop.expected()


def test_batches_bounded_by_size(shop):
    for i in range(5):
        shop.add(f"{i}.txt", FIRST + SECOND)
    counts = shop.ingest(maxBytesPerTrigger=2 * len(FIRST + SECOND))
    assert (counts["batches"], counts["valid"], counts["quarantine"]) == (3, 15, 10)
    assert shop.stored() == shop.expected()


def test_batch_that_failed_after_its_write(shop, monkeypatch):
    shop.add("1.txt", FIRST)
    whole = ingest.store_batch

    def fails(*arguments):
        whole(*arguments)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "store_batch", fails)
    with pytest.raises(Exception, match="lost"):
        shop.ingest()
    monkeypatch.setattr(ingest, "store_batch", whole)
    shop.ingest()
    assert shop.stored() == shop.expected()


def test_batch_stored_again_with_other_countries(shop):
    shop.add("1.txt", FIRST)
    raw = files.read_transactions(shop.spark, shop.raw)
    ingest.store_batch(raw, shop.countries, shop.lake, "run", 0)
    shop.countries = countries(shop.spark, [("9999", "New Country")])
    ingest.store_batch(raw, shop.countries, shop.lake, "run", 0)
    assert shop.stored() == shop.expected()


def test_new_checkpoint_replaces_nothing(shop):
    shop.add("1.txt", FIRST)
    shop.ingest()
    shop.ingest("another")
    assert shop.stored() == tuple(bag + bag for bag in shop.expected())


def test_file_without_rows(shop):
    shop.add("1.txt", "\n")
    assert shop.ingest() == {"batches": 1, "valid": 0, "quarantine": 0}
    assert shop.stored() == (Counter(), Counter())


def test_read_since(shop):
    shop.add("1.txt", FIRST + SECOND)
    shop.ingest()
    since = read_valid_transactions(shop.spark, shop.lake, dt.date(2024, 3, 1))
    assert [row.InvoiceNo for row in since.collect()] == ["4"]


def message_rows(spark, texts):
    rows = [(None, text.encode(), "t", 0, i, None, 0) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, schemas.MESSAGES)


def test_trends_stay_current(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path)

    def run():
        query = start_trends(
            stream_archive(spark, log), lambda df: write_layer(df, "trending", out), str(tmp_path / "checkpoint")
        )
        query.awaitTermination()
        return [tuple(row) for row in read_layer(spark, "trending", out).collect()]

    for texts in (["cake", "a cake", "union jack"], ["mug cosy", "nothing"], ["union jack"] * 3):
        message_rows(spark, texts).write.mode("append").parquet(log)
        expected = [tuple(row) for row in trends.trending_products(read_archive(spark, log)).collect()]
        assert run() == expected
        assert run() == expected
