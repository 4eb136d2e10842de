"""Trends with a ledger: runs that are repeated, cut short, race, or find new partitions."""

import json

import pytest

from tillmark import schemas, versions
from tillmark.operators import trends
from tillmark.plans import ledger, trending
from tillmark.sinks.layers import write_layer
from tillmark.sources import messages
from tillmark.sources.layers import read_layer

CAKE, STAR = "SET OF 3 CAKE TINS PANTRY DESIGN", "GLASS STAR FROSTED T-LIGHT HOLDER"


class Log:
    """An archive of messages, a ledger and a trend table."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.archive, self.ledger = f"{folder}/archive", f"{folder}/ledger"
        self.following = {}
        spark.createDataFrame([], schemas.MESSAGES).write.parquet(self.archive)

    def add(self, texts, partition=0, topic="t"):
        first = self.following.get((topic, partition), 0)
        rows = [(None, None if t is None else t.encode(), topic, partition, first + i, None, 0) for i, t in enumerate(texts)]
        self.spark.createDataFrame(rows, schemas.MESSAGES).coalesce(1).write.mode("append").parquet(self.archive)
        self.following[topic, partition] = first + len(texts)

    def read(self, offsets):
        return messages.read_archive_from(self.spark, self.archive, offsets)

    def run(self, write=None, keywords=trends.PRODUCT_KEYWORDS):
        write = write or (lambda df, name: write_layer(df, name, self.folder))
        return ledger.refresh_from_ledger(self.spark, self.read, write, self.ledger, keywords)

    def stored(self):
        return [tuple(row) for row in read_layer(self.spark, "trending_products", self.folder).collect()]

    def expected(self, keywords=trends.PRODUCT_KEYWORDS):
        log = messages.read_archive(self.spark, self.archive)
        return [tuple(row) for row in trends.trending_products(log, keywords).collect()]


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, tmp_path)


def test_each_message_is_counted_once(log):
    assert log.run() == {"new_messages": 0, "trending_products": 0}
    log.add(["cake", "glass star", None, ""])
    log.add(["cake"], partition=3)
    assert log.run()["new_messages"] == 5
    assert log.stored() == log.expected() == [(CAKE, 2), (STAR, 1)]
    assert log.run()["new_messages"] == 0
    assert log.stored() == log.expected()
    # A partition and a topic that weren't there before, and more of an old one.
    log.add(["glass star"] * 3, partition=1)
    log.add(["glass star"], topic="it's \"another\"")
    log.add(["cake", "x"])
    assert log.run()["new_messages"] == 6
    assert log.stored() == log.expected() == [(STAR, 5), (CAKE, 3)]
    assert ledger.counted_offsets(log.spark, log.ledger) == log.following


def test_only_new_files_are_read(log):
    log.add(["cake"] * 4)
    log.add(["cake"], partition=1)
    log.run()
    log.add(["glass star", "cake"])
    new = log.read(ledger.counted_offsets(log.spark, log.ledger))
    assert [row.offset for row in new.orderBy("offset").collect()] == [4, 5]
    plan = new._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(offset,4)" in pushed


def test_a_run_that_dies_counts_nothing(log, monkeypatch):
    log.add(["cake"])
    log.run()
    log.add(["cake", "glass star"])
    # While the counts are written, before the commit, and after it while the table is written.
    monkeypatch.setattr(ledger.versions, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        log.run()
    monkeypatch.undo()
    assert ledger.counted_offsets(log.spark, log.ledger) == {("t", 0): 1}
    assert [tuple(row) for row in ledger.mention_totals(log.spark, log.ledger).collect()] == [(CAKE, 1)]
    with pytest.raises(ZeroDivisionError):
        log.run(write=lambda *_: 1 / 0)
    assert log.stored() == [(CAKE, 1)]
    assert log.run()["new_messages"] == 0
    assert log.stored() == log.expected() == [(CAKE, 2), (STAR, 1)]


def test_of_two_runs_one_counts(log):
    log.add(["cake"])
    log.run()
    log.add(["cake"])

    def read(offsets):
        log.run()
        return log.read(offsets)

    with pytest.raises(versions.VersionConflict):
        ledger.count_new(log.spark, read, log.ledger)
    log.run()
    assert log.stored() == log.expected() == [(CAKE, 2)]


def test_other_keywords_count_anew(log):
    log.add(["cake", "pan"])
    log.run()
    keywords = [("pan", "a pan")]
    assert log.run(keywords=keywords)["new_messages"] == 2
    assert log.stored() == log.expected(keywords) == [("a pan", 1)]


def test_messages_without_a_place_are_refused(log):
    log.add(["cake"])
    log.run()
    rows = [(None, b"cake", "t", 0, None, None, 0)]
    log.spark.createDataFrame(rows, schemas.MESSAGES).write.mode("append").parquet(log.archive)
    with pytest.raises(Exception, match="no topic, partition or offset"):
        log.run()


def test_offsets_for_the_connector():
    given = messages.starting_offsets("t", {("t", 1): 7, ("t", 5): 2, ("other", 0): 9}, 4)
    assert json.loads(given) == {"t": {"0": -2, "1": 7, "2": -2, "3": -2, "5": 2}}


def test_running_trends_stop_and_go_on(log, tmp_path):
    """Three drops of messages, a stop and a restart: the stored table is that of one batch over all."""
    stop_file, polls = tmp_path / "stop", []
    write = lambda df, name: write_layer(df, name, log.folder)
    stream = messages.stream_archive(log.spark, log.archive)

    def follow(stop):
        trending.follow_trends(stream, write, f"{tmp_path}/checkpoint", every="200 milliseconds", stop=stop, poll_seconds=0.2)

    def drop_twice():
        if not polls:
            log.add(["cake", "glass star"])
        elif len(polls) == 1:
            log.add(["glass star"], partition=1)
        polls.append(1)
        try:
            done = log.stored() == log.expected() and len(polls) > 2
        except Exception:
            done = False
        assert len(polls) < 200
        return done

    follow(drop_twice)
    assert log.stored() == [(STAR, 2), (CAKE, 1)]
    log.add(["cake"] * 3)
    by_file = trending.stop_when(stream, str(stop_file), seconds=60)

    def until_current():
        if log.stored() == log.expected():
            stop_file.touch()
        return by_file()

    follow(until_current)
    assert stop_file.exists() and log.stored() == [(CAKE, 4), (STAR, 2)]


def test_a_failing_stream_raises(log, tmp_path):
    log.add(["cake"])
    stream = messages.stream_archive(log.spark, log.archive)
    with pytest.raises(Exception, match="division by zero"):
        trending.follow_trends(stream, lambda *_: 1 / 0, f"{tmp_path}/checkpoint", every="1 second")


def test_time_stops(spark):
    frame = spark.range(1)
    assert trending.stop_when(frame, seconds=0)() and not trending.stop_when(frame)()
    assert not trending.stop_when(frame, seconds=600)()
