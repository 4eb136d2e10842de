import random
from collections import Counter

import pytest

from tillmark.operators import reference_check as check


@pytest.fixture
def frames(spark):
    chance = random.Random(3)
    keys = ["1101", "1102", "9999", None, ""]
    rows = [(i % 40, chance.choice(keys)) for i in range(300)]
    # The reference lists one id twice and holds a NULL.
    reference = [("1101", "a"), ("1101", "b"), ("1102", "c"), (None, "d")]
    return (
        rows,
        spark.createDataFrame(rows, "n int, CountryID string"),
        spark.createDataFrame(reference, "CountryID string, CountryName string"),
    )


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_split_is_a_partition(frames, setting, threshold):
    setting(spark__sql__autoBroadcastJoinThreshold=threshold)
    rows, df, reference = frames
    valid, quarantined = check.split_by_reference(df, reference, "CountryID")
    assert valid.columns == quarantined.columns == ["n", "CountryID"]
    is_listed = {"1101", "1102"}.__contains__
    assert Counter(map(tuple, valid.collect())) == Counter(row for row in rows if is_listed(row[1]))
    assert Counter(map(tuple, quarantined.collect())) == Counter(row for row in rows if not is_listed(row[1]))


def test_tag_agrees_with_split(frames):
    rows, df, reference = frames
    tagged = check.tag_by_reference(df, reference, "CountryID", "ok")
    assert tagged.columns == ["n", "CountryID", "ok"]
    assert Counter(map(tuple, tagged.collect())) == Counter((*row, row[1] in ("1101", "1102")) for row in rows)


def test_other_key_name(frames):
    _, df, reference = frames
    geography = reference.withColumnRenamed("CountryID", "geo_id")
    missing = check.missing_reference(df, geography, "CountryID", "geo_id")
    assert missing.count() == check.missing_reference(df, reference, "CountryID").count()


def test_valid_rows_are_not_missing(frames):
    _, df, reference = frames
    valid, _ = check.split_by_reference(df, reference, "CountryID")
    assert check.missing_reference(valid, reference, "CountryID").isEmpty()


def test_empty_sides(frames):
    rows, df, reference = frames
    nothing = reference.limit(0)
    assert check.in_reference(df, nothing, "CountryID").isEmpty()
    assert check.missing_reference(df, nothing, "CountryID").count() == len(rows)
    assert check.missing_reference(df.limit(0), reference, "CountryID").isEmpty()
