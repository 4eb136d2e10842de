import zlib
from collections import defaultdict

from llm_rows import documents, odd_rows, with_clashing_columns

from tillmark.llm import sharding as s


def test_shards_have_near_equal_bytes_and_gapless_places(spark, tmp_path):
    rows = [(n, "x" * (n * 37 % 900)) for n in range(3000)]
    found = s.assign_shards(documents(spark, rows), 40, f"{tmp_path}/map").collect()
    texts = dict(rows)
    places, loads = defaultdict(list), defaultdict(int)
    for row in found:
        text = texts[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert (row["law"], row["grown_shard"]) == ("bytes", None)
        places[row["shard"]].append(row["slot"])
        loads[row["shard"]] += row["size"]
    assert len(found) == 3000 and sorted(loads) == list(range(40))
    assert max(loads.values()) < 1.03 * min(loads.values())
    assert all(sorted(own) == list(range(len(own))) for own in places.values())


def test_odd_rows_and_an_empty_table(spark, tmp_path):
    frame = with_clashing_columns(documents(spark, odd_rows()))
    found = s.assign_shards(frame, 3, f"{tmp_path}/a").collect()
    assert len(found) == len(odd_rows())
    assert sum(row["size"] for row in found) == sum(len((t or "").encode()) + 16 for _, t in odd_rows())
    assert s.assign_shards(documents(spark, []), 3, f"{tmp_path}/b").count() == 0


def test_maps_are_stored_by_version_and_edited(spark, tmp_path):
    sizes = {slot: 100 + slot % 7 for slot in range(s.SLOTS)}
    first = s.first_map(sizes, 8)
    s.store_map(spark, first, f"{tmp_path}/m")
    assert s.load_map(spark, f"{tmp_path}/m", 1) == first
    grown = s.rebalance(first, sizes, 9)
    s.store_map(spark, grown, f"{tmp_path}/m")
    assert s.load_map(spark, f"{tmp_path}/m", 2) == grown and grown.version == 2
    loads = s.load_of(grown, sizes)
    assert max(loads) <= 1.03 * min(loads)
    moved = [slot for slot in range(s.SLOTS) if first.owner[slot] != grown.owner[slot]]
    # Only what the new shard needs moves.
    assert len(moved) <= s.SLOTS / 9 * 1.1
    shrunk = s.rebalance(grown, sizes, 5)
    assert set(shrunk.owner) == set(range(5)) and max(s.load_of(shrunk, sizes)) <= 1.03 * min(s.load_of(shrunk, sizes))


def test_no_python_in_the_plan(spark, tmp_path):
    frame = s.assign_shards(documents(spark, [(1, "a")]).coalesce(1), 2, f"{tmp_path}/m")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
