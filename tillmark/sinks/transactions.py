"""Ingested transactions: batches, what becomes of them, and the histogram of quantities kept beside them.

The table is one of ``versions``. Its content:

* ``entries``: the live folders of rows, each with the folder of their histogram (``quality``, product, quantity, number
  of rows), the months its valid rows lie in, the country keys it was checked against (``reference``), the batch it is,
  its level: 0 for a batch, one more than its inputs for a merged one, and how many rows and flaws its write counted.
* ``rulings``: for folders checked against older country keys, the keys on which newer ones have decided otherwise.
* ``deltas``: histograms of rows that such a ruling has moved, positive where they went and negative where they were.
* ``batches``: which batches are in, as ranges of ids per ingest run.
* ``changed``: for each month the last version in which its valid rows changed; ``shrunk``: the last in which valid rows
  were taken away.

A version names rows and histogram together, so both count a batch once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import schemas, storage, versions
from tillmark.operators import outliers
from tillmark.operators.flaws import flaws
from tillmark.operators.joins import same_key
from tillmark.operators.reference_check import in_reference, missing_reference
from tillmark.sinks.layers import write_layer
from tillmark.sinks.metrics import write_measured

VALID = "valid"
QUARANTINE = "quarantine"

#: Folders below those of the table, and the name of the month of rows without a readable date.
STORAGE_FOLDERS = ("quality", "invoice_month")
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"

#: Folders of one level that are merged into one of the next.
FAN_IN = 8

#: Changed country keys up to this number are looked up in the files' statistics, more are joined.
LISTED_KEYS = 1000

_EMPTY = {"entries": [], "rulings": {}, "deltas": [], "batches": {}, "changed": {}, "shrunk": 0, "reference": None}


def contents(version: versions.Version) -> dict:
    return {**_EMPTY, **version.content}


def live_folders(content: dict) -> Iterable[str]:
    content = {**_EMPTY, **content}
    for entry in content["entries"]:
        yield from (entry["rows"], entry["histogram"], entry["reference"])
    for ruling in content["rulings"].values():
        yield from (ruling["keys"], ruling["reference"])
    yield from (delta for delta in [*content["deltas"], content["reference"]] if delta)


def tidy(spark: SparkSession, path: str, **kept: float) -> list[str]:
    """Remove folders that no kept version names; see ``versions.tidy``."""
    return versions.tidy(spark, path, live_folders, **kept)


# --- ranges of batch ids -------------------------------------------------------------------------------------------


def with_id(ranges: list[list[int]], number: int) -> list[list[int]]:
    """Ranges of ids (first and last of each) with one more; neighbours become one, so few stay."""
    merged: list[list[int]] = []
    for low, high in sorted([*ranges, [number, number]]):
        if merged and low <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return merged


def holds(ranges: list[list[int]], number: int) -> bool:
    return any(low <= number <= high for low, high in ranges)


# --- country keys --------------------------------------------------------------------------------------------------


def key_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``CountryID`` and ``quality``: keys that are only in ``new`` (valid) or only in ``old`` (quarantine).

    Keys are counted, old ones downwards, so the tables aren't joined. The NULL key is in no reference.
    """
    signed = [
        keys.select("CountryID").distinct().select("CountryID", F.lit(sign).alias("sign"))
        for keys, sign in ((old, -1), (new, 1))
    ]
    differing = signed[0].unionAll(signed[1]).groupBy("CountryID").agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    quality = F.when(F.col("sign") > 0, F.lit(VALID)).otherwise(F.lit(QUARANTINE))
    return differing.filter("CountryID IS NOT NULL").select("CountryID", quality.alias("quality"))


def _keys(spark: SparkSession, path: str, reference: str) -> DataFrame:
    return spark.read.schema("CountryID string").parquet(f"{path}/{reference}")


def reference_of(path: str, countries: DataFrame) -> str:
    """The folder that holds the keys of ``countries``: that of the table's last reference if those are the same."""
    spark = countries.sparkSession
    last = contents(versions.latest(spark, path))["reference"]
    if last and key_changes(_keys(spark, path, last), countries).isEmpty():
        return last
    folder = versions.new_folder()
    keys = countries.select(F.col("CountryID").cast("string")).distinct().filter("CountryID IS NOT NULL")
    keys.write.parquet(f"{path}/{folder}")
    return folder


# --- batches -------------------------------------------------------------------------------------------------------


def _stored(spark: SparkSession, path: str, folders: Iterable[str]) -> DataFrame:
    reader = spark.read.schema(schemas.TRANSACTION_STORAGE).option("basePath", path)
    return reader.parquet(*[f"{path}/{folder}" for folder in folders])


def _histogram_by_quality(rows: DataFrame) -> DataFrame:
    counted = rows.groupBy("quality", "StockCode", "Quantity").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.toDF("quality", "group_key", "level", "row_count")


def _write_rows(rows: DataFrame, path: str, folder: str) -> None:
    write_layer(rows, folder, path, partition_by=STORAGE_FOLDERS, sort_by=["InvoiceTimestamp"])


def _months(spark: SparkSession, path: str, folder: str) -> list[str]:
    found = storage.names(spark, f"{path}/{folder}/quality={VALID}")
    return [name.removeprefix("invoice_month=") for name in found if name.startswith("invoice_month=")]


def _entry(spark: SparkSession, path: str, rows: str, histogram: str, reference: str, level: int) -> dict:
    months = _months(spark, path, rows)
    return {"rows": rows, "histogram": histogram, "reference": reference, "months": months, "level": level}


def is_merged(spark: SparkSession, path: str, run: str, batch_id: int) -> bool:
    """Whether a batch is in already and its folder has become part of a larger one."""
    content = contents(versions.latest(spark, path))
    known = holds(content["batches"].get(run, []), batch_id)
    return known and all(entry.get("batch") != [run, batch_id] for entry in content["entries"])


def add_batch(rows: DataFrame, path: str, reference: str, run: str, batch_id: int) -> str:
    """Store a batch (the columns of ``TRANSACTION_STORAGE``) and make it live; returns the folder of its histogram.

    A batch that is live already is replaced as a whole. The folder is scanned for the histogram once it is written,
    two columns only.
    """
    spark = rows.sparkSession
    folder, histogram = versions.new_folder(), versions.new_folder()
    counted = write_measured(rows, lambda df: _write_rows(df, path, folder), flaws("transactions"))
    _histogram_by_quality(_stored(spark, path, [folder])).write.parquet(f"{path}/{histogram}")
    entry = {**_entry(spark, path, folder, histogram, reference, 0), "batch": [run, batch_id], "measured": counted}

    def change(content: dict, number: int) -> dict:
        content = {**_EMPTY, **content}
        replaced = [one for one in content["entries"] if one.get("batch") == entry["batch"]]
        if not replaced and holds(content["batches"].get(run, []), batch_id):
            return content
        content["entries"] = [one for one in content["entries"] if one not in replaced] + [entry]
        content["batches"] = {**content["batches"], run: with_id(content["batches"].get(run, []), batch_id)}
        for one in [*replaced, entry]:
            content["changed"] = {**content["changed"], **dict.fromkeys(one["months"], number)}
        content["shrunk"] = number if replaced else content["shrunk"]
        content["reference"] = reference
        return content

    versions.update(spark, path, change)
    return histogram


def _summed(entries: list[dict]) -> dict[str, int]:
    names = ["row_count", *flaws("transactions")]
    return {name: sum(entry.get("measured", {}).get(name, 0) for entry in entries) for name in names}


def measured(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows of the table, valid and quarantined, and how many have which flaw, each batch counted once.

    They were counted while the batches were written and lie in the version file; nothing else is read.
    """
    return _summed(contents(versions.latest(spark, path))["entries"])


def batch_counts(spark: SparkSession, path: str, histogram: str) -> dict[str, int]:
    """Valid and quarantined rows of a batch, summed up from its histogram."""
    counted = spark.read.schema(schemas.QUANTITY_HISTOGRAM).parquet(f"{path}/{histogram}")
    rows = counted.groupBy("quality").agg(F.sum("row_count").alias("row_count")).collect()
    return {VALID: 0, QUARANTINE: 0, **{row.quality: row.row_count for row in rows}}


# --- reading -------------------------------------------------------------------------------------------------------


def _groups(content: dict) -> dict[str, list[dict]]:
    """The entries by the country keys that they were checked against."""
    groups: dict[str, list[dict]] = {}
    for entry in content["entries"]:
        groups.setdefault(entry["reference"], []).append(entry)
    return groups


def read_transactions(
    spark: SparkSession, path: str, quality: str, where: Column | None = None, version: versions.Version | None = None
) -> DataFrame:
    """Stored rows of one quality, of which ``where`` holds, with their storage columns.

    ``quality`` and ``invoice_month`` are folders, so filters on them prune files before any is opened. Rows whose
    country a later reference has judged otherwise count as that says: they are looked up by the few keys concerned.
    """
    content = contents(version or versions.latest(spark, path))
    frames = []
    for reference, entries in _groups(content).items():
        stored = _stored(spark, path, [entry["rows"] for entry in entries])
        stored = stored if where is None else stored.filter(where)
        as_checked = stored.filter(F.col("quality") == quality)
        ruling = content["rulings"].get(reference)
        if ruling is None:
            frames.append(as_checked)
            continue
        keys = spark.read.schema("CountryID string, quality string").parquet(f"{path}/{ruling['keys']}")
        left, came = (keys.filter(test) for test in (F.col("quality") != quality, F.col("quality") == quality))
        frames.append(missing_reference(as_checked, left, "CountryID"))
        frames.append(in_reference(stored.filter(F.col("quality") != quality), came, "CountryID"))
    if not frames:
        return spark.createDataFrame([], schemas.TRANSACTION_STORAGE)
    return reduce(DataFrame.unionAll, frames)


def read_histogram(
    spark: SparkSession, path: str, quality: str = VALID, version: versions.Version | None = None
) -> DataFrame:
    """``group_key``, ``level``, ``row_count`` of all rows of a quality; no row of a transaction is read."""
    content = contents(version or versions.latest(spark, path))
    folders = [*(entry["histogram"] for entry in content["entries"]), *content["deltas"]]
    if not folders:
        return spark.createDataFrame([], schemas.QUANTITY_HISTOGRAM).drop("quality")
    parts = spark.read.schema(schemas.QUANTITY_HISTOGRAM).parquet(*[f"{path}/{folder}" for folder in folders])
    return outliers.merged_histogram(parts.filter(F.col("quality") == quality))


def changed_months(content: dict, since: int) -> set[str]:
    """Months whose valid rows have changed after version ``since``."""
    return {month for month, number in content["changed"].items() if number > since}


# --- merging -------------------------------------------------------------------------------------------------------


def merge_candidates(content: dict, fan_in: int = FAN_IN) -> list[dict]:
    """Entries to merge next: ``fan_in`` of one level that were checked against, or later judged by, the same keys.

    A row is rewritten once per level, and at most ``fan_in - 1`` folders of each level stay, so both the number of
    folders and the work grow with the logarithm of the number of batches.
    """
    alike: dict[tuple, list[dict]] = {}
    for entry in content["entries"]:
        ruling = content["rulings"].get(entry["reference"])
        checked = ruling["reference"] if ruling else entry["reference"]
        alike.setdefault((entry["level"], checked), []).append(entry)
    full = [entries for entries in alike.values() if len(entries) >= fan_in]
    return min(full, key=lambda entries: entries[0]["level"])[:fan_in] if full else []


def compact(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> int:
    """Merge small folders into larger ones until ``merge_candidates`` finds none; returns the number of merges.

    A merge writes its folder first and is made live by one version, so whenever it dies each row is there once. What
    it leaves behind goes with the next ``tidy``.
    """
    merges = 0
    while True:
        version = versions.latest(spark, path)
        content = contents(version)
        merged = merge_candidates(content, fan_in)
        if not merged:
            return merges
        ruling = content["rulings"].get(merged[0]["reference"])
        reference = ruling["reference"] if ruling else merged[0]["reference"]
        some = versions.Version(version.number, {**content, "entries": merged})
        rows, histogram = versions.new_folder(), versions.new_folder()
        judged = [
            read_transactions(spark, path, quality, version=some).withColumn("quality", F.lit(quality))
            for quality in (VALID, QUARANTINE)
        ]
        columns = [*schemas.TRANSACTIONS.names, *STORAGE_FOLDERS]
        _write_rows(judged[0].select(*columns).unionAll(judged[1].select(*columns)), path, rows)
        # The histograms of the inputs, as they were checked: what rulings moved is in the deltas.
        parts = spark.read.schema(schemas.QUANTITY_HISTOGRAM).parquet(*[f"{path}/{one['histogram']}" for one in merged])
        sums = parts.groupBy("quality", "group_key", "level").agg(F.sum("row_count").alias("row_count"))
        sums.write.parquet(f"{path}/{histogram}")
        entry = _entry(spark, path, rows, histogram, reference, max(one["level"] for one in merged) + 1)
        entry["measured"] = _summed(merged)
        if not _swap(spark, path, merged, entry):
            return merges
        merges += 1


def _swap(spark: SparkSession, path: str, merged: list[dict], entry: dict) -> bool:
    """Make a merged folder live instead of its inputs; False if one of these has changed meanwhile."""
    swapped = True

    def change(content: dict, number: int) -> dict:
        nonlocal swapped
        content = {**_EMPTY, **content}
        swapped = all(one in content["entries"] for one in merged)
        if swapped:
            content["entries"] = [one for one in content["entries"] if one not in merged] + [entry]
            used = {one["reference"] for one in content["entries"]}
            content["rulings"] = {name: ruling for name, ruling in content["rulings"].items() if name in used}
        return content

    versions.update(spark, path, change)
    return swapped


# --- replay --------------------------------------------------------------------------------------------------------


def replay(countries: DataFrame, path: str) -> dict[str, int]:
    """Judge all stored rows by the keys of ``countries``: rows whose country was added become valid, those whose
    country was dropped go to quarantine. Returns how many rows went to either.

    The difference of the key tables is taken first; only rows of keys that differ are read, and only to find their
    months and quantities. Nothing is rewritten: readers look the keys up, and merging folders puts rows where they
    now belong. One version makes it all live, so a replay that is run again finds no difference and moves nothing.
    """
    spark = countries.sparkSession
    before = versions.latest(spark, path)
    content = contents(before)
    reference = reference_of(path, countries)
    rulings, deltas = dict(content["rulings"]), list(content["deltas"])
    changed: set[str] = set()
    moved_to = {VALID: 0, QUARANTINE: 0}
    new = _keys(spark, path, reference)
    for checked, entries in _groups(content).items():
        judged = rulings[checked]["reference"] if checked in rulings else checked
        if judged == reference:
            continue
        if checked == reference:
            rulings.pop(checked)
        else:
            keys = versions.new_folder()
            key_changes(_keys(spark, path, checked), new).write.parquet(f"{path}/{keys}")
            rulings[checked] = {"keys": keys, "reference": reference}
        differing = key_changes(_keys(spark, path, judged), new)
        delta = versions.new_folder()
        _write_delta(_stored(spark, path, [entry["rows"] for entry in entries]), differing, f"{path}/{delta}")
        counted = spark.read.schema(_DELTA).parquet(f"{path}/{delta}")
        arrived = F.sum(F.greatest("row_count", F.lit(0))).alias("arrived")
        for row in counted.groupBy("quality", "month").agg(arrived).collect():
            changed.add(NO_MONTH if row.month is None else str(row.month))
            moved_to[row.quality] += row.arrived
        deltas.append(delta)
    number = before.number + 1
    content |= {"rulings": rulings, "deltas": deltas, "reference": reference}
    content["changed"] = {**content["changed"], **dict.fromkeys(changed, number)}
    if moved_to[QUARANTINE]:
        content["shrunk"] = number
    if content != contents(before):
        versions.commit(spark, path, content, before)
    return moved_to


_DELTA = "quality string, group_key string, level int, row_count long, month int"


def _write_delta(stored: DataFrame, differing: DataFrame, folder: str) -> None:
    """Count the rows of the keys that differ per product and quantity: out of one quality and into the other."""
    listed = differing.limit(LISTED_KEYS + 1).collect()
    if len(listed) <= LISTED_KEYS:
        # A list that the Parquet reader can hold against the statistics of row groups.
        stored = stored.filter(F.col("CountryID").isin([row.CountryID for row in listed]))
    verdicts = differing.select(F.col("CountryID").alias("key"), F.col("quality").alias("verdict"))
    moved = stored.join(verdicts, same_key(stored, F.col("CountryID"), verdicts, F.col("key")))
    counted = moved.groupBy("verdict", "StockCode", "Quantity", "invoice_month").agg(F.count(F.lit(1)).alias("n"))
    other = F.when(F.col("verdict") == VALID, F.lit(QUARANTINE)).otherwise(F.lit(VALID))
    ways = F.explode(
        F.array(
            F.struct(F.col("verdict").alias("quality"), F.col("n").alias("row_count")),
            F.struct(other.alias("quality"), (-F.col("n")).alias("row_count")),
        )
    )
    both = counted.select("StockCode", "Quantity", "invoice_month", ways.alias("way"))
    both.select(
        "way.quality",
        F.col("StockCode").alias("group_key"),
        F.col("Quantity").alias("level"),
        "way.row_count",
        F.col("invoice_month").alias("month"),
    ).write.parquet(folder)
