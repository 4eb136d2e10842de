"""Backups of the lake's tables that copy what is new, can be verified, and can be put back.

Tables of ``versions`` consist of folders that never change, so a folder that an earlier backup has copied isn't copied
again. A backup is a version of its own: it lists the folders of every table with number of rows and a hash of their
content, and is written when all copies are there. One that dies leaves the backups before it as they were. A restored
table has the version number and content of the original, so that incremental loads and ingests go on from there.

Not covered, as they aren't tables of versions: raw files, text reports, tables in a database and the checkpoints of
streams. An ingest that starts on a restored lake without its old checkpoint takes all raw files for new ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmark import schemas, storage, versions
from tillmark.operators.digests import digest
from tillmark.sinks import transactions

TRANSACTIONS = "transactions"

MANIFEST = "table_name string, folder string, row_count bigint, content_hash string, copied boolean"

#: What a kept folder is found to be by ``verify``.
SOUND, DAMAGED = "sound", "damaged"

#: Files that a task of a copy has open at most; with more subfolders than that it sorts the rest of its rows.
OPEN_FILES = 200

_ROWS = StructType([field for field in schemas.TRANSACTION_STORAGE.fields if field.name != "data"])


@dataclass(frozen=True)
class _Folder:
    """How the rows of a folder lie: subfolders, and their schema where files may be missing."""

    partition_by: tuple[str, ...] = ()
    schema: StructType | None = None

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return (spark.read.schema(self.schema) if self.schema else spark.read).parquet(path)

    def write(self, df: DataFrame, root: str, folder: str) -> None:
        """Rows stay in the order and in about the files that they lie in already, so none is shuffled or sorted."""
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{root}/{folder}")


def _copying(spark: SparkSession) -> SparkSession:
    """A session of its own whose tasks keep the files of several subfolders open, in place of sorting rows by these."""
    session = spark.newSession()
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    return session


def _folders(table: str, content: dict) -> dict[str, _Folder]:
    """The live folders of a version of a table."""
    if table != TRANSACTIONS:
        return {folder: _Folder() for folder in content["parts"]}
    rows = {entry["rows"] for entry in content.get("entries", ())}
    stored = _Folder(transactions.STORAGE_FOLDERS, _ROWS)
    return {folder: stored if folder in rows else _Folder() for folder in transactions.live_folders(content)}


def _digest_of(df: DataFrame) -> tuple[int, str]:
    row = df.agg(*digest(df)).first()
    return row["row_count"], f"{row['total']}:{row['parity']}"


def _copy(spark: SparkSession, kind: _Folder, source: str, root: str, folder: str) -> tuple[int, str]:
    """Copy a folder and return the digest of the copy, which is that of the original."""
    df, seen = kind.read(_copying(spark), source), Observation()
    kind.write(df.observe(seen, *digest(df)), root, folder)
    found = _digest_of(kind.read(spark, f"{root}/{folder}"))
    # What was seen on the way counts rows of repeated tasks twice, so a difference isn't the last word.
    if (seen.get["row_count"], f"{seen.get['total']}:{seen.get['parity']}") != found and _digest_of(df) != found:
        raise OSError(f"{root}/{folder} isn't a copy of {source}")
    return found


def tables_of(spark: SparkSession, lake: str) -> Iterator[str]:
    """The tables of versions in a lake and in the folders right below it, by their path from the lake."""
    for name in storage.names(spark, lake):
        if versions.numbers(spark, f"{lake}/{name}"):
            yield name
        else:
            for inner in storage.names(spark, f"{lake}/{name}"):
                if versions.numbers(spark, f"{lake}/{name}/{inner}"):
                    yield f"{name}/{inner}"


def _version(spark: SparkSession, destination: str, number: int | None) -> versions.Version:
    version = versions.at(spark, destination, number) if number else versions.latest(spark, destination)
    if not version.number:
        raise FileNotFoundError(f"{destination} has no backup")
    return version


def _each(content: dict) -> Iterator[tuple[str, str, _Folder, dict]]:
    for table, kept in sorted(content["tables"].items()):
        kinds = _folders(table, kept["content"])
        for folder, copy in sorted(kept["folders"].items()):
            yield table, folder, kinds[folder], copy


def backup(spark: SparkSession, lake: str, destination: str, tables: Iterable[str] | None = None) -> DataFrame:
    """Back up the latest versions of all tables of the lake, or of those named; returns the manifest.

    The manifest has a row per folder: table_name, folder, row_count, content_hash, and whether it had to be copied.
    Each table is taken as of one version; tables that are changed meanwhile may be of different times. Versions are
    kept a day, so a copy has that long. Copies of backups that died are left under ``destination/data``.
    """
    before = versions.latest(spark, destination)
    known = before.content.get("tables", {})
    content: dict = {"tables": {}}
    copied = set()
    for table in sorted(tables if tables is not None else tables_of(spark, lake)):
        path, version = f"{lake}/{table}", versions.latest(spark, f"{lake}/{table}")
        earlier = dict(known.get(table, {}).get("folders", {}))
        folders = {}
        for folder, kind in _folders(table, version.content).items():
            if folder not in earlier:
                stored = f"data/{uuid.uuid4().hex}"
                rows, content_hash = _copy(spark, kind, f"{path}/{folder}", destination, stored)
                earlier[folder] = {"stored": stored, "row_count": rows, "content_hash": content_hash}
                copied.add((table, folder))
            folders[folder] = earlier[folder]
        content["tables"][table] = {"number": version.number, "content": version.content, "folders": folders}
    versions.commit(spark, destination, content, before)
    rows = [
        (table, folder, copy["row_count"], copy["content_hash"], (table, folder) in copied)
        for table, folder, _, copy in _each(content)
    ]
    return spark.createDataFrame(rows, MANIFEST)


def verify(spark: SparkSession, destination: str, number: int | None = None) -> DataFrame:
    """Read every copy of a backup (the latest, or that of a number) again: table_name, folder, state.

    A copy is damaged if it can't be read or if its rows aren't those that were copied.
    """
    states = []
    for table, folder, kind, copy in _each(_version(spark, destination, number).content):
        try:
            found = _digest_of(kind.read(spark, f"{destination}/{copy['stored']}"))
        except (PySparkException, Py4JJavaError):
            found = None
        sound = found == (copy["row_count"], copy["content_hash"])
        states.append((table, folder, SOUND if sound else DAMAGED))
    return spark.createDataFrame(states, "table_name string, folder string, state string")


def restore(spark: SparkSession, destination: str, lake: str, number: int | None = None) -> dict[str, int]:
    """Put the tables of a backup (the latest, or that of a number) into a lake; returns the rows put back per table.

    A table that the lake has already is never touched: the call raises before it changes anything. Every copy is
    compared with its digest, and a table becomes visible when all of its folders are there and sound.
    """
    content = _version(spark, destination, number).content
    there = [table for table in content["tables"] if versions.numbers(spark, f"{lake}/{table}")]
    if there:
        raise FileExistsError(f"{lake} has {', '.join(sorted(there))} already")
    counts: dict[str, int] = dict.fromkeys(sorted(content["tables"]), 0)
    for table, folder, kind, copy in _each(content):
        found = _copy(spark, kind, f"{destination}/{copy['stored']}", f"{lake}/{table}", folder)
        if found != (copy["row_count"], copy["content_hash"]):
            raise OSError(f"the copy of {table}/{folder} is damaged")
        counts[table] += copy["row_count"]
    for table in counts:
        kept = content["tables"][table]
        versions.commit(spark, f"{lake}/{table}", kept["content"], versions.Version(kept["number"] - 1, {}))
    return counts
