"""Tables that change from one whole version to the next.

A table is a folder. Data lies in subfolders that are written once and never changed; which of them are live says the
newest file under ``_versions``. A writer makes new folders first and its version file last, so a write that dies leaves
the old version as it was, and a reader keeps to the folders it found when it opened the table. Of two writers that
start from the same version one gets ``VersionConflict``.

The content of a version file is a JSON object. Its ``parts`` are the live folders, relative to the table.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillmark import storage

_FOLDER = "_versions"
_DATA = "data="

#: What ``tidy`` leaves for readers of older versions.
KEPT_VERSIONS = 3
KEPT_SECONDS = 24 * 3600.0


class VersionConflict(RuntimeError):
    """Another writer has changed the table meanwhile."""


@dataclass(frozen=True)
class Version:
    """``number`` counts from 1; 0 is a table that isn't there yet."""

    number: int
    content: dict


def new_folder() -> str:
    """A name for a data folder that no other has."""
    return f"{_DATA}{uuid.uuid4().hex}"


def _file(path: str, number: int) -> str:
    return f"{path}/{_FOLDER}/{number:012d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    found = storage.names(spark, f"{path}/{_FOLDER}")
    return [int(name.removesuffix(".json")) for name in found if name.endswith(".json") and not name.startswith(".")]


def at(spark: SparkSession, path: str, number: int) -> Version:
    return Version(number, json.loads(storage.read_text(spark, _file(path, number))))


def latest(spark: SparkSession, path: str) -> Version:
    found = numbers(spark, path)
    return at(spark, path, found[-1]) if found else Version(0, {})


def commit(spark: SparkSession, path: str, content: dict, after: Version) -> Version:
    """Make ``content`` the version that follows ``after``."""
    version = Version(after.number + 1, content)
    if not storage.create_text(spark, _file(path, version.number), json.dumps(content)):
        raise VersionConflict(f"{path} has a version {version.number} already")
    return version


def update(spark: SparkSession, path: str, change: Callable[[dict, int], dict], attempts: int = 20) -> Version:
    """Commit what ``change`` makes of the latest content and the new number; again if another writer was faster."""
    for _ in range(attempts):
        before = latest(spark, path)
        content = change(copy.deepcopy(before.content), before.number + 1)
        try:
            return commit(spark, path, content, before)
        except VersionConflict:
            continue
    raise VersionConflict(f"{path} is changed by others all the time")


def _parts(content: dict) -> Iterable[str]:
    return content["parts"]


def tidy(
    spark: SparkSession,
    path: str,
    live: Callable[[dict], Iterable[str]] = _parts,
    keep: int = KEPT_VERSIONS,
    seconds: float = KEPT_SECONDS,
) -> list[str]:
    """Remove data folders that no kept version names, among them those of writes that died; returns them.

    Kept are the last ``keep`` versions and all that were the latest within the last ``seconds``. Only the table's
    writer may call this, as it would take the folders of a write that is under way.
    """
    found = numbers(spark, path)
    kept = found[-max(1, keep) :]
    for number in reversed(found[: len(found) - len(kept)]):
        # A version is the latest until its successor is written.
        if storage.age(spark, _file(path, number + 1)) > seconds:
            break
        kept.insert(0, number)
    named = {part for number in kept for part in live(at(spark, path, number).content)}
    dead = []
    for folder in storage.names(spark, path) if found else ():
        if not folder.startswith(_DATA) or folder in named:
            continue
        inside = {part for part in named if part.startswith(f"{folder}/")}
        if not inside:
            dead.append(folder)
        else:
            subfolders = (f"{folder}/{name}" for name in storage.names(spark, f"{path}/{folder}") if "=" in name)
            dead += [name for name in subfolders if name not in inside]
    for name in dead:
        storage.remove(spark, f"{path}/{name}")
    for number in found:
        if number < kept[0]:
            storage.remove(spark, _file(path, number))
    return dead


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None], append: bool = False) -> Version:
    """Write ``df`` to a folder of its own with ``write(df, folder)``, then make it the whole table, or add it."""
    spark = df.sparkSession
    folder = new_folder()
    write(df, f"{path}/{folder}")

    def change(content: dict, _: int) -> dict:
        parts = content.get("parts", []) if append else []
        return {"parts": [*parts, folder], "schema": df.schema.jsonValue()}

    return update(spark, path, change)


def read(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """The table as of a version, by default the latest."""
    version = version or latest(spark, path)
    schema = StructType.fromJson(version.content["schema"])
    if not version.content["parts"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{part}" for part in version.content["parts"]])
