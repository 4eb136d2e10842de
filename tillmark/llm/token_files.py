"""Token files: flat unsigned integers plus 64-bit offsets, written by many tasks and read by memory mapping.

Documents are put in order of doc_id by range, each task writes one file of ids and one of offsets, and prefix sums
over the number of ids per file say where each file starts in the whole.

Layout of a folder:

* ``<name>.ids``: the ids of the file's documents one after the other, little-endian, 16 bits where the vocabulary fits
  and else 32 bits.
* ``<name>.offsets``: little-endian 64-bit integers: ``documents + 1`` offsets (in ids, from the start of the file),
  then the doc_id of each document (0 for NULL; those lie first).
* ``files``: Parquet rows (place, name, width, documents, without_id, tokens, first_document, first_token).

A task that is run again writes files under new names. Only the names that finished tasks return are in ``files``, so
what a lost task leaves is never read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.bpe import Splitter, TextEncoder, built, read_vocabulary
from tillmark.llm.rows import chunks, slices

WRITTEN = "place int, name string, width int, documents long, without_id long, tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Entries of each worker's table of remembered pieces; asking the library costs more than a table does.
REMEMBERED = 800_000

#: Documents that a reader returns at a time.
BATCH = 4096


def library_text_encoder(content: str) -> TextEncoder:
    splitter = Splitter(content)
    model = splitter.tokenizer.model
    return TextEncoder(splitter, lambda piece: [token.id for token in model.tokenize(piece)], REMEMBERED)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text), append ``end`` to each, write the files; returns the rows of ``files``.

    Order: doc_id ascending, NULL first, rows of one doc_id in order of a hash of their text. A NULL text counts as
    empty and holds the end id alone. An empty table writes no ids. Other columns are ignored. ``folder`` must be one
    that all executors share.
    """
    spark = docs.sparkSession
    content = read_vocabulary(vocabulary)
    described = json.loads(content)
    highest = max([end, *described["model"]["vocab"].values(), *(t["id"] for t in described["added_tokens"])])
    width = 2 if highest < 1 << 16 else 4
    shared = spark.sparkContext.broadcast(content)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = built(library_text_encoder, shared.value)
        system, root = _opened(folder)
        name = uuid.uuid4().hex
        offsets, keys, without_id, tokens = [np.zeros(1, "<i8")], [], 0, 0
        ending = np.array([end], "<u4").tobytes()
        with system.open_output_stream(f"{root}/{name}.ids") as file:
            for batch in slices(batches):
                packed = [encoder.packed(text) + ending for text in batch.column("text").to_pylist()]
                lengths = np.fromiter(map(len, packed), "<i8", len(packed)) // 4
                file.write(np.frombuffer(b"".join(packed), "<u4").astype(f"<u{width}").tobytes())
                offsets.append(tokens + np.cumsum(lengths, dtype="<i8"))
                tokens += int(lengths.sum())
                column = batch.column("doc_id")
                without_id += column.null_count
                keys.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        with system.open_output_stream(f"{root}/{name}.offsets") as file:
            for values in (*offsets, *keys):
                file.write(values.tobytes())
        row = {"place": TaskContext.get().partitionId(), "name": name, "width": width}
        row |= {"documents": sum(map(len, keys)), "without_id": without_id, "tokens": tokens}
        yield pa.RecordBatch.from_pylist([row], pa.schema([
            ("place", pa.int32()), ("name", pa.string()), ("width", pa.int32()),
            ("documents", pa.int64()), ("without_id", pa.int64()), ("tokens", pa.int64()),
        ]))

    system, root = _opened(folder)
    system.create_dir(root, recursive=True)
    columns = docs.select(F.col("doc_id").cast("long"), "text")
    # A second key splits rows that share a doc_id, as NULL ids might.
    order = ["doc_id", F.xxhash64("text")]
    written = columns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, WRITTEN)
    written.write.parquet(f"{folder}/written")
    # One row per file: the prefix sums run over the number of tasks, not over documents.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.parquet(f"{folder}/written").select(
        "*",
        F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("first_document"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first_token"),
    )
    files.coalesce(1).write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def mapped(system: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file's integers: mapped into memory where the file system is local, else read as a whole."""
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if system.get_file_info(path).size else np.zeros(0, dtype)
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (of ids as 32-bit integers).

    ``start`` counts the ids of all documents before it. With ``with_ids`` the packed ids come as well.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids = mapped(system, f"{root}/{row['name']}.ids", f"<u{row['width']}")
                index = mapped(system, f"{root}/{row['name']}.offsets", "<i8")
                offsets, keys = index[: row["documents"] + 1], index[row["documents"] + 1 :]
                for some in chunks(range(row["documents"]), BATCH):
                    first, last = some[0], some[-1] + 1
                    bounds = offsets[first : last + 1].tolist()
                    packed = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
                    lacking = np.arange(first, last) < row["without_id"]
                    columns = [
                        pa.array(np.array(keys[first:last]), pa.int64(), mask=lacking),
                        pa.array(row["first_token"] + np.array(bounds[:-1], np.int64)),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array([zlib.crc32(one) for one in packed], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns, names = [*columns, pa.array(packed, pa.binary())], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.parquet(f"{folder}/files")
    return files.repartition(max(1, files.count())).mapInArrow(read, READ + (", ids binary" if with_ids else ""))
