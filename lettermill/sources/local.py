"""Letter files on a disk that every process sees, written and read by the Python workers: a file costs some system calls there,
where Spark's writer starts a process for the rights of each and its reader lists each folder through the driver."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import suppress
from fnmatch import translate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN = "path="
NO_NAME = "__HIVE_DEFAULT_PARTITION__"  # of null and ''
MARK = "_letter_files"  # a hidden file: the folder was laid out here
READERS = 64
BATCH_BYTES, BATCH_ROWS = 4 << 20, 5_000


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system has it; None for any other file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _folder(name: str | None) -> str:
    """The folder of a letter, as Spark escapes it."""
    return COLUMN + (re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{[\]^]""", lambda m: f"%{ord(m[0]):02X}", name) if name else NO_NAME)


def _letter(folder: str) -> str | None:
    name = folder.removeprefix(COLUMN)
    return None if name == NO_NAME else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def write_files(spread: DataFrame, path: str, end: str) -> None:
    """(path, raw_text) as one file per letter and partition, each row with ``end`` after it; all of the folder appears at once.

    A file is written under the name of its attempt and then moved to its place, so a task that runs twice does no harm.
    """
    if os.path.lexists(path):
        raise FileExistsError(f"{path} exists")
    run = uuid.uuid4().hex
    place = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}-{run}")
    begun = f"{place}/_begun"
    os.makedirs(begun)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own, file = f"{begun}/{task.taskAttemptId()}", f"part-{task.partitionId():05d}-{run}.txt"
        folder, out = None, None

        def done() -> None:
            out.close()
            with suppress(FileExistsError):
                os.mkdir(f"{place}/{folder}")
            os.replace(own, f"{place}/{folder}/{file}")

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                to = _folder(name.as_py())
                if to != folder:
                    if out:
                        done()
                    folder, out = to, open(own, "wb")
                if text.is_valid:
                    out.write(text.as_buffer())
                out.write(end.encode())
        if out:
            done()
        yield from ()

    try:
        named = spread.select(F.nullif(F.make_valid_utf8("path"), F.lit("")).alias("path"), F.col("raw_text").cast("binary").alias("raw_text"))
        named.sortWithinPartitions("path").mapInArrow(write, "none int").write.format("noop").mode("overwrite").save()
        shutil.rmtree(begun)
        for name in (MARK, "_SUCCESS"):
            open(f"{place}/{name}", "wb").close()
        os.rename(place, path)
    except BaseException:
        shutil.rmtree(place, ignore_errors=True)
        raise


def read_files(spark: SparkSession, path: str, suffix: str) -> DataFrame | None:
    """(path, raw_text) of the files in a folder that ``write_files`` has laid out; None for any other folder or an odd ``suffix``.

    One task lists the folders of the letters and deals them out; what is in them is listed and read where it is needed.
    """
    if not os.path.isfile(f"{path}/{MARK}") or not re.fullmatch(r"[\w.*?-]+", suffix):
        return None
    fits = re.compile(translate(suffix)).match

    def folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in (row for batch in batches for row in range(batch.num_rows)):
            names = []
            with os.scandir(path) as entries:
                for entry in entries:
                    if entry.name.startswith(COLUMN):
                        names.append(os.fsencode(entry.name))
                    if len(names) == BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary())], ["folder"])
                        names = []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary())], ["folder"])

    def files(place: str) -> Iterator[str]:
        with os.scandir(place) as entries:
            for entry in entries:
                if _hidden(entry.name):
                    continue
                if entry.is_dir():
                    yield from files(entry.path)
                elif fits(entry.name):
                    yield entry.path

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["path", "raw_text"])

        names, texts, size = [], [], 0
        for batch in batches:
            for folder in map(os.fsdecode, batch.column(0).to_pylist()):
                for file in files(f"{path}/{folder}"):
                    with open(file, "rb", 0) as f:
                        texts.append(f.read())
                    names.append(_letter(folder))
                    size += len(texts[-1])
                    if size >= BATCH_BYTES or len(texts) == BATCH_ROWS:
                        yield out()
                        names, texts, size = [], [], 0
        yield out()

    listed = spark.range(0, 1, 1, 1).mapInArrow(folders, "folder binary")
    found = listed.repartition(max(READERS, 2 * spark.sparkContext.defaultParallelism), "folder").mapInArrow(read, "path string, raw_text binary")
    return found.select("path", F.col("raw_text").cast("string").alias("raw_text"))
