"""Partitioned Parquet on a disk that Hadoop has no native library for.

There Spark's writer starts a process for every file, checksum and directory that it makes, to set
its permissions, which takes far longer than writing a few rows. Here the tasks write the same
files with Arrow and set the same permissions by a call. Spark deals, sorts and repeats tasks
as ever, and a file is in the table only when all tasks have written theirs.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from py4j.java_gateway import is_instance_of
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.paths import let_workers_import

HADOOP = "org.apache.hadoop.fs"
#: Rows of a directory that a task holds before it writes them.
ROWS_HELD = 250_000
#: Spark's names of compressions that Arrow writes too, and what they add to the name of a file.
CODECS = {
    "none": "", "uncompressed": "", "snappy": ".snappy", "gzip": ".gz", "zstd": ".zstd",
}
#: Directory of rows without a value, as Hive names it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: In the folder of a task: the directory that each of its files belongs to, a line for each.
PLACES = "_places"
_DIRECTORY = "_directory_"
_ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")


@dataclass(frozen=True)
class Target:
    """What a task must know of the table."""

    root: str
    job: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]  # names of directories, in the order of their columns
    codec: str
    metadata: dict[str, str]
    rows_per_file: int
    bytes_per_checksum: int
    umask: int
    replace: bool  # directories that get rows lose those they have

    @property
    def waiting(self) -> str:
        return f"{self.root}/_waiting-{self.job}"


def disk_folder(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` is on the disk, if Hadoop would start processes to write there."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if (
        jvm.org.apache.hadoop.io.nativeio.NativeIO.isAvailable()
        or not is_instance_of(spark.sparkContext._gateway, files, f"{HADOOP}.LocalFileSystem")
        or jvm.java.lang.System.getProperty("sun.jnu.encoding") != "UTF-8"
    ):
        return None
    return files.makeQualified(target).toUri().getPath()


def codec(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.parquet.compression.codec").lower()


def write_directories(
    rows: DataFrame,
    path: str,
    columns: Sequence[str],
    *,
    overwrite: bool,
    dynamic: bool,
    max_records_per_file: int,
) -> None:
    """Write ``rows``, as they are dealt to tasks, below ``disk_folder`` of ``path``.

    Files, their checksums, names of directories and ``_SUCCESS`` are those of Spark's writer, and
    so is what is replaced: everything, or with ``dynamic`` the directories that get rows.
    Tasks write to folders of their own. When all are done, the files of those that Spark
    took are moved to their places, by tasks again; moving them twice does no harm.
    """
    spark = rows.sparkSession
    let_workers_import(spark)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    root = hadoop.Path(path)
    files = root.getFileSystem(conf)
    data = rows.select(*[name for name in rows.columns if name not in columns])
    target = Target(
        root=disk_folder(spark, path),
        job=str(uuid.uuid4()),
        columns=tuple(data.columns),
        keys=tuple(columns),
        codec=codec(spark),
        metadata={
            "org.apache.spark.version": spark.version,
            "org.apache.spark.sql.parquet.row.metadata": data.schema.json(),
        },
        rows_per_file=max_records_per_file,
        bytes_per_checksum=conf.getInt("file.bytes-per-checksum", 512),
        umask=hadoop.permission.FsPermission.getUMask(conf).toShort(),
        replace=overwrite and dynamic,
    )
    texts = [F.col(name).cast("string") for name in columns]
    names = [f"{_DIRECTORY}{number}" for number in range(len(columns))]
    named = rows.select(
        *data.columns, *[F.when(text != "", text).alias(name) for text, name in zip(texts, names)]
    )
    if overwrite and not dynamic:
        files.delete(root, True)
    files.mkdirs(root)
    try:
        written = named.sortWithinPartitions(*names).mapInArrow(
            partial(_write, target), "folder string, files long"
        )
        folders = [(row.folder,) for row in written.collect()]
        if folders:
            tasks = min(len(folders), spark.sparkContext.defaultParallelism)
            spark.createDataFrame(folders, "folder string").repartition(tasks).mapInArrow(
                partial(_move, target), "files long"
            ).collect()
    finally:
        shutil.rmtree(target.waiting, ignore_errors=True)
    if conf.getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True):
        files.create(hadoop.Path(root, "_SUCCESS")).close()


def _escaped(text: str) -> str:
    return _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", text)


def _make(folder: str, umask: int) -> None:
    """``folder`` and those above it that are missing."""
    if os.path.isdir(folder):
        return
    _make(os.path.dirname(folder), umask)
    try:
        os.mkdir(folder)
        os.chmod(folder, 0o777 & ~umask)
    except FileExistsError:
        pass  # another task made it


def _checksum(file: str, target: Target) -> None:
    """The file beside ``file`` that Hadoop compares it with when it is read."""
    size = target.bytes_per_checksum
    folder, name = os.path.split(file)
    beside = f"{folder}/.{name}.crc"
    with open(file, "rb") as written, open(beside, "wb") as sums:
        sums.write(b"crc\0" + size.to_bytes(4, "big"))
        while block := written.read(size * 2048):
            parts = (block[at : at + size] for at in range(0, len(block), size))
            sums.write(b"".join(zlib.crc32(part).to_bytes(4, "big") for part in parts))
    for made in (file, beside):
        os.chmod(made, 0o666 & ~target.umask)


class _Files:
    """The files of a task, one after the other, and the directories they belong to."""

    def __init__(self, target: Target, folder: str, partition: int):
        self.target, self.folder, self.partition = target, folder, partition
        self.places: list[str] = []
        self.held: list[pa.RecordBatch] = []
        self.unordered: set[str] = set()  # columns with NaN among the rows held
        self.count = self.in_file = 0
        self.writer: pq.ParquetWriter | None = None

    def name(self, number: int) -> str:
        end = f"c{number:03d}{CODECS[self.target.codec]}.parquet"
        return f"part-{self.partition:05d}-{self.target.job}.{end}"

    def add(self, rows: pa.RecordBatch, place: str, unordered: set[str]) -> None:
        limit = self.target.rows_per_file
        while rows.num_rows:
            free = limit - self.in_file - self.count if limit else rows.num_rows
            self.held.append(rows.slice(0, free))
            self.unordered |= unordered
            self.count += self.held[-1].num_rows
            rows = rows.slice(free)
            if limit and self.in_file + self.count == limit:
                self.close(place)
            elif self.count >= ROWS_HELD:
                self.flush(last=False)

    def flush(self, *, last: bool) -> None:
        table = pa.Table.from_batches(self.held)
        if self.writer is None:
            # where NaN is among them, Spark's order of numbers is not that of the statistics
            known = self.unordered if last else set(self.target.columns)
            ordered = [
                field.name
                for field in table.schema
                if not pa.types.is_floating(field.type) or field.name not in known
            ]
            self.writer = pq.ParquetWriter(
                f"{self.folder}/{self.name(len(self.places))}",
                table.schema.with_metadata(self.target.metadata),
                compression="none" if not CODECS[self.target.codec] else self.target.codec,
                write_statistics=ordered,
                store_schema=False,
            )
        self.writer.write_table(table)
        self.in_file += self.count
        self.held, self.unordered, self.count = [], set(), 0

    def close(self, place: str) -> None:
        """End the file that is open or due, if any; it goes to the directory ``place``."""
        if self.count:
            self.flush(last=True)
        if self.writer is not None:
            self.writer.close()
            self.writer, self.in_file = None, 0
            _checksum(f"{self.folder}/{self.name(len(self.places))}", self.target)
            self.places.append(place)


def _starts(rows: pa.RecordBatch, names: Sequence[str]) -> list[int]:
    """Rows whose directory is not that of the row before."""
    differs = np.zeros(rows.num_rows, bool)
    differs[0] = True
    for name in names:
        codes = rows.column(name).dictionary_encode().indices.fill_null(-1).to_numpy()
        differs[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(differs).tolist()


def _write(target: Target, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write the rows of a task, in the order of their directories; names its folder."""
    task = TaskContext.get()
    folder = f"{target.waiting}/{task.partitionId()}-{task.taskAttemptId()}"
    names = [f"{_DIRECTORY}{number}" for number in range(len(target.keys))]
    heads = [f"{_escaped(key)}=" for key in target.keys]
    files, place = None, ""
    for rows in batches:
        if not rows.num_rows:
            continue
        if files is None:
            _make(folder, target.umask)
            files = _Files(target, folder, task.partitionId())
        data = rows.select(target.columns)
        unordered = {
            name
            for name in target.columns
            if pa.types.is_floating(data.schema.field(name).type)
            and pc.any(pc.is_nan(data.column(name))).as_py()
        }
        starts = _starts(rows, names)
        values = [rows.column(name).take(pa.array(starts)).to_pylist() for name in names]
        ends = [*starts[1:], rows.num_rows]
        for start, end, *texts in zip(starts, ends, *values):
            own = "/".join(
                head + (NO_VALUE if text is None else _escaped(text))
                for head, text in zip(heads, texts)
            )
            if own != place:
                files.close(place)
                place = own
            files.add(data.slice(start, end - start), place, unordered)
    if files is not None:
        files.close(place)
        with open(f"{folder}/{PLACES}", "w", encoding="utf-8", newline="\n") as named:
            named.writelines(f"{own}\n" for own in files.places)
        yield pa.RecordBatch.from_pydict({"folder": [folder], "files": [len(files.places)]})


def _clear(folder: str, job: str) -> None:
    """Delete what a directory had before the job."""
    for entry in os.scandir(folder):
        if job not in entry.name:
            if entry.is_dir(follow_symlinks=False):
                shutil.rmtree(entry.path, ignore_errors=True)
            else:
                _unless_gone(os.unlink, entry.path)


def _unless_gone(step, *paths: str) -> None:
    try:
        step(*paths)
    except FileNotFoundError:
        if len(paths) > 1 and not os.path.exists(paths[-1]):
            raise  # not moved by another try either


def _move(target: Target, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Move the files of tasks to the directories that they belong to."""
    moved = 0
    for batch in batches:
        for folder in batch.column("folder").to_pylist():
            partition = int(os.path.basename(folder).split("-")[0])
            files, cleared = _Files(target, folder, partition), None
            with open(f"{folder}/{PLACES}", encoding="utf-8", newline="\n") as named:
                places = named.read().splitlines()
            for number, place in enumerate(places):
                there, name = f"{target.root}/{place}", files.name(number)
                _make(there, target.umask)
                if target.replace and there != cleared:
                    _clear(there, target.job)
                    cleared = there
                # the checksum first: a file is never seen without
                for each in (f".{name}.crc", name):
                    _unless_gone(os.rename, f"{folder}/{each}", f"{there}/{each}")
                moved += 1
    yield pa.RecordBatch.from_pydict({"files": [moved]})
