"""Stored tables, always read with their declared schema."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schema import GOLD, SILVER


_DISCOVERY = "spark.sql.sources.parallelPartitionDiscovery"
#: How many tasks Spark lists directories in, at most.
LISTING_TASKS = f"{_DISCOVERY}.parallelism"
#: With how many directories in a folder Spark lists them in tasks, and not one after the other.
LISTING_THRESHOLD = f"{_DISCOVERY}.threshold"


@contextmanager
def listed_by_cores(spark: SparkSession) -> Iterator[None]:
    """Directories are listed by a task for each core, not by one for each directory.

    Starting a task takes longer than listing a directory of few files, and no more tasks
    than cores run at a time. A folder of more directories than cores is listed in tasks, with
    all that is below them; else there would be a job for each of the directories, and one would
    wait for the other. The session's own numbers count where they are smaller.
    """
    cores = spark.sparkContext.defaultParallelism
    before = {name: spark.conf.get(name) for name in (LISTING_TASKS, LISTING_THRESHOLD)}
    for name, value in before.items():
        spark.conf.set(name, min(int(value), cores))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: Directories that Spark finds in one scan, about: to make sense of their names takes it a time
#: that grows with the square of their number.
DIRECTORIES_PER_SCAN = 8_000
#: Folders of one level that are listed one after the other to see how many directories there are.
MOST_LISTED = 200
MOST_SCANS_AT_ONCE = 4
_PATTERN = set("{}[]*?\\")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The silver table itself, not the folder above it.

    Filters on the five partition columns prune directories; filters on the
    others reach the Parquet reader. A table of very many directories is read in several
    scans, each of some of the folders at its top. Spark then does not refuse to overwrite the
    table by rows read from it; write them elsewhere, as always (``refuse_overlap``).
    """

    def scan(group: list[str]) -> DataFrame:
        reader = spark.read.schema(SILVER)
        if len(groups) > 1:
            reader = reader.option("basePath", path)
        return reader.parquet(*group).select(*SILVER.names)

    with listed_by_cores(spark):
        groups = _groups(spark, path)
        if len(groups) == 1:
            return scan(groups[0])
        # side by side: while tasks list some, the driver makes sense of the names of others
        with ThreadPoolExecutor(min(len(groups), MOST_SCANS_AT_ONCE)) as threads:
            scans = list(threads.map(inheritable_thread_target(spark)(scan), groups))
    while len(scans) > 1:
        pairs = [scans[at : at + 2] for at in range(0, len(scans), 2)]
        scans = [reduce(DataFrame.union, pair) for pair in pairs]
    return scans[0]


def _groups(spark: SparkSession, path: str) -> list[list[str]]:
    """Folders that are read together: the table, or where it has many directories, parts of it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    level = [root] if files.exists(root) else []
    while 0 < len(level) <= MOST_LISTED:
        inside = [files.listStatus(folder) for folder in level]
        numbers = [len(found) if len(found) and found[0].isDirectory() else 0 for found in inside]
        if sum(numbers) > DIRECTORIES_PER_SCAN:
            return _packed([folder.toString() for folder in level], numbers) or [[path]]
        level = []
        for found in inside:
            for status in found:
                name = status.getPath().getName()
                if status.isDirectory() and "=" in name:
                    level.append(status.getPath())
                elif not name.startswith(("_", ".")):
                    return [[path]]  # rows that are in none of the folders below
    return [[path]]


def _packed(folders: list[str], numbers: list[int]) -> list[list[str]]:
    """Neighbours together, with about as many directories in each group as a scan should have."""
    groups, inside = [[]], 0
    for folder, number in zip(folders, numbers):
        if set(folder) & _PATTERN:
            return []  # Spark would look for what it matches
        if groups[-1] and inside + number > DIRECTORIES_PER_SCAN:
            groups.append([])
            inside = 0
        groups[-1].append(folder)
        inside += number
    return groups


#: Files whose name starts so name a version of the gold tables; readers follow the last one.
CURRENT = "CURRENT-"
#: In a version: the silver files that it was built from, and where the facts of each lie.
SOURCES = "_sources"
#: Facts of versions that are brought up to date slice by slice, in one folder for all versions.
FACTS = "facts"
#: What a fact of such a version is stored under: the build that wrote it, and its slice.
HOME, SLICE = "home", "slice"

#: In a version of silver: its units, that is what a build holds in a directory.
UNITS = "_units"
#: The files of all versions of silver.
READINGS = "readings"

_SLICED_FACT = T.StructType(
    [
        *GOLD["faktentabelle"].fields,
        T.StructField(HOME, T.StringType()),
        T.StructField(SLICE, T.StringType()),
    ]
)


def pointers(spark: SparkSession, gold_dir: str) -> list[str]:
    """Names of the files that point to versions, the one that counts last."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{gold_dir.rstrip('/')}/{CURRENT}*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.globStatus(pattern) or [])


def published_version(spark: SparkSession, gold_dir: str) -> str | None:
    root = gold_dir.rstrip("/")
    found = pointers(spark, root)
    return f"{root}/{spark.read.text(f'{root}/{found[-1]}').first()[0]}" if found else None


def gold_version(spark: SparkSession, gold_dir: str) -> str:
    """The folder of the published tables: a version, or the gold folder of a plain copy."""
    return published_version(spark, gold_dir) or gold_dir.rstrip("/")


def gold_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}"


def version_table(spark: SparkSession, version: str, table: str) -> DataFrame | None:
    """What a version tells about its files, if it does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{version}/{table}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(f"{version}/{table}")


def version_sources(spark: SparkSession, version: str) -> DataFrame | None:
    """The silver files of a version that is brought up to date slice by slice."""
    return version_table(spark, version, SOURCES)


def slice_homes(sources: DataFrame) -> list[tuple[str, str]]:
    """The build that wrote each slice; as many as there are slices."""
    return sorted(tuple(row) for row in sources.select(HOME, SLICE).distinct().collect())


def _sliced_facts(spark: SparkSession, version: str, sources: DataFrame) -> DataFrame:
    facts = f"{version.rsplit('/', 1)[0]}/{FACTS}"
    wanted = [f"{home}/{slice_}" for home, slice_ in slice_homes(sources)]
    if not wanted:
        return spark.createDataFrame([], GOLD["faktentabelle"])
    stored = spark.read.schema(_SLICED_FACT).parquet(facts)
    # on directory columns alone: other slices are not listed as input
    ours = F.concat_ws("/", HOME, SLICE).isin(wanted)
    return stored.filter(ours).select(*GOLD["faktentabelle"].names)


def read_gold_table(spark: SparkSession, gold_dir: str, table: str) -> DataFrame:
    folder = gold_version(spark, gold_dir)
    if table == "faktentabelle":
        sources = version_sources(spark, folder)
        if sources is not None:
            return _sliced_facts(spark, folder, sources)
    return spark.read.schema(GOLD[table]).parquet(gold_path(folder, table))


def read_gold(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """All four tables, of one version."""
    folder = gold_version(spark, gold_dir)
    return {table: read_gold_table(spark, folder, table) for table in GOLD}
