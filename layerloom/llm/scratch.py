"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The name of the column that ``numbered_scan`` adds.
ROW = "_row"

#: Whether Spark deletes the shuffle files of a query when it ends, not when its plan is collected as garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def numbered_scan(table: DataFrame, name: str = ROW) -> DataFrame:
    """A table read from files, with its rows numbered; reading the same files again numbers them alike."""
    return table.withColumn(name, F.monotonically_increasing_id())


def free_name(table: DataFrame, name: str = ROW) -> str:
    """``name``, with as many underscores before it as no column of the table has."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else the folder the context was given."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        raise ValueError("Set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


class Scratch:
    """Tables written to cut lineage; later reads survive a lost executor.

    ``write`` stores a frame and reads it back. ``drop`` removes tables no later step needs; what is
    left is removed when the Python process ends, because the result may still read it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/layerloom-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.tables: list[str] = []
        atexit.register(self.close)

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        with self._cleaned():
            df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        table._scratch_path = path  # keeps the table's place with the table
        return table

    def write_buckets(self, df: DataFrame, column: str, n: int) -> DataFrame:
        """A table in the warehouse in ``n`` buckets of ``column``, so that joins by it need no shuffle."""
        name = f"layerloom_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("compression", "zstd").bucketBy(n, column)
        with self._cleaned():
            writer.sortBy(column).saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def numbered(self, docs: DataFrame, name: str, row_column: str | None) -> DataFrame:
        """``docs`` with a unique integer ``name`` that is the same each time the rows are read.

        ``row_column`` is such a column already. Without it rows are numbered in a stored copy, since a
        plan that shuffles may deal its rows out anew when it runs again.
        """
        if row_column:
            return docs.withColumn(name, F.col(row_column).cast("long"))
        return self.write(docs.withColumn(name, F.monotonically_increasing_id()))

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(table._scratch_path)

    @contextlib.contextmanager
    def _cleaned(self) -> Iterator[None]:
        """Shuffle files of what is written meanwhile go when it stands: the copy is all that is read again."""
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            yield
        finally:
            self.spark.conf.set(CLEANUP, before)

    def close(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            for name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._delete(self.folder)

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf.hadoopConfiguration()).delete(target, True)
