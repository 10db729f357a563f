"""Appends that happen once: a batch's rows and the record of the batch live side by side.

Below the table's own folder, ``_ledger/<stream>/<batch>`` goes through three states:

* rows are written to ``rows`` there; Spark's ``_SUCCESS`` file says that they are complete;
* each file is renamed into the table under a name made of stream, batch and number, so a
  file that was moved already is not moved twice;
* an empty file ``done`` closes the batch and ``rows`` goes.

Whatever is lost in between, the same call continues from the state it finds: incomplete rows
are written again, complete ones are only moved, a closed batch is left alone. Folders that
begin with an underscore are invisible to scans. Each batch moves as many files as its last
exchange wrote, so the driver's work is bounded by the batch's partitions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.operators.skew import columns_of
from caseledger.sources.tables import (_aligned, create_or_evolve, describe, partition_columns,
                                       supports_merge)

LEDGER = "_ledger"
STREAM, BATCH = "stream_id", "batch_id"


class _Folder:
    """The few calls on a shared folder that a batch needs."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def of(self, path: str):
        return self._path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.of(path))

    def touch(self, path: str) -> None:
        self.fs.create(self.of(path), True).close()

    def drop(self, path: str) -> None:
        self.fs.delete(self.of(path), True)

    def files(self, path: str) -> list[str]:
        """Data files below ``path``, relative to it, in a fixed order."""
        start = self.fs.makeQualified(self.of(path)).toString().rstrip("/") + "/"
        found, listing = [], self.fs.listFiles(self.of(path), True)
        while listing.hasNext():
            name = listing.next().getPath().toString().removeprefix(start)
            if not re.search(r"(^|/)[_.]", name):
                found.append(name)
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        to = self.of(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.of(source), to) and self.exists(source):
            raise OSError(f"could not move {source} to {target}")


def _write_rows(rows: DataFrame, days: Sequence[str], path: str) -> None:
    # Static, whatever the session says: what an unfinished try left goes, and _SUCCESS is written.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*days) if days else writer).parquet(path)


def _add_partitions(spark: SparkSession, table: str, heads: set[str]) -> None:
    """Make the folders that a batch fills known to the catalog; at most one call per day of the batch."""
    for head in sorted(heads - {""}):
        values = []
        for part in head.split("/"):
            column, _, value = part.partition("=")
            text = unquote(value).replace("'", "\\'")
            values.append(f"`{unquote(column)}` = " + ("null" if value == "__HIVE_DEFAULT_PARTITION__" else f"'{text}'"))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({', '.join(values)})")


def _publish(folder: _Folder, entry: str, stream: str, batch: int, names: Sequence[str]) -> None:
    for n, name in enumerate(names):
        head, _, leaf = name.rpartition("/")
        # The number belongs to the file, not to the order of the moves.
        part = re.match(r"part-(\d+)", leaf)
        number = part.group(1) if part else f"{n:05d}"
        suffix = re.search(r"(\.c\d+)?\.[\w.]*parquet$", leaf).group(0)
        folder.move(f"{entry}/rows/{name}", "/".join(filter(None, (folder.root, head, f"{stream}-{batch:010d}-{number}{suffix}"))))


def append_once(df: DataFrame, table: str, stream: str, batch: int,
                partition_by: str | Sequence[str] = (), location: str | None = None) -> bool:
    """Append ``df`` as batch ``batch`` of ``stream`` unless that batch is in the table already.

    Returns whether rows were added. On a catalog with ``MERGE`` the batch is one overwrite by
    filter on the columns ``stream_id`` and ``batch_id``, which such tables carry.
    """
    spark, keys = df.sparkSession, columns_of(partition_by)
    if spark.catalog.tableExists(table) and supports_merge(spark, table):
        marked = df.withColumns({STREAM: F.lit(stream), BATCH: F.lit(batch).cast("long")})
        create_or_evolve(marked, table)
        _aligned(marked, table).writeTo(table).overwrite((F.col(STREAM) == stream) & (F.col(BATCH) == batch))
        return True
    create_or_evolve(df, table, keys, location)
    folder = _Folder(spark, describe(spark, table)["Location"])
    entry = f"{folder.root}/{LEDGER}/{stream}/{batch}"
    if folder.exists(f"{entry}/done"):
        return False
    if not folder.exists(f"{entry}/rows/_SUCCESS"):
        keys = partition_columns(spark, table)
        # Types and order of the table; the days are clustered so that few files are written.
        rows = _aligned(df, table)
        _write_rows(rows.hint("rebalance", *keys) if keys else rows, keys, f"{entry}/rows")
    names = folder.files(f"{entry}/rows")
    # Before the first move: a repeated call then need not know what was moved already.
    _add_partitions(spark, table, {name.rpartition("/")[0] for name in names})
    _publish(folder, entry, stream, batch, names)
    spark.catalog.refreshTable(table)
    folder.touch(f"{entry}/done")
    folder.drop(f"{entry}/rows")
    return True


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps across restarts, from its checkpoint; a new checkpoint has a new one."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return re.search(r'"id"\s*:\s*"([\w-]+)"', text).group(1)
