"""Writers for catalog tables. Every write may be repeated without changing the result."""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.operators.keys import anti_join
from caseledger.operators.ranking import latest
from caseledger.operators.skew import broadcast_within, columns_of
from caseledger.session import staged

BUCKET = "key_bucket"
BUCKETS = 64
MERGE_PROVIDERS = ("iceberg", "delta", "hudi", "paimon")


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def describe(spark: SparkSession, table: str) -> dict[str, str]:
    """Provider, location and partition columns of a table (metadata only)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row["col_name"]: row["data_type"] for row in rows}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def supports_merge(spark: SparkSession, table: str) -> bool:
    return describe(spark, table).get("Provider", "").lower() in MERGE_PROVIDERS


def fresh(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now. Sessions keep file listings, and every stream writes from a
    session of its own, so a read that must see other writers refreshes first."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """Columns in the table's order; columns the frame lacks become null."""
    spark = df.sparkSession
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in spark.table(table).schema.fields])


def create_or_evolve(df: DataFrame, table: str, partition_by: str | Sequence[str] = (),
                     location: str | None = None) -> str:
    """Create from the frame's schema, or add the columns the table lacks (case-blind)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        keys = columns_of(partition_by)
        fields = [f for f in df.schema.fields if f.name not in keys]
        fields += [df.schema[k] for k in keys]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        clause = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet{clause}{place}")
        return table
    present = {f.name.lower() for f in spark.table(table).schema.fields}
    missing = [f for f in df.schema.fields if f.name.lower() not in present]
    if missing:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")
    return table


def insert_rows(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by column name. ``overwrite`` replaces what the session's overwrite mode says."""
    keys = partition_columns(df.sparkSession, table)
    aligned = _aligned(df, table)
    if keys:
        # One day or bucket can be most of the batch. ``rebalance`` clusters rows by
        # partition so that few files are written, yet splits partitions that are large.
        aligned = aligned.hint("rebalance", *keys)
    aligned.write.insertInto(table, overwrite=overwrite)


def with_day(df: DataFrame, ts: str, name: str) -> DataFrame:
    return df.withColumn(name, F.to_date(ts))


def append_partitioned(df: DataFrame, table: str, ts: str = "ingested_at",
                       day: str = "ingest_date", location: str | None = None) -> None:
    """Append to a table partitioned by the day of ``ts``."""
    dated = with_day(df, ts, day)
    create_or_evolve(dated, table, day, location)
    insert_rows(dated, table)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Rejected files with their whole content and the reason, as appended JSON."""
    df.write.mode("append").json(path)


def append_new_only(df: DataFrame, table: str, keys: str | Sequence[str],
                    day: tuple[str, str] | None = None, location: str | None = None,
                    bucket_by: str | Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Append the rows whose key the table does not have, one row per key.

    ``day`` = (timestamp column, partition column) lays an event log out by day. The log
    is asked which keys of the batch it has: a batch within the broadcast bound goes to
    the log, whose key column is then scanned in place, and only the answer comes back.

    ``bucket_by`` lays it out by a hash bucket of columns that rows of one key agree on (the
    keys themselves, or the entity the events belong to): a batch then asks the buckets it
    touches and no others. A table created without buckets stays without.
    """
    spark = df.sparkSession
    names = columns_of(keys)
    once = df.dropDuplicates(names)
    if day:
        once = with_day(once, *day)
    created = not spark.catalog.tableExists(table)
    bucketed = bool(columns_of(bucket_by)) and (created or BUCKET in partition_columns(spark, table))
    if bucketed:
        once = _placed(once, table, columns_of(bucket_by), buckets)
    create_or_evolve(once, table, [*([BUCKET] if bucketed else []), *([day[1]] if day else [])], location)
    if created:
        if bucketed:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('buckets' = '{buckets}')")
        insert_rows(once, table)
        return
    # The batch is used several times: written once, so every use sees the same rows.
    with staged(once, "append") as batch:
        asked = broadcast_within(batch.select(*[F.col(k).alias(f"_b_{k}") for k in names]))
        match = reduce(lambda a, b: a & b,
                       [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in names])
        log = fresh(spark, table)
        if bucketed:
            log = log.where(F.col(BUCKET).isin(_touched(batch)))
        known = log.select(*names).join(asked, match, "left_semi")
        insert_rows(anti_join(batch, known, names), table)


def _placed(df: DataFrame, table: str, names: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with its rows' buckets: keys hash by the table's types, whatever types they come with."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        buckets = int(_property(spark, table, "buckets", buckets))
        kinds = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
        df = df.withColumns({k: F.col(k).cast(kinds[k.lower()]) for k in names})
    return df.withColumn(BUCKET, key_bucket(names, buckets))


def _touched(batch: DataFrame) -> list[int]:
    return [row[0] for row in batch.select(BUCKET).distinct().collect()]  # at most one per bucket


def in_buckets(keys: DataFrame, table: str, names: str | Sequence[str]) -> DataFrame:
    """The rows of a bucketed table in those buckets that the ``keys`` fall into, read by partition.

    A table without buckets is returned whole.
    """
    spark = keys.sparkSession
    stored = fresh(spark, table)
    if BUCKET not in partition_columns(spark, table):
        return stored
    touched = _touched(_placed(keys.select(*columns_of(names)), table, columns_of(names), BUCKETS))
    return stored.where(F.col(BUCKET).isin(touched))


def key_bucket(keys: str | Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*columns_of(keys)), F.lit(buckets)).cast("int")


def upsert_current_state(df: DataFrame, table: str, keys: str | Sequence[str],
                         order: str | Sequence[str] = (), buckets: int = BUCKETS,
                         location: str | None = None) -> None:
    """Replace rows with the same null-safe key, insert the others.

    With ``order`` the newest row per key wins, of the batch and what is stored, so a
    replayed old batch changes nothing; without it keys of the batch must be unique and
    its rows replace the stored ones. On a catalog with ``MERGE`` that is used. On Parquet the table is
    partitioned by a hash bucket of the key: only the buckets the batch touches are
    read and overwritten, in one job, so the cost follows the batch and a repeated
    run gives the same table. Choose ``buckets`` so that one holds about 1 GB.
    """
    spark = df.sparkSession
    names = columns_of(keys)
    source = latest(df, names, order) if order else df
    if spark.catalog.tableExists(table) and supports_merge(spark, table):
        create_or_evolve(source, table)
        short = table.rsplit(".", 1)[-1]
        match = " AND ".join(f"{short}.`{k}` <=> s.`{k}`" for k in names)
        newer = None
        if order:
            first, stored = (f"struct({', '.join(f'{side}.`{c}`' for c in columns_of(order))})" for side in ("s", short))
            newer = F.expr(f"{first} >= {stored}")
        (source.alias("s").mergeInto(table, F.expr(match))
         .whenMatched(newer).updateAll().whenNotMatched().insertAll().merge())
        return
    created = not spark.catalog.tableExists(table)
    placed = _placed(source, table, names, buckets)
    create_or_evolve(placed, table, BUCKET, location)
    if created:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('buckets' = '{buckets}')")
        insert_rows(placed, table)
        return
    with staged(placed, "upsert") as batch:
        stored = _aligned(fresh(spark, table).where(F.col(BUCKET).isin(_touched(batch))), table)
        if order:
            # A replayed batch must not undo what came after it: the newer row stays.
            both = stored.withColumn("_new", F.lit(0)).unionByName(_aligned(batch, table).withColumn("_new", F.lit(1)))
            kept = latest(both, names, [*columns_of(order), "_new"]).drop("_new")
        else:
            kept = anti_join(stored, batch, names).unionByName(_aligned(batch, table))
        _publish_partitions(kept, table, BUCKET, _touched(batch))


def _publish_partitions(df: DataFrame, table: str, column: str, values: Sequence[int]) -> None:
    """Make the partitions ``column`` in ``values`` hold exactly the rows of ``df``.

    The rows are written beside the table first; then the pointer of each partition is moved
    in the catalog, or dropped if no row belongs to it. A reader sees the old or the new rows
    of a partition, and a crash in between leaves each partition as it was or as it will be; the
    same call then completes the rest. Older files stay until the deployment's clean-up.
    """
    spark = df.sparkSession
    if (keys := partition_columns(spark, table)) != [column]:
        raise ValueError(f"{table} is laid out by {keys}, not by {column} alone")
    folder = f"{_property(spark, table, 'versions', None) or _home(spark, table)}/p{time.time_ns():019d}"
    (_aligned(df, table).hint("rebalance", *keys).write.option("partitionOverwriteMode", "static")
     .partitionBy(*keys).parquet(folder))
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for value in values:
        spec, place = f"`{column}` = {value}", f"{folder}/{column}={value}"
        if not fs.exists(path(place)):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
            continue
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def _property(spark: SparkSession, table: str, name: str, default) -> str:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).collect()
    return rows[0]["value"] if rows else default


def replace_all(df: DataFrame, table: str, base: str | None = None) -> str:
    """Publish a full new version: write it beside the old one, then move the pointer.

    ``df`` may read ``table`` itself. Readers see the old or the new version, never a
    mixture; older versions stay under ``base`` (by default a folder beside the catalog's
    own tables) until the deployment's clean-up takes them. Returns the new path.
    """
    spark = df.sparkSession
    home = (base or _property(spark, table, "versions", None)
            if spark.catalog.tableExists(table) else base) or _home(spark, table)
    path = f"{home.rstrip('/')}/v{time.time_ns() // 1_000_000:015d}"
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        create_or_evolve(df, table)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        create_or_evolve(df, table, location=path)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('versions' = '{home}')")
    spark.catalog.refreshTable(table)
    return path


def _home(spark: SparkSession, table: str) -> str:
    """Where versions of a table live by default: under the warehouse, never in the scratch folder."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{table.replace('`', '').replace('.', '/')}"


def replace_partition(df: DataFrame, table: str, column: str, value: int,
                      location: str | None = None) -> None:
    """Make ``column = value`` hold exactly the rows of ``df``; other partitions stay.

    A row of another partition raises. On Parquet tables the rows are written beside the table
    and the partition's pointer is moved to them, so readers see the old rows or the new ones;
    catalogs with transactions commit the same call as one overwrite by filter.
    """
    spark = df.sparkSession
    chosen = F.col(column) == F.lit(value)
    # In the projection, so that the check sees result rows and is not pushed below a join.
    foreign = F.raise_error(F.concat(F.lit(f"a row belongs to {column} = "),
                                     F.coalesce(F.col(column).cast("string"), F.lit("null")), F.lit(f", not {value}")))
    only = df.withColumn(column, F.when(chosen, F.col(column)).otherwise(foreign.cast(df.schema[column].dataType)))
    if spark.catalog.tableExists(table) and supports_merge(spark, table):
        create_or_evolve(df, table)
        _aligned(only, table).writeTo(table).overwrite(chosen)
        return
    create_or_evolve(only, table, column, location)
    _publish_partitions(only, table, column, [value])


def drop_column(table_df: DataFrame, table: str, column: str) -> None:
    """Retire a column: publish a version without it."""
    spark = table_df.sparkSession
    path = _version(spark, table)
    kept = fresh(spark, table).drop(column)
    keys = [k for k in partition_columns(spark, table) if k != column]
    writer = kept.write.partitionBy(*keys) if keys else kept.write
    writer.parquet(path)
    _repoint(spark, table, path, keys, kept)


def _version(spark: SparkSession, table: str) -> str:
    return f"{_property(spark, table, 'versions', None) or _home(spark, table)}/v{time.time_ns() // 1_000_000:015d}"


def _repoint(spark: SparkSession, table: str, path: str, keys: Sequence[str],
             df: DataFrame) -> None:
    """Make ``table`` an external table over ``path``; its own properties stay."""
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
            if r["key"] in ("buckets", "versions")}
    spark.sql(f"DROP TABLE {table}")
    create_or_evolve(df, table, list(keys), path)
    for key, value in kept.items():
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")
    if keys:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def delete_where(spark: SparkSession, table: str, predicate: str) -> None:
    """Delete matching rows: rewrite the partitions that hold some, or publish a version."""
    keys = partition_columns(spark, table)
    current = fresh(spark, table)
    kept = current.where(~F.coalesce(F.expr(predicate), F.lit(False)))
    if not keys:
        replace_all(kept, table)
        return
    hit = current.where(predicate).select(*keys).distinct()
    parts = hit.collect()  # partition values, not data
    if not parts:
        return
    survivors = kept.where(_in_partitions(keys, parts))
    alive = {tuple(row) for row in survivors.select(*keys).distinct().collect()}
    with _dynamic_overwrite(spark):
        insert_rows(survivors, table, overwrite=True)
    for row in parts:
        if tuple(row) not in alive:
            _drop_partition(spark, table, row)


def _in_partitions(keys: Sequence[str], parts) -> Column:
    """Rows of the listed partitions, as a predicate that prunes."""
    if len(keys) == 1:
        values = [row[keys[0]] for row in parts if row[keys[0]] is not None]
        condition = F.col(keys[0]).isin(values)
        return condition if len(values) == len(parts) else condition | F.col(keys[0]).isNull()
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(row[k])) for k in keys])
        for row in parts])


def _drop_partition(spark: SparkSession, table: str, row) -> None:
    def literal(value) -> str:
        return "null" if value is None else "'" + str(value).replace("'", "\\'") + "'"
    spec = ", ".join(f"`{k}` = {literal(v)}" for k, v in row.asDict().items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def repartition_table(spark: SparkSession, table: str, ts: str, day: str) -> None:
    """Lay an existing table out by the day of ``ts``."""
    dated = with_day(fresh(spark, table), ts, day)
    path = _version(spark, table)
    dated.hint("rebalance", day).write.partitionBy(day).parquet(path)
    _repoint(spark, table, path, [day], dated)


def mirror_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None,
                batch_size: int = 1000, writers: int = 1, mode: str = "overwrite",
                on_error=None, **options: str) -> bool:
    """Copy a small dimension to a serving database; report failure instead of raising.

    ``overwrite`` truncates and refills, so a repeated run is harmless on any database;
    ``append`` suits stores whose primary key turns inserts into updates.
    """
    try:
        writer = (df.coalesce(writers).write.format("jdbc").option("url", url)
                  .option("dbtable", table).option("batchsize", batch_size)
                  .option("truncate", True).options(**options))
        if driver:
            writer = writer.option("driver", driver)
        writer.mode(mode).save()
        return True
    except Exception as error:
        (on_error or print)(f"mirror of {table} skipped: {error}")
        return False


def mirror_jdbc_staged(df: DataFrame, url: str, table: str, driver: str | None = None,
                       batch_size: int = 1000, writers: int = 4, on_error=None,
                       **options: str) -> bool:
    """Copy a dimension to a serving database so that readers see the old rows or the new ones.

    Parallel writers fill a staging table; the served table is then replaced from it inside the
    database, in one transaction. A load that fails, while it fills or while it replaces,
    leaves the served rows as they were and is reported instead of raised. ``table`` is a name
    as the database spells it; quotes around it are kept.
    """
    spark = df.sparkSession
    stage = f'{table[:-1]}_stage"' if table.endswith('"') else f"{table}_stage"

    def sink(frame: DataFrame, name: str):
        writer = frame.write.format("jdbc").option("url", url).option("dbtable", name).option(
            "batchsize", batch_size).options(**options)
        return writer.option("driver", driver) if driver else writer
    try:
        sink(df.repartition(writers), stage).mode("overwrite").save()
        sink(df.limit(0), table).mode("append").save()  # creates the served table if there is none
        names = ", ".join('"' + c.replace('"', '""') + '"' for c in df.columns)
        _in_transaction(spark, url, options, [f"DELETE FROM {table}", f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}"])
        _in_transaction(spark, url, options, [f"DROP TABLE {stage}"])
        return True
    except Exception as error:
        (on_error or print)(f"mirror of {table} skipped: {error}")
        return False


def _in_transaction(spark: SparkSession, url: str, options: dict[str, str], statements: Sequence[str]) -> None:
    """Run statements on one connection; all of them count or none."""
    properties = spark._jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, str(value))
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        call = connection.createStatement()
        for statement in statements:
            call.executeUpdate(statement)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


# --- retention ---------------------------------------------------------------------

def expired_snapshots(df: DataFrame, retain_days: int = 7, retain_last: int = 10,
                      now: Column | None = None, snapshot: str = "snapshot_id",
                      ts: str = "ingested_at") -> DataFrame:
    """Snapshots older than the retention that are not among the newest ``retain_last``."""
    listed = df.groupBy(snapshot).agg(F.max(ts).alias("_at"))
    newest = (listed.orderBy(F.col("_at").desc(), F.col(snapshot).desc())
              .limit(retain_last).select(snapshot))
    cutoff = (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {retain_days} DAYS")
    return anti_join(listed.where(F.col("_at") < cutoff).select(snapshot), newest, snapshot)


def retention_purge(spark: SparkSession, table: str, retain_days: int = 7,
                    retain_last: int = 10, now: Column | None = None,
                    snapshot: str = "snapshot_id", ts: str = "ingested_at") -> list[str]:
    """Delete expired snapshots from a Bronze table; only their partitions are rewritten."""
    gone = [row[0] for row in
            expired_snapshots(fresh(spark, table), retain_days, retain_last, now, snapshot, ts)
            .collect()]  # one value per snapshot run
    if gone:
        values = ", ".join("'" + str(v).replace("'", "''") + "'" for v in gone)
        delete_where(spark, table, f"{snapshot} IN ({values})")
    return sorted(gone)
