"""Lake tables: namespaces, upserts without MERGE, materialized rebuilds."""

from __future__ import annotations

import hashlib
import json
import os
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

NAMESPACES = {
    "bronze": "Event files as delivered, text columns and lineage only.",
    "silver": "Typed, valid and deduplicated events and what follows from them row by row.",
    "gold": "Month-end snapshots by product, user and pair, and the calendar.",
    "dataform_assertions": "Rows that break a check of the lake.",
    "mlops_monitoring": "What was asked of the models and what they answered.",
}


def rebalance(df: DataFrame, partition_col: str) -> DataFrame:
    """Shuffle rows to writers by the table's partition column before a
    partitioned write.  AQE coalesces small partitions and splits a skewed
    one (a hot day), so each partition directory gets a few right-sized
    files instead of one file per task, and a hot value is not one task."""
    return df.hint("rebalance", partition_col)


def create_namespaces(spark: SparkSession, root: str) -> list[str]:
    """CREATE DATABASE IF NOT EXISTS for the five namespaces under root."""
    made = []
    for name, comment in NAMESPACES.items():
        loc = os.path.join(root, name)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{loc}'")
        made.append(name)
    return made


def table_path(root: str, namespace: str, table: str) -> str:
    return os.path.join(root, namespace, table)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the folder is there.  A storage error is raised, never taken for a missing table."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in path; none if it is missing."""
    fs, p = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data files."""
    fs, p = _file_system(spark, path)
    return fs.exists(p) and any(f.isFile() and f.getPath().getName()[0] not in "._" for f in fs.listStatus(p))


# ---- a journal of partition replacements
#
# A merge that moves keys replaces some partitions and drops others.  The new
# partitions are written beside the journal, in the table's own folder, so they
# are put in place by renaming.  Then it is written down that they are whole,
# and which partitions to drop.  Whoever opens the table next finishes what was
# begun; all steps can be repeated.  Spark does not read folders that start with "_".

JOURNAL = "_merge_journal"
# Codec of events and merged tables: half of an event is its identity, hexadecimal text that snappy does not shorten.
COMPRESSION = "zstd"


def write_json(spark: SparkSession, path: str, entry: dict) -> None:
    """A small file that is there whole or not at all: written beside its place and renamed."""
    fs, p = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if not fs.rename(draft, p):
        raise OSError(f"{path} could not be written")


def read_json(spark: SparkSession, path: str) -> dict | None:
    """What write_json wrote, or None."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)))
    finally:
        stream.close()


def _apply(spark: SparkSession, path: str, entry: dict) -> None:
    """Replace the merged rows' partitions, drop those that lost all rows, and close the journal."""
    if "partition_col" in entry:  # begun before merged rows were written by partition
        _write_clustered(spark.read.parquet(entry["merged"]), path, entry["partition_col"], entry["cluster_cols"])
    else:
        _write_partitions(spark, path, entry["merged"])
    for folder in entry["drop"]:
        drop_path(spark, f"{path.rstrip('/')}/{folder}")
    drop_path(spark, f"{path.rstrip('/')}/{JOURNAL}")


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a merge that was interrupted; True if there was one.

    A journal that was not finished itself means that the table was not
    touched yet, and is dropped.
    """
    entry = read_json(spark, f"{path.rstrip('/')}/{JOURNAL}/entry.json")
    if entry is None:
        drop_path(spark, f"{path.rstrip('/')}/{JOURNAL}")
        return False
    _apply(spark, path, entry)
    return True


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """The folder name of a partition value, as Spark's writer spells it."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, None if value is None else str(value))


def _write_partitions(spark: SparkSession, path: str, merged: str) -> None:
    """Put the partition folders of merged into the table's place; those already there are gone from merged."""
    fs, _ = _file_system(spark, path)
    for folder in list_folders(spark, merged):
        if "=" not in folder:
            continue  # no partition
        source, place = (_file_system(spark, f"{at.rstrip('/')}/{folder}")[1] for at in (merged, path))
        drop_path(spark, str(place))
        if not fs.rename(source, place):
            raise OSError(f"{place} could not be replaced")


def _write_clustered(df: DataFrame, path: str, partition_col: str, cluster_cols: list[str]) -> None:
    """Replace the partitions that df holds, clustered by sorting each file; other partitions stay."""
    (rebalance(df, partition_col).sortWithinPartitions(partition_col, *cluster_cols)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path, compression=COMPRESSION))


def upsert(source: DataFrame, path: str, keys: list[str], partition_col: str, target_filter=None,
           key_fixes_partition: bool = False, cluster_cols: list[str] | None = None, written: bool = False) -> DataFrame:
    """MERGE on keys: matched rows replaced, new rows inserted, the rest kept.

    The source is written once to the shared folder, so its plan runs once;
    written says that it only reads rows that materialize() wrote.
    Only touched partitions are replaced, also on the first write: a table is
    never wiped.  A key may come back with
    another partition value; its old row is found by reading the target's key
    columns and goes with the partition it stood in.  key_fixes_partition says
    that this cannot happen (event_id hashes event_ts, a snapshot's date is one
    of its keys) and saves that read.  target_filter narrows the target
    further (a snapshot upsert reads one snapshot partition).  An interrupted
    call is finished by the next one, or by recover(), from its journal.
    """
    spark = source.sparkSession
    cluster = cluster_cols or keys
    staged = source if written else materialize(source, COMPRESSION)
    exists = path_exists(spark, path)
    if exists:
        recover(spark, path)
    else:
        _write_clustered(staged, path, partition_col, cluster)
        return staged
    target = spark.read.schema(source.schema).parquet(path)
    if target_filter is not None:
        target = target.where(target_filter)
    touched = staged.select(partition_col).distinct()
    if not key_fixes_partition:
        found = target.select(*keys, partition_col).join(staged.select(*keys), keys, "left_semi")
        touched = touched.unionByName(found.select(partition_col)).distinct()
    touched = materialize(touched)
    # One row per touched partition: bounded by the table's partitions.
    only = F.broadcast(touched.withColumnRenamed(partition_col, "_touched"))
    same = F.col("_touched").eqNullSafe(F.col(partition_col))
    reached = target.join(only, same, "left_semi")
    # Keys are compared first, so rows are shuffled for this only if many of them stay.
    names = [f"_kept{i}" for i in range(len(keys))]
    stays = materialize(reached.select(*keys).join(staged.select(*keys), keys, "left_anti").distinct().toDF(*names), COMPRESSION)
    kept = reached.join(stays, reduce(and_, [F.col(n).eqNullSafe(F.col(k)) for n, k in zip(names, keys)]), "left_semi")
    merged_path = f"{path.rstrip('/')}/{JOURNAL}/merged"
    _write_clustered(kept.unionByName(staged.select(*target.columns)), merged_path, partition_col, cluster)
    left = set(list_folders(spark, merged_path))
    folders = [partition_folder(spark, partition_col, row[0]) for row in touched.collect()]
    entry = {"merged": merged_path, "drop": [f for f in folders if f not in left]}
    write_json(spark, f"{path.rstrip('/')}/{JOURNAL}/entry.json", entry)
    _apply(spark, path, entry)
    return spark.read.schema(target.schema).parquet(path).join(only, same, "left_semi")


def snapshot_upsert(source: DataFrame, path: str, keys: list[str], snapshot_date) -> DataFrame:
    """MERGE into one snapshot partition; keys absent from the new run stay."""
    flt = F.col("snapshot_date") == F.to_date(F.lit(str(snapshot_date)))
    return upsert(source, path, keys, "snapshot_date", target_filter=flt, key_fixes_partition=True,
                  cluster_cols=[k for k in keys if k != "snapshot_date"])


def materialize_table(df: DataFrame, path: str, cluster_cols: list[str], partitions: int | None = None) -> None:
    """Full rebuild, range-partitioned and sorted by the cluster columns so
    Parquet min/max statistics skip row groups on those columns.  Without a
    number AQE sizes the files by the data."""
    ranged = df.repartitionByRange(partitions, *cluster_cols) if partitions else df.repartitionByRange(*cluster_cols)
    ranged.sortWithinPartitions(*cluster_cols).write.mode("overwrite").parquet(path)


# ---- tables bucketed by key
#
# A bucketed table is read through the catalog, which tells Spark how its rows
# are dealt; a join or aggregate on the keys then needs no exchange of it.  The
# layout is kept in a file beside the data, so any session can register it.

LAYOUT = "_layout.json"


def _bucketed_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None) -> None:
    """Write df to path in buckets of keys (as many as there are shuffle partitions), sorted by them: one file a bucket."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(path)}")
    (df.repartition(n, *keys).write.mode("overwrite").option("path", path).bucketBy(n, *keys).sortBy(*keys).saveAsTable(_bucketed_name(path)))
    write_json(spark, f"{path.rstrip('/')}/{LAYOUT}", {"keys": keys, "buckets": n})


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table that write_bucketed wrote to path, also by another session."""
    name = _bucketed_name(path)
    if not spark.catalog.tableExists(name):
        layout = read_json(spark, f"{path.rstrip('/')}/{LAYOUT}")
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in layout["keys"])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def publish(spark: SparkSession, table: str) -> None:
    """Let a partitioned table see the partitions that were written to its folder by path."""
    if spark.catalog.tableExists(table):
        spark.sql(f"MSCK REPAIR TABLE {table}")


def create_tables(spark: SparkSession, root: str, replace_bronze: bool = True) -> None:
    """bronze.raw_events (or replace, partitioned by _load_month) and
    mlops_monitoring.api_logs (if not exists, partitioned by a stored log_date,
    since Spark partitions by a column rather than an expression).  Replacing
    also deletes the files: dropping an external table keeps them.  Partitions
    found in the folders are registered."""
    create_namespaces(spark, root)
    bronze = table_path(root, "bronze", "raw_events")
    if replace_bronze:
        spark.sql("DROP TABLE IF EXISTS bronze.raw_events")
        drop_path(spark, bronze)
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS bronze.raw_events (
          event_time_raw STRING, event_type_raw STRING, product_id_raw STRING, category_id_raw STRING,
          category_code_raw STRING, brand_raw STRING, price_raw STRING, user_id_raw STRING,
          user_session_raw STRING, _source_uri STRING, _ingested_at TIMESTAMP, _load_id STRING,
          _load_month DATE)
        USING parquet PARTITIONED BY (_load_month) LOCATION '{bronze}'
        COMMENT 'Delivered event rows by the month they were loaded for'""")
    logs = table_path(root, "mlops_monitoring", "api_logs")
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS mlops_monitoring.api_logs (
          timestamp TIMESTAMP COMMENT 'When the answer was given',
          user_id STRING COMMENT 'Id the answer is about: a product',
          session_id STRING COMMENT 'Run that asked',
          request_payload STRING COMMENT 'What was asked, as JSON',
          prediction_score DOUBLE COMMENT 'The answer',
          model_version STRING COMMENT 'What gave the answer: a model or a fallback',
          log_date DATE)
        USING parquet PARTITIONED BY (log_date) LOCATION '{logs}'""")
    for table, folder in (("bronze.raw_events", bronze), ("mlops_monitoring.api_logs", logs)):
        fs, p = _file_system(spark, folder)
        fs.mkdirs(p)
        publish(spark, table)
