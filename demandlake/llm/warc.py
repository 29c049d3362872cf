"""Merkle fixity audit of WARC archives.

Pages are laid out as WARC records in files of at most FILE_RECORDS ids.  A
leaf hashes a record together with its offset range, FANOUT neighbouring nodes
hash to the node above them, up to one root for each file.  Two replicas are
compared from the roots down: only the children of nodes that differ are
looked at, so sound branches are never joined, and the descent ends at the
damaged offset ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlake.llm.common import written

FILE_RECORDS = 1024
FANOUT = 16


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC response record without the two line ends that close it; nulls count as empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)


def layout(pages: DataFrame, html: Column | None = None) -> DataFrame:
    """page_id, file_id, position, offset, length, record_sha256 of every page.

    A file holds the ids of one range in order of id; rows with equal ids
    follow each other by url and hash, null ids have a file of their own.
    html replaces the column of that name, as in a replica.
    """
    row = record(F.col("page_id"), F.col("url").cast("string"), F.col("html").cast("string") if html is None else html)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.concat(row, F.lit("\r\n\r\n")).alias("r")).select(
        "page_id", F.coalesce(F.floor(F.col("page_id") / FILE_RECORDS), F.lit(-1)).cast("long").alias("file_id"), F.col("url"),
        F.octet_length("r").cast("long").alias("length"), F.sha2("r", 256).alias("record_sha256"))
    order = Window.partitionBy("file_id").orderBy("page_id", "url", "record_sha256")
    return (slim.withColumn("position", (F.row_number().over(order) - 1).cast("long"))
            .withColumn("offset", F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
            .select("page_id", "file_id", "position", "offset", "length", "record_sha256"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write the records as WARC files; the two line ends that close a record are the line separator."""
    (pages.select(F.coalesce(F.floor(F.col("page_id") / FILE_RECORDS), F.lit(-1)).alias("file_id"), "page_id",
                  record(F.col("page_id"), F.col("url"), F.col("html")).alias("value"))
     .repartition("file_id").sortWithinPartitions("file_id", "page_id").select("file_id", "value")
     .write.partitionBy("file_id").option("lineSep", "\r\n\r\n").text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, position, offset, length, record_sha256 of each record of the WARC files below path.

    A file is read whole by one task, so it may have two gigabytes at most.  A
    record that is cut short, or does not start where it should, ends its file
    as one last range.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import re

        length_of = re.compile(rb"^content-length:[ \t]*(\d+)[ \t]*\r$", re.I | re.M)
        names = ["file", "position", "offset", "length", "record_sha256"]
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1)):
                data, rows, at = data.as_buffer(), [], 0
                view = memoryview(data)
                while at < len(view):
                    head = bytes(view[at: at + 65536])
                    split = head.find(b"\r\n\r\n")
                    size = length_of.search(head[: split + 2]) if split >= 0 and head.startswith(b"WARC/") else None
                    end = min(at + split + 4 + int(size[1]) + 4, len(view)) if size else len(view)
                    rows.append((file, len(rows), at, end - at, hashlib.sha256(view[at:end]).hexdigest()))
                    at = end
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(scan, "file string, position long, offset long, length long, record_sha256 string")


def height(leaves: DataFrame) -> int:
    """Levels above the leaves: enough for FILE_RECORDS, and for the longest file."""
    most = max(FILE_RECORDS - 1, leaves.agg(F.max("position")).first()[0] or 0)
    levels = 0
    while most > 0:
        most, levels = most // FANOUT, levels + 1
    return levels


def tree(leaves: DataFrame, levels: int, key: str = "file_id") -> DataFrame:
    """(key, level, node, hash) of leaves(key, position, offset, length, record_sha256); the roots are at `levels`.

    A group of the level below holds at most FANOUT nodes.
    """
    whole = level = written(leaves.select(key, F.lit(0).alias("level"), F.col("position").alias("node"), F.sha2(
        F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "record_sha256"), 256).alias("hash")), "merkle-0")
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    for k in range(1, levels + 1):
        level = written(
            level.groupBy(key, F.floor(F.col("node") / FANOUT).alias("up")).agg(children.alias("children"))
            .select(key, F.lit(k).alias("level"), F.col("up").alias("node"),
                    F.sha2(F.array_join(F.transform("children", lambda c: c["hash"]), ""), 256).alias("hash")), f"merkle-{k}")
        whole = whole.unionByName(level)
    return whole


def audit(first: DataFrame, second: DataFrame, levels: int, key: str = "file_id") -> DataFrame:
    """(key, node): the leaves of two trees that differ, or that only one has.

    Starts at the roots; a level is joined only below the nodes of the level
    above that differ.
    """
    differ = None
    for level in range(levels, -1, -1):
        a, b = (t.where(F.col("level") == level).select(key, "node", F.col("hash").alias(name)) for t, name in ((first, "x"), (second, "y")))
        if differ is not None:
            up = differ.select(key, F.col("node").alias("up"))
            a, b = (t.withColumn("up", F.floor(F.col("node") / FANOUT)).join(up, [key, "up"], "left_semi").drop("up") for t in (a, b))
        differ = written(a.join(b, [key, "node"], "full").where(~F.col("x").eqNullSafe(F.col("y"))).select(key, "node"), f"differ-{level}")
    return differ


def damaged(html: Column, record_sha256: Column) -> Column:
    """html as a damaged replica holds it: another first character in the records whose hash starts with a7."""
    return F.when((F.substring(record_sha256, 1, 2) == "a7") & (F.length(html) > 0),
                  F.concat(F.lit("~"), F.substring(html, 2, 2**31 - 1))).otherwise(html)


def fixity(pages: DataFrame) -> DataFrame:
    """Every record of pages with its place, hash, file roots in both replicas, and whether it differs.

    The second replica is laid out from the same pages with damaged records
    (see damaged).  Null columns count as empty, repeated rows are records of
    their own, an empty table gives none.
    """
    own = record(F.col("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    first = written(layout(pages), "replica-1")
    second = written(layout(pages, damaged(F.col("html").cast("string"), F.sha2(F.concat(own, F.lit("\r\n\r\n")), 256))), "replica-2")
    levels = max(height(first), height(second))
    trees = [tree(r, levels) for r in (first, second)]
    found = audit(*trees, levels).select("file_id", F.col("node").alias("position"), F.lit(True).alias("differs"))
    top = [t.where(F.col("level") == levels).select("file_id", F.col("hash").alias(name)) for t, name in zip(trees, ("root", "replica_root"))]
    return (first.join(found, ["file_id", "position"], "left").join(top[0].join(top[1], "file_id"), "file_id")
            .select("page_id", "file_id", "position", "offset", "length", "record_sha256", "root", "replica_root",
                    F.coalesce("differs", F.lit(False)).alias("differs")))
