"""Inserts, upserts and files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.functions.times import format_range
from storyweave.session import staged


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``. An aggregate, so repeats are dropped before the shuffle."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), rank).alias("row"))
    return best.select("row.*")


def insert_ignore(new: DataFrame, existing: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows to append: keys not present yet, the first row of each key by ``order``."""
    return first_per_key(new, keys, order).join(existing.select(*keys), keys, "left_anti")


def upsert(new: DataFrame, existing: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The whole table after new rows replaced old ones of the same key; of new rows with one key the last wins."""
    both = (new.withColumn("_new", F.lit(1)).unionByName(existing.withColumn("_new", F.lit(0))))
    rank = F.struct("_new", *[c.alias(f"o{i}") for i, c in enumerate(order)])
    return (both.groupBy(*keys).agg(F.max_by(F.struct(*existing.columns), rank).alias("row"))
            .select("row.*"))


def rows_added(inserted: DataFrame) -> int:
    """How many rows an insert adds; the next stage runs only if there are any."""
    return inserted.count()


@dataclass(frozen=True)
class Layout:
    """A stored table's folders: ``key_part``, a hash prefix of its keys, and below it ``added_on``, the day of ``added_at``.

    Inserts look for keys in the parts that the new rows' keys fall into, windows in the days that they touch. ``parts`` is a
    property of the table: rows already written lie where it put them.
    """

    keys: tuple[str, ...]
    parts: int = 16

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def stamped(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"key_part": self.part(), "added_on": F.to_date("added_at")})

    def schema(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField("key_part", T.IntegerType()), T.StructField("added_on", T.DateType())])

    def touched(self, table: DataFrame, rows: DataFrame) -> DataFrame:
        """The table's rows in parts that keys of ``rows`` fall into; the numbers of these parts, ``parts`` at most, go through the driver."""
        parts = sorted(r[0] for r in rows.select(self.part()).distinct().collect())
        return table.filter(F.col("key_part").isin(parts))


def in_days(table: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Rows of the days from that of ``since`` to that of ``until``: whole folders of a table laid out by day, all rows of another."""
    if "added_on" not in table.columns:
        return table
    if since is not None:
        table = table.filter(F.col("added_on") >= F.to_date(since))
    return table if until is None else table.filter(F.col("added_on") <= F.to_date(until))


def folder_tasks(spark: SparkSession) -> int:
    """How many tasks rows are dealt over that go into folders. A fixed number: by their bytes adaptive execution would put thousands of small
    folders into a few tasks, which write one file after another."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def append(rows: DataFrame, path: str, layout: Layout | None = None) -> int:
    """Append a batch to a Parquet table, in the folders of its layout if it has one; gives the number of rows."""
    batch = staged(rows, "append")
    added = rows_added(batch)
    if added and layout:
        # A task for each folder, so that a batch adds one file to it at most.
        tasks = folder_tasks(batch.sparkSession)
        layout.stamped(batch).repartition(tasks, "key_part", "added_on").write.mode("append").partitionBy("key_part", "added_on").parquet(path)
    elif added:
        batch.write.mode("append").parquet(path)
    return added


def compact(spark: SparkSession, path: str, schema: T.StructType, layout: Layout, day: str) -> None:
    """Write the files that a day's batches left as one file for each part; other days are not touched.

    For the writer of the table, between batches: the rows are staged first and then take the place of the day's folders.
    """
    rows = staged(table_at(spark, path, schema, layout).filter(F.col("added_on") == F.lit(day).cast("date")), "compact")
    (rows.repartition("key_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("key_part", "added_on").parquet(path))


def table_at(spark: SparkSession, path: str, schema: T.StructType, layout: Layout | None = None) -> DataFrame:
    """A stored table, empty while nothing has been appended; one with a layout has ``key_part`` and ``added_on`` too."""
    schema = layout.schema(schema) if layout else schema
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


CLUSTER_TABLES = {"articlecluster": ["id"], "articleclusterlink": ["cluster_id", "article_id"], "articleclusterkeyword": ["cluster_id", "term"]}


def write_clusters(found, folder: str) -> None:
    """Add the cluster, link and keyword rows of one run whose keys are not there yet, so a run can be repeated."""
    for (name, keys), rows in zip(CLUSTER_TABLES.items(), (found.clusters, found.links, found.keywords)):
        path = f"{folder}/{name}"
        present = table_at(rows.sparkSession, path, rows.schema)
        append(rows.join(present.select(*keys), keys, "left_anti").select(*rows.columns), path)


def replace_windows(found, windows: DataFrame, folder: str) -> None:
    """Write the clusters of the listed windows in place of what the three tables hold of them; other windows are not touched.

    The tables are laid out by window. Each listed window gets a row without an id, so one that has no cluster any more loses its old ones;
    ``cluster_tables`` leaves these rows out. Repeating it gives the same tables.
    """
    def name(end: str) -> Column:
        return F.date_format(end, "yyyyMMddHHmmss").alias("window")

    of_cluster = found.clusters.select(F.col("id").alias("cluster_id"), name("end"))
    marks = windows.select(name("end"))
    n_windows, tasks = marks.count(), folder_tasks(windows.sparkSession)
    for (table, _), rows in zip(CLUSTER_TABLES.items(), (found.clusters.withColumn("window", name("end")),
                                                         found.links.join(of_cluster, "cluster_id"), found.keywords.join(of_cluster, "cluster_id"))):
        every = staged(rows.unionByName(marks, allowMissingColumns=True), table)
        # A window's rows come together, or each task would add a file to each window; few windows are spread over as many tasks.
        piece = F.pmod(F.xxhash64(*rows.columns), F.lit(max(1, tasks // max(1, n_windows))))
        (every.repartition(tasks, "window", piece).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("window").parquet(f"{folder}/{table}"))


def cluster_tables(spark: SparkSession, folder: str, schemas: tuple[T.StructType, ...]) -> list[DataFrame]:
    """The cluster, link and keyword tables that ``replace_windows`` wrote."""
    keys = [keys[0] for keys in CLUSTER_TABLES.values()]
    return [table_at(spark, f"{folder}/{name}", schema).filter(F.col(key).isNotNull()).select(*schema.fieldNames())
            for name, schema, key in zip(CLUSTER_TABLES, schemas, keys)]


def latest_name(cluster_range: dict[str, int]) -> str:
    return f"latest_{format_range(cluster_range).replace(' ', '_')}.json"


def document_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json("document", {"ignoreNullFields": "false"}).alias("value"))


def publish_json(report: DataFrame, folder: str, cluster_range: dict[str, int]) -> str:
    """The one-row report as a JSON text file under ``latest_<n>_<unit>.json``."""
    path = f"{folder}/{latest_name(cluster_range)}"
    document_json(report).coalesce(1).write.mode("overwrite").text(path)
    return path


def publish_lines(lines: DataFrame, folder: str, cluster_range: dict[str, int]) -> str:
    """``document_lines`` as one file ``latest_<n>_<unit>.json``; the old document is there until the new one is written whole.

    One task sorts and writes the lines, as one file must be; it holds no more than a sort does, and spills.
    """
    spark = lines.sparkSession
    path, part = f"{folder}/{latest_name(cluster_range)}", f"{folder}/_publishing-{uuid.uuid4().hex}"
    lines.repartition(1).sortWithinPartitions("place").select("line").write.text(part)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = path_of(part).getFileSystem(spark._jsc.hadoopConfiguration())
    written = files.globStatus(path_of(f"{part}/part-*"))[0].getPath()
    files.delete(path_of(path), True)
    if not files.rename(written, path_of(path)):
        raise OSError(f"could not move the document to {path}")
    files.delete(path_of(part), True)
    return path


def append_search_log(log: DataFrame, path: str) -> int:
    """Add the rows of ``search_log`` to the stored log, in folders by day of their ``timestamp``; gives the number of rows."""
    batch = staged(log.withColumn("logged_on", F.to_date("timestamp")), "log")
    batch.repartition(folder_tasks(batch.sparkSession), "logged_on").write.mode("append").partitionBy("logged_on").parquet(path)
    return rows_added(batch)
