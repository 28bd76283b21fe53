"""Small helpers of the operators in this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``. Where it is unset and everything
    runs in one process, as in tests, a temporary folder takes its place."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet to the shared folder and read from there. Unlike a checkpoint they are
    compressed, and their size is known to whoever joins them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> tuple[DataFrame, str]:
    """Like ``stored``, but dealt by ``key`` into as many buckets as shuffles have partitions, so that joins on the key shuffle only
    their other side. Also the name under which the session's catalog knows the table, for ``drop_bucketed``."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{table}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(task_count(spark), key).saveAsTable(table)
    return spark.table(table), table


def drop_bucketed(df: DataFrame, table: str) -> None:
    """Delete a table from ``bucketed`` that nothing reads any more, with its files."""
    drop_stored(df)
    df.sparkSession.sql(f"drop table if exists {table}")


def drop_stored(*tables: DataFrame) -> None:
    """Delete the files of tables from ``stored`` that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        conf = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for file in table.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(conf).delete(folder, True)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal integer keys, in sorted batches, as one table."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[start] for c in columns)
            if held and key != before:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            before = key
    if held:
        yield pa.Table.from_batches(held)


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its place in the whole order, from 0 on, as the column ``rank``.

    Rows are range-partitioned and sorted, and written with the number of their partition and their number in it. What comes
    before a partition is summed over one row per partition. ``order`` must be total, so that equal keys are dealt out, too.
    """
    tasks = task_count(df.sparkSession)
    dealt = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("place", F.monotonically_increasing_id()), name)
    return numbered(placed).drop("place")


def numbered(placed: DataFrame) -> DataFrame:
    """Rows with a ``place`` (number of the partition, shifted by 33 bits, and gapless number in it) get their ``rank`` over all."""
    parts = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("rows"))
    # One row per partition, however large the table is.
    before = F.sum("rows").over(Window.orderBy("part")) - F.col("rows")
    parts = F.broadcast(parts.select("part", before.alias("before")))
    joined = placed.join(parts, F.shiftright("place", 33) == F.col("part"))
    return joined.withColumn("rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before")


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id as text falls into the fold; a null id is in none."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_sample(
    documents: DataFrame, labels: DataFrame, label: str, *, folds: int, fold: int, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts with labels to learn from, and the number of labelled rows per class.

    At most ``per_class`` rows of either class, those whose ids have the smallest hashes, from the rows outside the
    held-out fold. A document with several labels has the one that most of them give, 1 at a draw; one with several rows
    has the text with the least hash. So there are at most ``2 * per_class`` rows, whatever repeats. Columns ``doc_id``,
    ``text`` and ``y``.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    given = usable.groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
    counts = {row.y: row["count"] for row in given.groupBy("y").count().collect()}
    # Only about twice as many as are taken compete for the places, however many labels there are.
    draw, places = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), 1 << 40
    chosen = None
    for y in (0, 1):
        part = given.filter(F.col("y") == y)
        if counts.get(y, 0) > 2 * per_class + 100:
            part = part.filter(draw < int(places * (2 * per_class + 100) / counts[y]))
        part = part.orderBy(draw, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * per_class ids: small enough to broadcast whatever the size of the tables.
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    # An id may stand on any number of rows: one of its texts is taken, by partial minima, before anything is counted.
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return one.select("doc_id", F.col("least.text").alias("text"), "y"), counts
