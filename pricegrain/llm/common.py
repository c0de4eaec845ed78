"""What several of the training-data operators share: tables, cut lineage, components and ranks."""

from __future__ import annotations

import ctypes
import functools
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch where whole texts pass: Spark's own default would hold ten times as many in a worker.
BATCH_ROWS = 1000


def lean(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, which carry whole texts here, to ``BATCH_ROWS`` rows; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def tidy(run):
    """A task's generator that gives its freed memory back at the end: Spark keeps the worker for other tasks."""

    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
            if trim:
                trim(0)

    return whole


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Only in local mode (tests) a folder of this machine stands in where that is unset.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as a reliable checkpoint, so that a lost executor costs a read."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under the undirected links ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (id, label), label the smallest id of the component.

    Alternating large-star and small-star contraction. Every round keeps at most one link for each
    node and neighbour, its minima are aggregated before the shuffle, and the star centres meet
    their many neighbours in joins which adaptive execution may split. Nodes without links are absent. The rounds
    grow with the logarithm of the nodes and end when nothing changes.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        new = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if new == state:
            break
        state = new
    nodes = now.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return nodes.union(now.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())


def ranked(df: DataFrame, groups: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``rank`` (long, from 0) of each row within its group, in the given order.

    The rows are range-partitioned by group *and* order, so that a group that holds a third of all
    rows spreads over as many tasks. Only the first and the last group of a partition can go on
    elsewhere; the driver sees those two counts for each partition and nothing else.
    """
    spark = df.sparkSession
    columns, keys = df.columns, [*groups, *order]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()))
    schema = rows.schema
    code = F.struct(*groups)
    ends = rows.groupBy("_part").agg(F.min(code).alias("first"), F.max(code).alias("last"))
    counted = (
        rows.select("_part", code.alias("_g"))
        .join(F.broadcast(ends), "_part")
        .where(F.col("_g").eqNullSafe(F.col("first")) | F.col("_g").eqNullSafe(F.col("last")))
        .groupBy("_part", "_g")
        .count()
        .collect()
    )
    counts: dict[int, dict] = {}
    for r in counted:
        counts.setdefault(r["_part"], {})[tuple(r["_g"])] = r["count"]
    first = {r["_part"]: tuple(r["first"]) for r in ends.collect()}
    before: dict[int, int] = {}
    so_far: dict[tuple, int] = {}
    for p in sorted(first):
        before[p] = so_far.get(first[p], 0)
        for g, c in counts[p].items():
            so_far[g] = so_far.get(g, 0) + c

    @tidy
    def run(batches):
        last, at = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(c).to_pylist() for c in groups]
            part, heads, rank = batch.column("_part")[0].as_py(), zip(*values), []
            for head in heads:
                if head != last:
                    at = before[part] if last is None else 0
                    last = head
                rank.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank, pa.int64())], names=[*batch.schema.names, "rank"])

    out = rows.mapInArrow(run, StructType([*schema.fields, StructField("rank", LongType())]))
    return out.select(*columns, "rank")


def crc_fold(column: str = "doc_id"):
    """crc32 of the id as text, mod 4; null ids count as fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4, F.lit(0))


def mapped(df: DataFrame, keep: list[str], reads: list[str], adds: str, f, after=None) -> DataFrame:
    """Columns ``keep`` of ``df`` unchanged, and the columns ``adds`` (DDL) that ``f`` makes.

    ``f`` gets the columns ``reads`` of an Arrow batch as lists (nulls are None) and returns a list or
    array for each added column; ``after``, if given, is called when a task has no more batches. Kept columns stay in Arrow, so that null or large ids are exact.
    """
    new = StructType.fromDDL(adds)
    taken = {x.name for x in new}
    keep = [c for c in keep if c not in taken]
    at = [keep.index(c) if c in keep else len(keep) + i for i, c in enumerate(reads)]  # a column that is kept as well is sent once
    sent = [c for c, i in zip(reads, at) if i >= len(keep)]
    at = [i if i < len(keep) else len(keep) + sent.index(c) for c, i in zip(reads, at)]
    source = df.select(*[F.col(f"`{c}`") for c in [*keep, *sent]])

    @tidy
    def run(batches):
        for batch in batches:
            made = [pa.array(x, to_arrow_type(t.dataType)) for x, t in zip(f(*[batch.column(i).to_pylist() for i in at]), new)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[*keep, *new.names])
        if after:
            after()

    return source.mapInArrow(run, StructType([*source.schema.fields[: len(keep)], *new.fields]))
