"""Order made visible as a column.

Two cases:

* `small_rank` ranks a result whose size has a known small bound (a top-N,
  or one row per category). A window over it is a single tiny partition.
* `global_rank` ranks a table of any size without moving it into one
  partition, and without computing its wide rows early: only the order columns
  are projected (so joins and columns that they do not need are never
  computed), counted by value, range-partitioned and numbered; a row's position
  is the number of rows in the partitions before plus those before it in its
  own. These narrow rows are checkpointed to the reliable checkpoint folder, so
  that partition sizes and rows come from one materialisation and a lost
  executor does not change the numbering. The wide rows meet their positions
  when the result is computed, by a join on the order columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as X


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder.

    Uses SparkContext's folder or `spark.checkpoint.dir`; with neither, on a
    local master, a folder in the session's warehouse. On a cluster an unset
    folder is an error, since a machine-local folder would not survive the
    loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/trialscope-checkpoints")
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                       "before ranking or writing intermediate tables")


def small_rank(df: DataFrame, order, name: str = "rk") -> DataFrame:
    """row_number() over a result with a small, known size bound."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def global_rank(df: DataFrame, order, name: str = "rk",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the ascending order of the columns
    `order` (expressions without a direction; nulls first). Rows that are equal
    in all of them share the position of the first, as SQL's rank() has it."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = max(1, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [f"__o{k}" for k in range(len(order))]
    keys = [X.col_of(c).alias(o) for c, o in zip(order, names)]
    numbered = (df.select(*keys).groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
                .repartitionByRange(n, *names).sortWithinPartitions(*names)
                .withColumn("__part", F.spark_partition_id())
                .checkpoint(eager=True))
    # One row per partition: bounded by the partition count.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("__part").agg(F.sum("__n").alias("__rows"))
               .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__off")))
    inside = Window.partitionBy("__part").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    places = (numbered.withColumn("__pos", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
              .join(F.broadcast(offsets), "__part")
              .select(*names, (F.col("__off") + F.col("__pos") + 1).cast("long").alias(name)))
    wide = df.select(*df.columns, *keys)
    same = [wide[o].eqNullSafe(places[o]) for o in names]
    return wide.join(places, reduce(lambda a, b: a & b, same)).select(*[wide[f"`{c}`"] for c in df.columns], places[name])
