"""Next-row-per-key in time order, without putting one key into one task.

``lead(x) over (partition by key order by ts)`` sends every row of a key to a
single task; one heavy key (say a third of all rows) then becomes one huge
sort. Here the window is partitioned by ``(key, time bucket)`` instead, and the
last row of each bucket takes its successor from the first row of the key's
next non-empty bucket. That second step runs on one row per (key, bucket),
so its size is bounded by the number of buckets, not by the number of rows.

Plan: one shuffle of the input on ``(key, bucket)`` feeds the bucket window.
The bucket heads (``row_number() = 1``) become a map-side ``WindowGroupLimit``
in Spark: that branch shuffles at most one row per (key, bucket) and map task,
then one row per bucket by ``key`` alone, and is joined back on
``(key, bucket)``, where the big side is already partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.session import scratch_path


def with_next(
    df: DataFrame,
    *,
    key: str,
    order: Sequence[str],
    carry: Sequence[str],
    suffix: str = "_next",
    bucket_unit: str = "HOUR",
) -> DataFrame:
    """Attach ``<c><suffix>`` = value of ``c`` on the next row of the same ``key``.

    ``order`` lists the sort columns; the first must be a timestamp and the
    whole list must be unique within a key. Rows with no successor get NULL.
    ``bucket_unit`` is the ``date_trunc`` unit that splits a key's rows into
    independently sorted groups; pick it so one bucket of the heaviest key fits
    a task (HOUR for typical data, MINUTE for very dense keys).
    """
    gkey, bucket, head, following, is_last = "_seq_key", "_seq_bucket", "_seq_head", "_seq_following", "_seq_is_last"
    carry = list(carry)

    # Grouping columns wrapped in structs: never NULL themselves, equal when
    # their contents are both NULL. NULL keys (or times) then group together
    # as in lead(), and a plain equi-join on them keeps the window's hash
    # partitioning (a null-safe join would re-shuffle the big side).
    with_bucket = df.select(
        "*",
        F.struct(F.col(key).alias("v")).alias(gkey),
        F.struct(F.date_trunc(bucket_unit, F.col(order[0])).alias("v")).alias(bucket),
    )
    w_in = Window.partitionBy(gkey, bucket).orderBy(*order)
    in_bucket = with_bucket.select(
        "*",
        *[F.lead(c).over(w_in).alias(c + suffix) for c in carry],
        F.lead(F.lit(True)).over(w_in).isNull().alias(is_last),
        (F.row_number().over(w_in) == 1).alias(head),
    )

    heads = in_bucket.filter(F.col(head)).select(
        gkey, bucket, F.struct(*[F.col(c).alias(f"c{j}") for j, c in enumerate(carry)]).alias("_seq_values")
    )
    w_key = Window.partitionBy(gkey).orderBy(bucket)
    successors = heads.select(gkey, bucket, F.lead("_seq_values").over(w_key).alias(following))

    joined = in_bucket.join(successors, on=[gkey, bucket], how="left")
    fixed = [
        F.when(F.col(is_last), F.col(f"{following}.c{j}")).otherwise(F.col(c + suffix)).alias(c + suffix)
        for j, c in enumerate(carry)
    ]
    return joined.select(*df.columns, *fixed)


def with_rank(df: DataFrame, side: str, order: Sequence[Column], name: str) -> DataFrame:
    """``row_number()`` of each row within ``side`` by ``order``, without a task per side.

    Rows are range-partitioned by (side, order) and written to the checkpoint
    folder with their place in the partition; what lies before a partition is the
    sum of the sizes before it, one small row for each partition and side. Rows
    that ``order`` can't tell apart are ranked arbitrarily among themselves.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    placed = df.repartitionByRange(F.col(side), *order).sortWithinPartitions(F.col(side), *order)
    placed.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")).write.parquet(path)
    rows = spark.read.parquet(path)
    first = rows.groupBy(side, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(side).orderBy("_part")) - F.col("_n")
    offsets = first.select(side, "_part", "_first", before.alias("_before"))
    rank = (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("int")
    return rows.join(F.broadcast(offsets), [side, "_part"]).select(*df.columns, rank.alias(name))
