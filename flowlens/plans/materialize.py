"""Lineage cuts for inputs that a plan reads several times.

Multi-pass plans (quantile boundaries, bucket counts, then the ranked pass) would otherwise
recompute an expensive input - e.g. the whole flow aggregation - once per pass.  A reliable
``checkpoint()`` writes it once to the session's shared checkpoint folder
(``spark.checkpoint.dir``; never an executor-local folder) and cuts the lineage, so a lost
executor costs a re-read of checkpoint files, not a recomputation from the raw scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.session import checkpoint_dir


#: Rows of a partition that a fit reads; a larger input has more partitions than the cluster cores.
FIT_ROWS = 1 << 19


def even_parts(spark: SparkSession, rows: int) -> int:
    """A multiple of the cluster's cores, so that the many short stages of a fit keep all cores busy."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, -(-rows // (cores * FIT_ROWS)))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over ``even_parts``, however few or uneven the files or partitions they come
    from; any part of them (a split in time, say) is then even, too."""
    return df.repartition(even_parts(df.sparkSession, df.count()))


def materialize(df: DataFrame, enabled: bool = True) -> DataFrame:
    if not enabled or df.isStreaming:
        return df
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
