"""Sinks and manifests (S5, S6, S8, S10) and the packet stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.schema import PACKET


def write_split(df: DataFrame, path: str, fmt: str = "tsv", helper: str = "is_benign") -> None:
    """S5 (+ P6): a split without its helper column, as TSV with header or parquet."""
    out = df.drop(helper).write.mode("overwrite")
    if fmt != "parquet":            # values as they are, quotes doubled
        out = out.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if fmt == "tsv":
        out.option("sep", "\t").csv(path)
    elif fmt == "csv":
        out.csv(path)
    else:
        out.parquet(path)


def manifest(spark: SparkSession, paths: dict, fmt: str = "parquet") -> DataFrame:
    """Files, bytes (and MB) and rows behind each named dataset (file metadata column)."""
    parts = []
    for name, path in paths.items():
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True).option("sep", "\t")
        d = reader.load(path)
        parts.append(d.select(F.lit(name).alias("dataset"),
                              F.col("_metadata.file_path").alias("file"),
                              F.col("_metadata.file_size").alias("bytes")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.groupBy("dataset", "file").agg(F.max("bytes").alias("bytes"),
                                             F.count(F.lit(1)).alias("rows"))
            .withColumn("mb", F.round(F.col("bytes") / F.lit(1048576.0), 2)))


def write_scorecard(card: DataFrame, path: str) -> None:
    """Scorecards persisted as parquet (the reference prints them)."""
    card.write.mode("overwrite").parquet(path)


def packet_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Packet rows arriving as parquet files in a folder."""
    r = spark.readStream.schema(PACKET)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def alert_sink(alerts: DataFrame, path: str, checkpoint: str | None = None,
               trigger_once: bool = False) -> StreamingQuery:
    """Append alerts to parquet; the checkpoint (beside the output unless given) makes a
    restart, in this session or a later one, resume without duplicates."""
    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoint"
    w = (alerts.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(path)
