"""Structured Streaming over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from claimspan.functions.measures import money
from claimspan.operators.etl import key_claims, settle_claims, settled_claims
from claimspan.operators.id_index import IdIndex
from claimspan.session import beside, remove_dir, scratch_dir
from claimspan.sources.readers import INBOUND_OPTIONS, from_code_page_1252, path_exists
from claimspan.sources.schemas import INBOUND_CLAIMS


def file_stream(
    spark: SparkSession,
    in_dir: str,
    schema: T.StructType | str,
    archive_dir: str | None = None,
    file_format: str = "csv",
    **options: str,
) -> DataFrame:
    """Stream of new files; with ``archive_dir`` a file is moved there once its batch is done."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(in_dir)


def inbound_stream(spark: SparkSession, in_dir: str, archive_dir: str | None = None) -> DataFrame:
    return from_code_page_1252(file_stream(spark, in_dir, INBOUND_CLAIMS, archive_dir, **INBOUND_OPTIONS))


def start_claims_ingest(
    raw: DataFrame, members: DataFrame, providers: DataFrame, target: str, checkpoint: str
) -> StreamingQuery:
    """Convert, route, and write accepted and rejected rows of each micro-batch.

    Every row of the source gets one outcome: claims that fail conversion, have no known member or provider,
    are accepted already, or are repeated in the batch are rejected with that reason; a claim that was rejected
    can be delivered again corrected. Ids are compared after conversion with those ``target`` has accepted, so
    nothing is forgotten; they stand in an index, ``<target>_ids``, of which a batch opens only the buckets that its
    own ids fall into. Rows are written as ``batch_id=.../outcome=...`` of one Parquet table; a batch that is
    run again after a failure replaces what it had written.
    """
    spark = raw.sparkSession
    index = IdIndex(spark, f"{target.rstrip('/')}_ids")

    def settle(batch: DataFrame, batch_id: int) -> None:
        staged: list[str] = []

        def stage(df: DataFrame, name: str) -> DataFrame:
            staged.append(scratch_dir(spark, name, beside(target)))
            df.write.parquet(staged[-1])
            return spark.read.schema(df.schema).parquet(staged[-1])

        try:
            rows = stage(batch.withColumn("_row", F.monotonically_increasing_id()), "batch")
            classified = stage(key_claims(rows, members, providers), "batch-classified")
            index.resume(batch_id)
            if path_exists(spark, target):  # written before there was an index
                before = (F.col("outcome") == "accepted") & (F.col("batch_id") < batch_id)
                index.recover(spark.read.parquet(target).filter(before).select("conv_claim_id"))
            sound = classified.filter(F.col("reject_reason").isNull()).select("conv_claim_id")
            loaded = index.candidates(sound).withColumnRenamed("id", "claim_id")
            settled = settled_claims(stage(settle_claims(rows, classified, loaded, stage).drop("_row"), "batch-settled"))
            index.begin(settled.filter(F.col("reject_reason").isNull()).select("conv_claim_id"), batch_id)
            outcome = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
            writer = settled.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("outcome", outcome).write
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("batch_id", "outcome").parquet(target)
        finally:
            for folder in staged:
                remove_dir(spark, folder)

    return (
        raw.writeStream.foreachBatch(settle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_summary(stream: DataFrame, by: str = "claim_status", amount: str = "billed_amount") -> DataFrame:
    """Running count and amount per group; the same result as the batch aggregate."""
    return stream.groupBy(by).agg(
        F.count("*").alias("claim_count"), money(F.sum(amount)).alias("total_billed_amount")
    )


def run_summary(summary: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a complete-mode aggregate over all files present now and return its result table.

    Each batch replaces the Parquet table at ``path`` with the whole result, so the groups stay on the
    executors and a batch that is run again does no harm.
    """

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = (
        summary.writeStream.foreachBatch(replace)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return summary.sparkSession.read.schema(summary.schema).parquet(path)
