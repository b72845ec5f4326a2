"""The silver job on Structured Streaming.

The stream reads a change feed and not the raw zone: each run lists the zone once and appends the
versions of files that the registry does not hold, as rows of (path, modification time), to the
feed. Its offset is a place in that feed, so what Spark remembers grows with the feed files of a
week and not with the zone; a file that is old, late or rewritten is a new row like any other.
Rows of a feed file that Spark has forgotten come again, because they are not registered.

Every micro-batch is loaded like a batch run: the listed files are opened, and no others, the
sinks are keyed, and the registry is written last. Upcoming fixtures are replaced on every run and
are left to the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.silver import load, new_in_zone
from ledgerline.session import cut_lineage
from ledgerline.sources import raw as raw_zone
from ledgerline.sources.tables import Paths, path_exists

CHANGE = "path string, modification_time timestamp"


def discover(spark: SparkSession, paths: Paths, files_per_batch: int) -> int:
    """Append to the feed what the registry does not hold; a feed file is the work of one batch."""
    new = new_in_zone(spark, paths).filter(~F.col("path").contains(f"/{raw_zone.UPCOMING}/"))
    new = cut_lineage(new.select("path", "modification_time"))
    found = new.count()
    if found or not path_exists(spark, paths.feed):
        new.repartition(max(1, -(-found // files_per_batch))).write.mode("append").parquet(paths.feed)
    return found


def change_stream(spark: SparkSession, paths: Paths) -> DataFrame:
    """The feed as a stream, a feed file per batch; files of finished batches are deleted."""
    feed = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).option("cleanSource", "delete")
    return feed.parquet(paths.feed)


def run_available(
    spark: SparkSession, paths: Paths, checkpoint: str, overrides: DataFrame | None = None,
    files_per_batch: int = 100_000,
) -> StreamingQuery:
    """Process every file not seen in its present version yet and stop."""
    discover(spark, paths, files_per_batch)

    def process(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        # After a failure a change may be in the feed twice.
        new = raw_zone.new_files(batch.distinct(), raw_zone.read_registry(own, paths.registry))
        new = cut_lineage(new)
        if not new.isEmpty():
            load(own, paths, new, overrides, replace_upcoming=False)

    query = (
        change_stream(spark, paths)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
