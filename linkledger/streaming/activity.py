"""Activity pages as a stream: events per 24-hour tile in event time, and the events that came too late for theirs.

The count of a tile is state under a watermark, so state holds the tiles that can still change and no events. Each
micro-batch writes the tiles it changed under its own number; a batch that runs again rewrites the same folder, and of
a tile the last batch that has it counts. What each batch brought, late or not, is counted beside it from the same
events, so the difference is what the watermark turned away: nothing is dropped unseen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.operators import activity as A
from linkledger.sinks import snapshots as S

_COUNTS = T.StructType([T.StructField("tile_start", T.TimestampType()), T.StructField("events", T.LongType()), T.StructField("batch", T.LongType())])


def read_page_stream(spark: SparkSession, path: str, glob: str = "*.txt", files_per_trigger: int = 1000) -> DataFrame:
    """Events of newly landed pages, one page a line."""
    pages = (
        spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger).load(path)
    )
    return A.unnest_pages(pages.withColumnRenamed("value", "text"))


def stage_tiles(events: DataFrame, out: str, checkpoint: str, delay: str = "1 hour", offset: str = "0 seconds") -> None:
    """Run the stream over everything landed so far.

    ``delay`` is how far events may be behind the latest one; ``offset`` is where a tile starts after midnight in UTC. Events
    without a readable time have no tile.
    """
    timed = events.select(F.try_to_timestamp("CreationTime").alias("at")).filter(F.col("at").isNotNull())
    tile = F.window("at", "1 day", startTime=offset)
    counts = timed.withWatermark("at", delay).groupBy(tile.alias("tile")).agg(F.count(F.lit(1)).alias("events"))
    brought = timed.select(tile["start"].alias("tile_start"))

    def put(rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch}")

    def tiles(batch: DataFrame, number: int) -> None:
        put(batch.select(F.col("tile.start").alias("tile_start"), "events"), "tiles", number)

    def arrivals(batch: DataFrame, number: int) -> None:
        put(batch.groupBy("tile_start").agg(F.count(F.lit(1)).alias("events")), "brought", number)

    for stream, mode, write, name in ((counts, "update", tiles, "tiles"), (brought, "append", arrivals, "brought")):
        query = (
            stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COUNTS).parquet(path) if S.path_exists(spark, path) else spark.createDataFrame([], _COUNTS)


def read_tiles(spark: SparkSession, out: str) -> DataFrame:
    """``tile_start``, the ``events`` counted in it and the ``late`` ones that were not."""
    counted = _read(spark, f"{out}/tiles").groupBy("tile_start").agg(F.max_by("events", "batch").alias("events"))
    brought = _read(spark, f"{out}/brought").groupBy("tile_start").agg(F.sum("events").alias("brought"))
    both = brought.join(counted, "tile_start", "left")
    events = F.coalesce("events", F.lit(0)).cast("long")
    return both.select("tile_start", events.alias("events"), (F.col("brought") - events).alias("late"))


def day_tiles(tiles: DataFrame, end: Column, days: int = 30) -> DataFrame:
    """The window's tiles, also those without events, as :func:`linkledger.operators.activity.day_tiles` gives them."""
    start = A.window_start(end, days)
    every = tiles.sparkSession.range(days).select(F.col("id").cast("int").alias("tile"))
    begin = start + F.make_dt_interval(days=F.col("tile"))
    listed = every.select("tile", begin.alias("tile_start"), F.least(begin + F.make_dt_interval(days=F.lit(1)), end).alias("tile_end"))
    found = listed.join(tiles, "tile_start", "left")
    return found.select("tile", "tile_start", "tile_end", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("events", "late")])
