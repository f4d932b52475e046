"""Monthly sales from a stream of sale events: an extension beside the batch build.

A month is closed when the watermark passes its end; only closed months go to the sink, each once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEYS = ["bravo_sku", "branch_code", "unit"]
#: The mark of event time in a column's metadata, with the delay.
_DELAY = "spark.watermarkDelayMs"


def monthly(events: DataFrame, late: str = "3 days") -> DataFrame:
    """Sums by item, branch, unit and month of event_time.

    The watermark runs on the events' own time.  Spark has no windows of months; the month's end is marked as what the state
    compares with that watermark, so a month stays open, for late events too, until the watermark has passed its end.
    """
    timed = events.withWatermark("event_time", late)
    delay = next(f.metadata[_DELAY] for f in timed.schema if f.name == "event_time")
    end = F.date_trunc("month", F.add_months("event_time", 1)).alias("month_end", metadata={_DELAY: delay})
    sums = timed.select(*KEYS, end, "quantity", "amount").groupBy(*KEYS, "month_end")
    sums = sums.agg(F.sum("quantity").alias("total_quantity"), F.sum("amount").alias("total_amount"), F.count("*").alias("line_count"))
    return sums.select(*KEYS, F.add_months("month_end", -1).alias("month"), "total_quantity", "total_amount", "line_count")


def start(events: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], late: str = "3 days") -> StreamingQuery:
    return monthly(events, late).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
