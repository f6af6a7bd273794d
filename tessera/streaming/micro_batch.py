"""Row-local stages in micro-batches: units, numbers and name classes need no state; results append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions import numbers, predicates, text, units


def convert_cells(stream: DataFrame, value: str, unit: str) -> DataFrame:
    """Parsed value, canonical unit and family of each row of a stream or a table."""
    u = units.normalize_unit(F.col(unit))
    return stream.withColumns({"parsed": numbers.parse_number(F.col(value)), "canonical_unit": u["unit"], "unit_family": u["family"]})


def classify_names(stream: DataFrame, name: str) -> DataFrame:
    return stream.withColumn("skip", predicates.skip_class(text.unify_ascii(F.col(name))))


def append_new(stream: DataFrame, key: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows whose key the table at `path` does not hold yet; a batch that is run again writes nothing twice."""
    from tessera.sources.sinks import append_checkpoint, pending

    def write(batch: DataFrame, _: int) -> None:
        append_checkpoint(pending(batch.dropDuplicates([key]), key, path), path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(stream: DataFrame, ts: str, status: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Statuses counted in tumbling windows, with a watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window), status).agg(F.count("*").alias("n"))
