"""Incremental ingest of the mapping jobs with Structured Streaming.

The original jobs re-read whole extracts on every run.  The same mapping operator
can run on a file stream instead: new CSV files dropped into the source folder are
read with the fixed schema, mapped (filter + project, stateless, so no watermark or
state store is needed) and handed to a batch sink per micro-batch (``foreachBatch``),
e.g. the JDBC append sink.  Progress is tracked in a checkpoint location on shared
storage that the caller names, so a restarted driver resumes where it stopped and files are
processed once.  Columns are bound by the header names: the header of one file that is there at
the start (``sample``) gives the order, and Spark checks the header of every file against it.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cohortlens.functions.clean import raw
from cohortlens.operators.mapping import MappingSpec, apply_mapping
from cohortlens.sources.io import csv_header, source_columns, string_schema


def stream_source(spark: SparkSession, path: str, spec: MappingSpec, max_files_per_trigger: int | None = None,
                  sample: str | None = None) -> DataFrame:
    header = csv_header(spark, sample or path, spec.delimiter, spec.encoding)
    cols = source_columns(spec)
    missing = [c for c in cols if c not in header]
    if missing:
        raise ValueError(f"{sample or path}: no column {missing} in the header {header}")
    reader = (spark.readStream.schema(string_schema(header)).option("header", "true").option("enforceSchema", "false")
              .option("sep", spec.delimiter).option("encoding", spec.encoding)
              .option("mode", "FAILFAST").option("columnPruning", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(path).select(*[raw(c) for c in cols])


def stream_mapping(spark: SparkSession, path: str, spec: MappingSpec, max_files_per_trigger: int | None = None,
                   sample: str | None = None) -> DataFrame:
    """Streaming DataFrame of the mapped rows of every file arriving in ``path``."""
    return apply_mapping(stream_source(spark, path, spec, max_files_per_trigger, sample), spec)


def start_ingest(mapped: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
                 available_now: bool = True, path: str | None = None,
                 fmt: str = "parquet") -> StreamingQuery:
    """Start the ingest, or go on where the last start with this ``checkpoint`` folder stopped.

    With ``path`` the mapped rows are appended to a table folder by Spark's file sink
    (exactly once, tracked in the checkpoint; runs entirely in the JVM).  With ``sink``
    each micro-batch is handed to ``sink(batch_df, batch_id)`` (``foreachBatch``), e.g.
    the JDBC append sink.  ``available_now`` processes what is there and stops
    (scheduled runs); otherwise the query runs continuously.
    """
    w = mapped.writeStream.option("checkpointLocation", checkpoint)
    if path is not None:
        w = w.format(fmt).option("path", path).outputMode("append")
    elif sink is not None:
        w = w.foreachBatch(sink)
    else:
        raise ValueError("start_ingest needs a path or a sink")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
