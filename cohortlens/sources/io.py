"""Readers and writers: CSV bound by header name, JDBC with partitioned reads.

* No schema inference unless it is asked for (``scan_inferred``): the header line names the columns, all are read as strings, the wanted
  ones are selected by name (a missing one raises); conversion to the declared types happens
  in the mapping operator (``try_cast``).
* Files of one source whose headers are equal are one scan; files with another column order
  are one scan for each order.  Spark checks the header of every file of a scan, and a line with
  more or fewer fields than the header stops the job (``on_bad_line="null"`` fills and cuts it).
* Paths are plain URIs; the Hadoop file system is picked by the scheme (``s3a://``,
  ``abfss://``, ``hdfs://``, ``file:``), credentials come from the session.
* JDBC reads are split on a column into range queries, which the caller states; Spark
  pushes projections and filters into them.  Writes set ``batchsize`` and the stated number
  of concurrent connections; ``truncate`` keeps the table definition on overwrite.  The append
  sink can skip keys already present.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.clean import quote
from cohortlens.operators.mapping import MappingSpec
from cohortlens.operators.relational import append_guard


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _reader(spark: SparkSession, delimiter: str, encoding: str):
    return spark.read.option("header", "true").option("sep", delimiter).option("encoding", encoding)


def csv_header(spark: SparkSession, path: str, delimiter: str = ";", encoding: str = "UTF-8") -> list[str]:
    """Column names in the first line of a file (or of a file of the folder)."""
    return _reader(spark, delimiter, encoding).csv(path).columns


def scan_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], delimiter: str = ";",
             encoding: str = "UTF-8", on_bad_line: str = "reject", quarantine: str | None = None) -> DataFrame:
    """The wanted ``columns`` of CSV source(s) with a header row, as strings, found by name.

    Headers may have more columns, in any order; all files of one folder have one header.  A line with too few or too many fields raises ("reject"), is
    taken with nulls ("null") or left out and written to the Parquet folder ``quarantine`` as (file, line, fields) ("quarantine"; the folder is replaced)."""
    if on_bad_line not in ("reject", "null", "quarantine"):
        raise ValueError("on_bad_line is 'reject', 'null' or 'quarantine'")
    if (on_bad_line == "quarantine") != (quarantine is not None):
        raise ValueError("'quarantine' and only it needs a folder")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in [paths] if isinstance(paths, str) else list(paths):
        header = csv_header(spark, path, delimiter, encoding)
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"{path}: no column {missing} in the header {header}")
        by_header.setdefault(tuple(header), []).append(path)
    wanted = [F.col(quote(c)) for c in columns]
    if on_bad_line == "quarantine":
        read = [_with_bad_lines(_reader(spark, delimiter, encoding), header, same) for header, same in by_header.items()]
        bad = [df.where(line.isNotNull()).select(F.input_file_name().alias("file"), line.alias("line"), F.array(*[F.col(quote(c)) for c in df.columns[:-1]]).alias("fields"))
               for df, line in read]
        reduce(DataFrame.union, bad).write.mode("overwrite").parquet(quarantine)
        # Spark refuses a query of the line alone, as a count would be: the length, never below 0, names another column
        return reduce(DataFrame.union, [df.where(line.isNull() | (F.length(F.col(quote(df.columns[0]))) < 0)).select(*wanted) for df, line in read])
    frames = [
        _reader(spark, delimiter, encoding).schema(string_schema(header)).option("enforceSchema", "false")
        .option("mode", "FAILFAST" if on_bad_line == "reject" else "PERMISSIVE").option("columnPruning", "false")
        .csv(same).select(*wanted)
        for header, same in by_header.items()]
    return reduce(DataFrame.union, frames)


def _with_bad_lines(reader, header: Sequence[str], paths: list[str]) -> tuple[DataFrame, Column]:
    """All columns and, last, the whole line where it doesn't fit the header."""
    name = "__line"
    while name in header:
        name += "_"
    df = (reader.schema(string_schema([*header, name])).option("enforceSchema", "false").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", name).option("columnPruning", "false").csv(paths))
    return df, F.col(name)


def scan_source(spark: SparkSession, paths: str | Sequence[str], spec: MappingSpec, on_bad_line: str = "reject", quarantine: str | None = None) -> DataFrame:
    """Raw source of a mapping job: the columns its spec reads, its delimiter and encoding."""
    return scan_csv(spark, paths, source_columns(spec), spec.delimiter, spec.encoding, on_bad_line, quarantine)


# The lattice of types, narrowest first, and the texts each takes (a date or timestamp also has to be one of the calendar).
TYPE_PATTERNS = {
    "integer": r"^[+-]?[0-9]{1,18}$",
    "decimal": r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$",
}
SPARK_TYPES = {"integer": "bigint", "decimal": "double", "date": "date", "timestamp": "timestamp_ntz", "text": "string"}


def infer_types(df: DataFrame) -> DataFrame:
    """(column, type, n, not_integer, not_decimal, not_date, not_timestamp) of text columns, by one aggregate over the rows.

    ``n`` counts the values (NULL and blank text are none), the others the values that break a type.  A column has the first type of the lattice that nothing
    breaks (integer below decimal; date below timestamp, which takes dates at midnight), else ``text``; a column without values is text."""
    aggs = []
    for i, c in enumerate(df.columns):
        x = F.trim(F.col(quote(c)))
        there = x.isNotNull() & (x != "")
        fits = {t: x.rlike(p) for t, p in TYPE_PATTERNS.items()}
        fits["date"] = fits["date"] & x.try_cast("date").isNotNull()
        fits["timestamp"] = fits["date"] | (fits["timestamp"] & x.try_cast("timestamp_ntz").isNotNull())
        aggs += [F.count(F.when(there, 1)).alias(f"n{i}"), *[F.count(F.when(there & ~f, 1)).alias(f"{t}{i}") for t, f in fits.items()]]
    found = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), *[F.col(f"{t}{i}").alias(f"not_{t}") for t in TYPE_PATTERNS]) for i, c in enumerate(df.columns)])
    out = found.select(F.explode(rows).alias("r")).select("r.*")
    kind = F.when(F.col("n") == 0, "text")
    for t in TYPE_PATTERNS:
        kind = kind.when(F.col(f"not_{t}") == 0, t)
    return out.select("column", kind.otherwise("text").alias("type"), "n", *[f"not_{t}" for t in TYPE_PATTERNS])


def scan_inferred(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], delimiter: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """``scan_csv`` with every column in its inferred type: one more pass over the files, exact over all rows."""
    raw = scan_csv(spark, paths, columns, delimiter, encoding)
    types = {r["column"]: SPARK_TYPES[r["type"]] for r in infer_types(raw).collect()}  # a row for each column
    return raw.select(*[F.col(quote(c)) if types[c] == "string" else F.trim(F.col(quote(c))).try_cast(types[c]).alias(c) for c in columns])


def source_columns(spec: MappingSpec) -> list[str]:
    return list(dict.fromkeys([*spec.sources, spec.key, *spec.extra_not_null]))


def sink_csv(df: DataFrame, path: str, delimiter: str = ";", encoding: str = "UTF-8",
             mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", "true").option("sep", delimiter).option("encoding", encoding)
     .csv(path))


def scan_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str,
              lower_bound: int, upper_bound: int, num_partitions: int, fetch_size: int = 10_000) -> DataFrame:
    """JDBC table read, split on ``partition_column`` into ``num_partitions`` range queries.

    The bounds place the ranges only; rows outside them fall into the first and the last one."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions, properties=props)


def sink_jdbc_overwrite(df: DataFrame, url: str, table: str, properties: dict, connections: int,
                        batch_size: int = 10_000, truncate: bool = True) -> None:
    # repartition, not coalesce: coalesce would shrink the whole upstream stage to
    # ``connections`` tasks; a shuffle keeps the computation wide and only caps connections
    (df.repartition(connections).write.option("truncate", str(truncate).lower())
     .option("batchsize", str(batch_size)).jdbc(url, table, mode="overwrite", properties=properties))


def sink_jdbc_append(df: DataFrame, url: str, table: str, properties: dict, connections: int,
                     existing: DataFrame | None = None, key: str | None = None, batch_size: int = 10_000) -> None:
    """Append; with ``existing`` (the target, read with ``scan_jdbc``) and ``key`` only rows whose key is
    not there yet (idempotent re-run, see ``append_guard``)."""
    if (existing is None) != (key is None):
        raise ValueError("existing and key belong together")
    out = df if existing is None else append_guard(df, existing, key)
    out.repartition(connections).write.option("batchsize", str(batch_size)).jdbc(
        url, table, mode="append", properties=properties)
