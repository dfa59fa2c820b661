"""Landing files: load what fits the declared schema, set the rest aside with a reason.

A line is rejected as a whole when it has the wrong number of fields, when a
field cannot be read as its declared type, or when a required field is empty.
An empty field is null. A number with decimals rounds to the nearest whole one
in a whole-number column. There is no header: a header line is just a line that
does not fit.

``load_csv`` and ``load_audit`` are lazy and parse when they are used. ``stage`` parses once for good rows, rejects, audit and
counts together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_unparsed"


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return text.try_cast(T.DecimalType(38, 0)).try_cast(kind)
    return text.try_cast(kind)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line, file_path) for every line below ``path``."""
    return spark.read.text(path, recursiveFileLookup=True).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path")
    )


def parse_lines(
    lines: DataFrame,
    schema: T.StructType,
    not_null: Sequence[str] = (),
    sep: str = ",",
    quote: str = "",
) -> DataFrame:
    """Add the schema's columns and ``reason`` (null for a good line) to ``lines``.

    Lines are split by Spark's CSV expression, not the CSV file reader: the reader
    skips unread columns, so whether a line counts as bad would depend on the query.
    """
    names = schema.fieldNames()
    texts = T.StructType(
        [T.StructField(n, T.StringType()) for n in names] + [T.StructField(_BAD, T.StringType())]
    )
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
        "sep": sep,
        "quote": quote,
        "nullValue": "",
    }
    ddl = ", ".join(f"`{f.name}` string" for f in texts.fields)
    # Produced by a generator, the fields are split once per line; as a plain
    # column the split would be repeated in every condition pushed below it.
    raw = lines.select("*", F.inline(F.array(F.from_csv("line", ddl, options))))
    fields = [(f, F.col(f.name), _typed(F.col(f.name), f.dataType)) for f in schema.fields]
    blank = F.length(F.trim("line")) == 0
    unreadable = reduce(or_, [text.isNotNull() & value.isNull() for _, text, value in fields])
    missing = reduce(or_, [text.isNull() for f, text, _ in fields if f.name in not_null], F.lit(False))
    reason = (
        F.when(F.col(_BAD).isNotNull() | blank, "field count")
        .when(unreadable, "unreadable value")
        .when(missing, "required value missing")
    )
    return raw.select(
        *lines.columns,
        *[value.alias(f.name) for f, _, value in fields],
        reason.alias("reason"),
    )


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    not_null: Sequence[str] = (),
    sep: str = ",",
    quote: str = "",
) -> tuple[DataFrame, DataFrame]:
    """Good rows under ``schema``, and rejected lines with their reason and file."""
    parsed = parse_lines(read_lines(spark, path), schema, not_null, sep, quote)
    good = parsed.filter("reason is null").select(*schema.fieldNames())
    rejects = parsed.filter("reason is not null").select("file_path", "line", "reason")
    return good, rejects


def load_audit(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    not_null: Sequence[str] = (),
    sep: str = ",",
    quote: str = "",
) -> DataFrame:
    """Lines read, loaded and rejected per landing file, in one pass."""
    parsed = parse_lines(read_lines(spark, path), schema, not_null, sep, quote)
    return parsed.groupBy("file_path").agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("reason").isNull()).alias("rows_loaded"),
        F.count_if(F.col("reason").isNotNull()).alias("rows_rejected"),
    )


@dataclass(frozen=True)
class Staged:
    """What one parse of landing files gave, as stored.

    ``good`` has the declared schema, ``rejects`` the file, line and reason, ``audit`` lines read, loaded and rejected per
    file, ``counts`` the same three over all files, counted while the stage was written.
    """

    good: DataFrame
    rejects: DataFrame
    audit: DataFrame
    counts: dict[str, int]


_LOADED = "loaded"


def stage(
    spark: SparkSession,
    path: str | list[str],
    target: str,
    schema: T.StructType,
    not_null: Sequence[str] = (),
    sep: str = ",",
    quote: str = "",
) -> Staged:
    """Parse the landing files once, into a folder ``target`` partitioned by what became of a line.

    A good line keeps its values, a rejected one its text; readers of one kind skip the folders of the others.
    """
    parsed = parse_lines(read_lines(spark, path), schema, not_null, sep, quote)
    outcome = F.coalesce("reason", F.lit(_LOADED))
    rows = parsed.select(
        *schema.fieldNames(),
        "file_path",
        F.when(F.col("reason").isNotNull(), F.col("line")).alias("line"),
        outcome.alias("outcome"),
    )
    seen = Observation()
    loaded = F.col("outcome") == _LOADED
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(loaded).alias("rows_loaded"),
        F.count_if(~loaded).alias("rows_rejected"),
    )
    counted.write.partitionBy("outcome").parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    good = stored.filter(loaded).select(*schema.fieldNames())
    rejects = stored.filter(~loaded).select("file_path", "line", F.col("outcome").alias("reason"))
    audit = stored.groupBy("file_path").agg(
        F.count("*").alias("rows_read"),
        F.count_if(loaded).alias("rows_loaded"),
        F.count_if(~loaded).alias("rows_rejected"),
    )
    return Staged(good, rejects, audit, dict(seen.get))
