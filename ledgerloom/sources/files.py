"""Reading deliveries: CSV, JSON documents, optional files, columns under other names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
FILE_ORDER = ("_file", "_block", "_row")


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, date_format: str | None = None,
             keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header and a declared schema.

    With ``keep_corrupt`` a row that does not fit goes to ``_corrupt_record``
    instead of being lost.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if keep_corrupt:
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.schema(schema).csv(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw lines that do not.

    The delivery is written out once with every column parsed: a later query
    reads only some columns, and a fault in an unread column would go unseen.
    """
    whole = materialize(df, "delivery")
    bad = F.col("_corrupt_record").isNotNull()
    return whole.filter(~bad).drop("_corrupt_record"), whole.filter(bad).select("_corrupt_record")


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the position of each row in its source files, for keep-first rules.

    File name, then block start, then row within the task: a task reads whole
    blocks in order, so the three together follow the file.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_optional(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet") -> DataFrame | None:
    """The delivery, or ``None`` when it was not made; operators then use their defaults."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def read_json_documents(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """Ledger documents; an empty frame of the same schema when there are none yet.

    One JSON array per file needs ``multi_line`` and cannot be split, so ledgers
    that grow are kept one document per line.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", multi_line).option("timestampNTZFormat", JSON_TIME).json(path)


def resolve_columns(df: DataFrame, spec: Mapping[str, Sequence], case_insensitive: bool = False) -> DataFrame:
    """Bring a delivery with unknown headers to target columns.

    ``spec`` maps each target to ``(aliases, type, default)``; the first alias
    present is cast (a bad value becomes NULL, then the default). A default may
    be a Column over the targets resolved before it. ``required`` as default
    means: fail when no alias is present.
    """
    present = {(c.strip().lower() if case_insensitive else c): c for c in df.columns}
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_src"))
    for target, (aliases, to, default) in spec.items():
        found = next((present[a] for a in aliases if a in present), None)
        required = isinstance(default, str) and default == REQUIRED
        if found is None and required:
            raise ValueError(f"none of {list(aliases)} is among the columns {df.columns}")
        fallback = None if required else (default if not isinstance(default, (str, int, float, bool)) else F.lit(default))
        value = F.col("_src").getField(found).try_cast(to) if found is not None else F.lit(None).cast(to)
        if fallback is not None:
            value = F.coalesce(value, fallback.cast(to))
        out = out.withColumn(target, value)
    return out.drop("_src")


REQUIRED = "required"
