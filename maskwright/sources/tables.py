"""Readers and writers of item tables.

Spark reads a CSV file that has line breaks inside fields in one task. So ``write_csv(..., escaped=True)``
writes each row in one line: a backslash becomes ``\\s``, line feed and carriage return become ``\\n`` and
``\\r``, a null becomes ``\\N``, and nested values are JSON. ``read_csv(..., escaped=True)`` undoes that with
built-in functions, in as many tasks as the file has splits, and gives back every value and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType

NESTED = (StructType, ArrayType, MapType)
NULL = "\\N"
# A backslash is undone last: until then each one in the text begins an escape.
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def escape(text: Column) -> Column:
    """Text as one line, null included."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.coalesce(text, F.lit(NULL))


def unescape(text: Column) -> Column:
    """What :func:`escape` was given."""
    out = F.coalesce(text, F.lit(""))
    for plain, code in reversed(ESCAPES):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return F.when(F.coalesce(text, F.lit("")) != NULL, out)


def _as_text(value: Column, kind: DataType) -> Column:
    if isinstance(kind, NESTED):
        return F.to_json(value)
    return F.base64(value) if isinstance(kind, BinaryType) else value.cast("string")


def _from_text(text: Column, kind: DataType) -> Column:
    if isinstance(kind, NESTED):
        return F.from_json(text, kind)
    return F.unbase64(text) if isinstance(kind, BinaryType) else text.cast(kind)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet rows as items, narrowed to the columns in use."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    multiline: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """CSV rows with a header as items; all columns are strings unless a schema is given.

    Quotes inside a field are doubled. ``escaped`` reads what ``write_csv`` has escaped, with the
    schema of what was written. For files from elsewhere ``multiline`` is needed when fields hold line
    breaks, and makes each file one task: split such exports into several files.
    """
    reader = spark.read.option("header", True).option("escape", '"').option(
        "multiLine", multiline
    )
    if not escaped:
        return (reader.schema(schema) if schema else reader).csv(path)
    if not schema or multiline:
        raise ValueError("escaped rows are single lines and need the schema of what was written")
    fields = StructType.fromDDL(schema).fields
    texts = reader.schema(", ".join(f"`{f.name}` string" for f in fields)).csv(path)
    return texts.select(
        *[_from_text(unescape(F.col(f"`{f.name}`")), f.dataType).alias(f.name) for f in fields]
    )


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines as items. The schema is required: inferring it would read everything twice."""
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", escaped: bool = False) -> None:
    """Write rows to CSV with a header; nested columns become JSON text.

    With ``escaped`` each row is one line and can be read back as it was, by many tasks.
    """
    def shown(name: str, kind: DataType) -> Column:
        value = F.col(f"`{name}`")
        if escaped:
            return escape(_as_text(value, kind)).alias(name)
        return F.to_json(value).alias(name) if isinstance(kind, NESTED) else value

    writer = (
        df.select(*[shown(f.name, f.dataType) for f in df.schema.fields])
        .write.mode(mode).option("header", True).option("escape", '"')
    )
    if escaped:
        # Blanks at either end of a field are part of it.
        writer = writer.options(
            quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.csv(path)


def write_routed(
    df: DataFrame, path: str, route: Column, name: str = "route", mode: str = "error"
) -> dict[str, int]:
    """Write one table with a folder for each value of ``route``, from one scan.

    Returns the number of rows that went each way, counted on the way. They are compared with what
    can be read back, so a write that lost or repeated rows does not pass.
    """
    seen = Observation()
    routed = df.withColumn(name, route)
    routed.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).partitionBy(name).parquet(path)
    back = df.sparkSession.read.schema(routed.schema).parquet(path)
    ways = {r[0]: r[1] for r in back.groupBy(name).count().collect()}
    if sum(ways.values()) != seen.get["rows"]:
        raise RuntimeError(f"{seen.get['rows']} rows were written to {path}, {sum(ways.values())} can be read")
    return ways
