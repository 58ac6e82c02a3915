"""Staging load: typed read of a batch of star files under the table contract.

The contract of a staging table is its declared StructType plus NOT NULL keys.
Column presence and type compatibility are checked from file metadata before
any data is read; the NOT NULL rule is a lazy guard inside the projection, so
it costs no extra pass and fails the first job that touches a bad row.
Staging frames are per run: nothing accumulates between runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
)

from starmart.schemas import TableSpec

_WIDENS_TO: dict[type, tuple[type, ...]] = {
    LongType: (ByteType, ShortType, IntegerType, LongType),
    IntegerType: (ByteType, ShortType, IntegerType, LongType),
    DoubleType: (FloatType, DoubleType, ByteType, ShortType, IntegerType, LongType),
}


class ContractError(ValueError):
    """A staging batch does not meet its table's declared shape."""


def _compatible(found: DataType, declared: DataType) -> bool:
    if type(found) is type(declared):
        return True
    return type(found) in _WIDENS_TO.get(type(declared), ())


def load_staging(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """Read ``path`` as the staging frame of ``spec``.

    Extra file columns are ignored; missing or incompatible ones raise
    ``ContractError`` at once. Values are cast to the declared types, and a
    null key raises when the frame is evaluated.
    """
    return enforce_contract(read_staging(spark, path, spec), spec)


def read_staging(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """``path`` as stored, after the check of columns and types (``ContractError``)."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        raw = spark.read.parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        raw = spark.read.schema(spec.schema).parquet(*paths)  # an empty batch has no file
    found = {f.name: f.dataType for f in raw.schema.fields}
    problems = []
    for field in spec.schema.fields:
        if field.name not in found:
            problems.append(f"missing column {field.name}")
        elif not _compatible(found[field.name], field.dataType):
            problems.append(
                f"column {field.name}: {found[field.name].simpleString()} "
                f"is not {field.dataType.simpleString()}"
            )
    if problems:
        raise ContractError(f"{spec.name}: " + "; ".join(problems))
    return raw


def split_rejects(raw: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows with all keys, rejects) of a staging frame, in declared columns and types.

    Rejects are (table_name, reason, row), the row as JSON text. Their predicate is
    on stored key columns, so a scan for rejects skips every row group whose
    statistics hold no null there.
    """
    typed = raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields))
    missing = [F.when(F.col(k).isNull(), F.lit(k)) for k in spec.keys]
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
    reason = F.concat(F.lit("NULL in key column "), F.concat_ws(", ", *missing))
    row = F.to_json(F.struct(*spec.schema.fieldNames()), {"ignoreNullFields": "false"})
    rejects = typed.where(bad).select(F.lit(spec.name).alias("table_name"), reason.alias("reason"), row.alias("row"))
    return typed.where(~bad), rejects


def enforce_contract(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project ``df`` to the declared columns and types with NOT NULL key guards."""
    cols = []
    for field in spec.schema.fields:
        c = F.col(field.name).cast(field.dataType)
        if field.name in spec.keys:
            c = F.when(
                c.isNull(),
                F.raise_error(F.lit(f"{spec.name}: NULL in key column {field.name}")),
            ).otherwise(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)
