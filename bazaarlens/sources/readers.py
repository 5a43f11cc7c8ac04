"""Reading tables and registering them by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Column names as exported, and the names the operators expect.
CLEAN_NAMES = {
    "platform order": "platform_order",
    "grass_region": "region",
}
#: The name Spark gives to a column without a header: the index of an export.
INDEX_COLUMN = "_c0"
#: Files whose headers are read at a time.
HEADERS_AT_ONCE = 16


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
    names: Mapping[str, str] = CLEAN_NAMES,
    rejected: str | None = None,
) -> DataFrame:
    """Read CSV with a header row in each file.

    With ``schema`` columns are matched by name, whatever their order in a file: header
    names are first renamed by ``names``; a declared column that a file lacks raises,
    except for the index column, which is null there; columns beyond the declared ones are
    text, null where a file lacks them. Only the headers are read for that, file by file;
    files of one header are one scan. Without ``schema`` the types are inferred by an extra
    pass over ``sampling_ratio`` of the rows, nothing is renamed, and files whose headers
    differ raise.

    A value that does not parse is null. ``rejected`` names one more column, which tells
    file, line and columns where a value does not parse or the number of values is wrong,
    and is null elsewhere: see :func:`split_rejected`.
    """
    headers = file_headers(spark, path)
    reader = spark.read.option("header", True)
    if schema is None:
        if rejected is not None:
            raise ValueError("rejected values need a schema")
        if len(headers) > 1:
            told = "; ".join(f"{files[0]}: {', '.join(header)}" for header, files in headers.items())
            raise ValueError(f"{path} has files with different headers ({told}); a schema is needed")
        return reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in declared}
    parts = []
    for header, files in headers.items():
        found = [names.get(c, c) for c in header]
        missing = [c for c in kinds if c not in found and c != INDEX_COLUMN]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}; it has {', '.join(found)}")
        fields = [StructField(c, kinds.get(c, StringType())) for c in found]
        source = path if len(headers) == 1 else files
        if rejected is None:
            parts.append(reader.schema(StructType(fields)).csv(source))
        else:
            line = StructField(rejected, StringType())
            typed = reader.option("columnNameOfCorruptRecord", rejected).schema(StructType([*fields, line]))
            parts.append(typed.csv(source).withColumn(rejected, _rejection(fields, rejected)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def file_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header, in the order of their names.

    One small job a file, several at a time, that reads its first line.
    """
    reader = spark.read.option("header", True)
    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    if len(files) < 2:
        return {tuple(reader.csv(path).columns): files}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        found: dict[tuple[str, ...], list[str]] = {}
        for file, header in zip(files, pool.map(lambda f: tuple(reader.csv(f).columns), files)):
            if header:  # an empty file has neither a header nor rows
                found.setdefault(header, []).append(file)
    return found or {(): files}


def _rejection(fields: Sequence[StructField], line: str) -> Column:
    """File, line and names of the columns whose value is there but does not parse."""
    text = F.col(f"`{line}`")
    raw = F.from_csv(text, ", ".join(f"v{i} STRING" for i in range(len(fields))))
    lost = [
        F.when(raw[f"v{i}"].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
        for i, f in enumerate(fields)
    ]
    columns = F.filter(F.array(*lost), lambda c: c.isNotNull())
    told = F.struct(F.col("_metadata.file_path").alias("file"), text.alias("line"), columns.alias("columns"))
    return F.when(text.isNotNull(), told)


def split_rejected(df: DataFrame, rejected: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose values all parse, without the column of :func:`read_csv` that tells of the
    others; and what it tells of them: (file, line, columns). ``columns`` names those whose
    value does not parse; it is empty where the line has too few values or too many.
    """
    column = F.col(f"`{rejected}`")
    lost = df.where(column.isNotNull()).select(column.alias("r")).select("r.*")
    return df.where(column.isNull()).drop(rejected), lost


def write_rejected(rejected: DataFrame, path: str) -> None:
    """Write what :func:`split_rejected` tells of rejected lines as CSV with a header; the names in
    ``columns`` are separated by commas. A folder that exists already raises."""
    told = rejected.withColumn("columns", F.array_join("columns", ","))
    told.write.option("header", True).csv(path)


def clean(df: DataFrame, names: Mapping[str, str] = CLEAN_NAMES) -> DataFrame:
    """Rename exported columns; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def read_tables(
    spark: SparkSession, directory: str, names: Sequence[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Read ``<directory>/<name>.<fmt>`` for each name; ``fmt`` is parquet or csv."""
    tables = {}
    for name in names:
        path = f"{directory}/{name}.{fmt}"
        tables[name] = read_csv(spark, path) if fmt == "csv" else spark.read.parquet(path)
    return tables


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    """Publish each table as a session view under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """The tables and views of the current database whose names match the pattern."""
    return spark.sql(f"SHOW TABLES LIKE '{pattern}'")


def publish(
    df: DataFrame,
    name: str = "local_price_competitive_by_sku",
    persistent: bool = False,
    overwrite: bool = False,
    keys: Sequence[str] = (),
    buckets: int = 0,
) -> DataFrame:
    """Register a result by name: as a session view, or as a table that outlives it.

    A session view replaces one of that name. A table that exists already raises unless
    ``overwrite`` is given. ``buckets`` stores a table in so many files by a hash of ``keys``,
    each sorted by them: joins and groupings on all of the keys then need no shuffle.
    """
    if buckets and not persistent:
        raise ValueError("only a persistent table has buckets")
    if persistent:
        writer = df.write.mode("overwrite" if overwrite else "error")
        if buckets:
            # dealt by the same hash first, so that a bucket is one file
            writer = df.repartition(buckets, *keys).write.mode("overwrite" if overwrite else "error")
            writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
