"""File listings, raw months, partitioned tables and the dimension file."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.contracts import DATE_KEY, MONTH_FILE_PATTERN, ZONE_CSV_SCHEMA
from curbline.operators.enrich import one_row_per_key

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, as file listings show it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return file_system.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return file_system.exists(hadoop_path)


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """One row per Parquet file, none read; ``key=value`` folders add their key as a typed column."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        return reader.load(path).drop("content")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)


def month_path_pattern(spark: SparkSession, raw_dir: str, pattern: str = MONTH_FILE_PATTERN) -> str:
    """What the path of a month file, or of a part file in a month folder, matches; groups: month path, year, month."""
    root = qualified(spark, raw_dir).rstrip("/")
    return rf"^(\Q{root}\E/{pattern})(/.*)?$"


def discover_files(spark: SparkSession, raw_dir: str, pattern: str = MONTH_FILE_PATTERN) -> DataFrame:
    """One row per file of a delivered month, other names ignored: year_month, month_path, path, modified and length.

    A month is one file, or a folder of part files with the same kind of name.
    """
    whole = month_path_pattern(spark, raw_dir, pattern)
    named = list_files(spark, raw_dir, recursive=True).where(F.col("path").rlike(whole))
    part = [F.regexp_extract("path", whole, group) for group in (1, 2, 3)]
    return named.select(
        F.concat_ws("-", part[1], part[2]).alias("year_month"),
        part[0].alias("month_path"),
        "path",
        F.col("modificationTime").alias("modified"),
        "length",
    )


def discover_months(spark: SparkSession, raw_dir: str, pattern: str = MONTH_FILE_PATTERN) -> DataFrame:
    """Months delivered under ``raw_dir`` in ascending order, other names ignored."""
    return (
        discover_files(spark, raw_dir, pattern)
        .groupBy("year_month", "month_path")
        .agg(F.sum("length").alias("bytes"), F.max("modified").alias("modified"))
        .orderBy("year_month")
    )


#: Parquet footers read at the same time to learn the layouts of raw files
FOOTERS_AT_ONCE = 16


def layouts(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The paths by the schema of their files."""
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(paths, schemas):
        alike.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(alike.values())


def read_raw(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType | None = None,
    delivered: str | None = None,
    found: list[tuple[T.StructType, list[str]]] | None = None,
) -> DataFrame:
    """Raw months as one frame; a column that some months lack is NULL in them.

    With a schema each month is cast to it, as types change from month to month
    in ways one Parquet scan cannot read; months alike are one scan. Columns it
    does not name are kept. ``delivered`` names a column to add: when the row's file was written.
    ``found`` has the layouts of the paths, if the caller has read them already. ``cast_losses`` counts what the
    casts lose.
    """

    def rows(*some: str, merge: bool = False) -> DataFrame:
        read = spark.read.option("mergeSchema", merge).parquet(*some)
        return read.withColumn(delivered, F.col("_metadata.file_modification_time")) if delivered else read

    if not schema:
        return rows(*paths, merge=True)
    months = [conform(rows(*same), schema) for _, same in found or layouts(spark, paths)]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), months)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema, cast or NULL, followed by any others.

    Names match whatever their case. A value its type cannot hold, such as a
    NaN count, becomes NULL instead of failing the whole load.
    """
    present = {name.lower() for name in df.columns}
    declared = [
        (F.col(f.name) if f.name.lower() in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    known = {name.lower() for name in schema.names}
    return df.select(*declared, *[name for name in df.columns if name.lower() not in known])


_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_lost(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a cast changes a value: what its type cannot hold, digits or times cut off; NULL and NaN are no values.

    Text is lost only where it is no value of the type at all, and a float may be the nearest one.
    """
    cast = value.try_cast(target)
    numbers = isinstance(source, T.NumericType) and isinstance(target, T.NumericType)
    times = isinstance(source, _TEMPORAL) and isinstance(target, _TEMPORAL)
    lost = cast.isNull()
    if times or numbers and not isinstance(target, T.FloatType):
        lost = lost | ~cast.try_cast(source).eqNullSafe(value)
    known = value.isNotNull()
    if isinstance(source, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(value)
    return known & lost


def cast_losses(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    pattern: str = MONTH_FILE_PATTERN,
    found: list[tuple[T.StructType, list[str]]] | None = None,
) -> DataFrame:
    """Per month and column that is cast to another type: its rows and the values that the cast loses.

    Only the columns of other types are read, and no file of which all types are the declared ones. The
    counts are those of an aggregate, so tasks that run twice count once.
    """
    declared = {field.name.lower(): field for field in schema.fields}
    counted = [spark.createDataFrame([], "year_month string, column string, rows long, lost long")]
    for layout, same in found or layouts(spark, paths):
        entries = []
        for field in layout.fields:
            wanted = declared.get(field.name.lower())
            if wanted and wanted.dataType != field.dataType:
                lost = F.count_if(is_lost(F.col(f"`{field.name}`"), field.dataType, wanted.dataType))
                entries.append(F.struct(F.lit(wanted.name).alias("column"), F.count("*").alias("rows"), lost.alias("lost")))
        if entries:
            path = F.col("_metadata.file_path")
            month = F.concat_ws("-", F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2))
            months = spark.read.parquet(*same).groupBy(F.when(path.rlike(pattern), month).alias("year_month"))
            counted.append(months.agg(F.array(*entries).alias("entries")).select("year_month", F.inline("entries")))
    rows = reduce(DataFrame.unionByName, counted)
    return rows.groupBy("year_month", "column").agg(F.sum("rows").alias("rows"), F.sum("lost").alias("lost"))


class CastLossError(ValueError):
    """Raw values that the declared types cannot hold."""


def refuse_losses(losses: DataFrame) -> None:
    """Raise with the months and columns in which values would be lost; a row a month and column at most is collected."""
    lost = losses.where(F.col("lost") > 0).orderBy("year_month", "column").collect()
    if lost:
        raise CastLossError("; ".join(f"{row['year_month']} {row['column']}: {row['lost']} of {row['rows']} rows" for row in lost))


def partition_files(files: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Per partition value of a file listing: folder, files, bytes, last change, first file name and version.

    The version is made of the names and lengths of the files. Writers name files anew, so it differs after every
    rewrite, whatever the clocks say, and is the same in a copy of the table.
    """
    if key not in files.columns:
        files = files.where(F.lit(False)).withColumn(key, F.lit(None).cast("date"))
    folder = F.regexp_extract("path", rf"^(.*/{key}=[^/]+)/", 1)
    name = F.element_at(F.split("path", "/"), -1)
    names = F.hex(F.bit_xor(F.xxhash64(name, "length")))
    return files.groupBy(key).agg(
        F.min(folder).alias("folder"),
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("modified"),
        F.min("path").alias("first_file"),
        F.concat_ws(":", F.count("*").cast("string"), names).alias("version"),
    )


def list_partitions(spark: SparkSession, path: str, key: str = DATE_KEY) -> DataFrame:
    return partition_files(list_files(spark, path), key).select(key)


def is_partitioned(files: DataFrame, key: str = DATE_KEY) -> bool:
    """False only for a listing of files that lie outside ``key=value`` folders."""
    return key in files.columns or files.isEmpty()


def read_partitions(spark: SparkSession, path: str, values: list, key: str = DATE_KEY) -> DataFrame:
    """Only the partitions of the given values; the others are pruned before the scan."""
    return spark.read.parquet(path).where(F.col(key).isin(list(values)))


def read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The given partition folders of a table, in the union of their columns.

    Nothing else of the table is listed, which counts when it has many files.
    """
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders)


def load_dimension(
    spark: SparkSession, path: str, schema: T.StructType = ZONE_CSV_SCHEMA, names: dict[str, str] | None = None, key: str = "LocationID"
) -> DataFrame:
    """CSV with a header and a declared schema, renamed, one row per key."""
    names = {"Location ID": "LocationID"} if names is None else names
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return one_row_per_key(rows.withColumnsRenamed(names), [key])
