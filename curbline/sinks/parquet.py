"""Writing Parquet tables: whole, by partition, and by key."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.contracts import DATE_KEY
from curbline.operators.enrich import one_row_per_key
from curbline.session import freeze
from curbline.sources.files import list_files, partition_files, path_exists


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


STAGING = "_staging"
READY = "_READY"


def replace_partitions(
    df: DataFrame, path: str, key: str = DATE_KEY, affected: list | None = None, gathered: bool = False
) -> None:
    """Replace the partitions that ``df`` has rows for; the others keep their files.

    The new partitions are written whole beside the old ones and then put in their place, so ``df`` may
    read the table it replaces, and what a lost driver left half done is finished by ``recover``. Partitions listed
    in ``affected`` that got no rows are removed. The rebalance gathers each date into few files, joins
    small dates in one task and splits a date too large for one; rows that are ``gathered`` already
    stay where they are. A table has one writer at a time.
    """
    spark = df.sparkSession
    recover(spark, path)
    staged = f"{path}/{STAGING}/{uuid.uuid4().hex}"
    rows = df if gathered else df.hint("rebalance", F.col(key))
    rows.write.partitionBy(key).parquet(staged)
    file_system, staged_path = file_system_of(spark, staged)
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    if affected:
        # an empty folder in the staging area stands for a partition that goes
        for name in _folder_names(spark, path, affected, key):
            file_system.mkdirs(path_class(staged_path, name))
    file_system.create(path_class(staged_path, READY)).close()
    _put_in_place(spark, path, staged)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finish the replacements that were staged whole and not put in place; give up the others.

    Putting a folder in its place can be repeated at any point, so a driver may be lost here as well. Returns the
    names of the partitions that were put in place.
    """
    file_system, staging = file_system_of(spark, f"{path}/{STAGING}")
    if not file_system.exists(staging):
        return []
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    done = []
    for status in file_system.listStatus(staging):
        if file_system.exists(path_class(status.getPath(), READY)):
            done += _put_in_place(spark, path, status.getPath().toString())
        else:
            file_system.delete(status.getPath(), True)
    return done


def _put_in_place(spark: SparkSession, path: str, staged: str) -> list[str]:
    """Each staged partition folder in the place of the table's; one folder for each partition."""
    file_system, staged_path = file_system_of(spark, staged)
    # looked up once: each lookup asks the JVM
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in file_system.listStatus(staged_path) if "=" in s.getPath().getName()]
    for name in names:
        source, target = path_class(staged_path, name), path_class(f"{path}/{name}")
        file_system.delete(target, True)
        if not file_system.listStatus(source):
            file_system.delete(source, True)
        elif not file_system.rename(source, target):
            raise OSError(f"could not put {source} in place of {target}")
    file_system.delete(staged_path, True)
    staging = staged_path.getParent()
    if not file_system.listStatus(staging):
        file_system.delete(staging, True)
    return names


def file_system_of(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as an object of it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def _folder_names(spark: SparkSession, path: str, values: list, key: str) -> list[str]:
    listing = partition_files(list_files(spark, path), key).where(F.col(key).isin(list(values)))
    return [row["folder"].rsplit("/", 1)[1] for row in listing.select("folder").collect()]


def drop_partitions(spark: SparkSession, path: str, values: list, key: str = DATE_KEY) -> None:
    if not values:
        return
    listing = partition_files(list_files(spark, path), key).where(F.col(key).isin(list(values)))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for row in listing.select("folder").collect():
        folder = spark._jvm.org.apache.hadoop.fs.Path(row["folder"])
        folder.getFileSystem(conf).delete(folder, True)


def merge_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, and the target rows whose key the source lacks; NULL keys count as equal."""
    same = reduce(Column.__and__, [target[key].eqNullSafe(source[key]) for key in keys])
    return target.join(source, same, "left_anti").unionByName(source, allowMissingColumns=True)


def upsert(df: DataFrame, path: str, keys: list[str], partition: str | None = None) -> None:
    """Insert new keys, replace the row of known keys, keep the others.

    When one of the keys is the partition column, only the partitions the
    source has rows for are read and rewritten. Otherwise the merged table is
    written in full beside the old one and then takes its place. Any other
    partition column is refused: a key that moved would be in two partitions.
    """
    if partition and partition not in keys:
        raise ValueError(f"the partition column {partition} is not one of the keys {keys}")
    spark = df.sparkSession
    source = one_row_per_key(df, keys).select(*df.columns)
    if not path_exists(spark, path):
        if partition:
            replace_partitions(source, path, partition)
        else:
            overwrite(source, path)
        return
    target = spark.read.parquet(path)
    if partition:
        touched = target.join(source.select(partition).distinct(), partition, "left_semi")
        replace_partitions(merge_by_key(touched, source, keys), path, partition)
        return
    swap_in(merge_by_key(target, source, keys), path)


def upsert_buckets(df: DataFrame, path: str, keys: list[str], buckets: int, order: str | None = None) -> None:
    """Upsert into a table laid out in folders by a hash of the key: only the folders of the source's keys are rewritten.

    The folder column ``bucket_of_<buckets>`` is part of the table, which keeps its number of buckets; choose it so that a
    bucket is a few files. A key that the source has twice is refused, or with ``order`` its last row there is taken, ties by
    the row's hash. NULL keys count as equal. Running the same upsert again changes no row.
    """
    spark = df.sparkSession
    recover(spark, path)
    bucket = f"bucket_of_{buckets}"
    listed = list_files(spark, path)
    laid_out = [name for name in listed.columns if name.startswith("bucket_of_")]
    if not listed.isEmpty() and laid_out != [bucket]:
        raise ValueError(f"{path} is not laid out by {bucket}")
    columns = [F.col(f"`{name}`") for name in df.columns]
    target = spark.read.option("mergeSchema", True).parquet(path) if laid_out else None
    if target is not None:
        # a key has one bucket whatever type the source gives it
        types = {field.name: field.dataType for field in target.schema.fields}
        columns = [F.col(f"`{name}`").cast(types[name]).alias(name) if name in keys else F.col(f"`{name}`") for name in df.columns]
    source = df.select(*columns)
    named = [F.col(f"`{name}`") for name in keys]
    if order:
        row = [F.col(f"`{name}`") for name in df.columns]
        last = F.max_by(F.struct(*row), F.struct(F.col(f"`{order}`"), F.xxhash64(*row))).alias("row")
        source = source.groupBy(*named).agg(last).select("row.*")
    # the null fields of the key are left out of its text, so null keys share a bucket
    source = source.withColumn(bucket, F.pmod(F.xxhash64(F.to_json(F.struct(*named))), F.lit(buckets)).cast("int"))
    source = freeze(source)
    if not order:
        twice = source.groupBy(*named).count().where("count > 1").select(*named).first()
        if twice:
            raise ValueError(f"the source has a key more than once: {twice.asDict()}")
    if target is None:
        replace_partitions(source, path, bucket)
        return
    # no longer than the number of buckets
    touched = [row[bucket] for row in source.select(bucket).distinct().collect()]
    if touched:
        held = target.where(F.col(bucket).isin(touched))
        replace_partitions(merge_by_key(held, source, keys), path, bucket)


def swap_in(df: DataFrame, path: str) -> None:
    """Write beside the table, which ``df`` may read, and rename; both copies are whole until the end."""
    spark = df.sparkSession
    suffix = uuid.uuid4().hex
    overwrite(df, f"{path}_new_{suffix}")
    table, new, old = (
        spark._jvm.org.apache.hadoop.fs.Path(name) for name in (path, f"{path}_new_{suffix}", f"{path}_old_{suffix}")
    )
    file_system = table.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not (file_system.rename(table, old) and file_system.rename(new, table)):
        raise OSError(f"could not put {new} in place of {path}")
    file_system.delete(old, True)
