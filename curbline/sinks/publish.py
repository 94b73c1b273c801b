"""Publishing the layer tables to a sink, with a report that states what happened."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbline import contracts as C
from curbline.functions.exprs import nan_to_null
from curbline.sinks import parquet
from curbline.sources.files import list_files, path_exists


@dataclass(frozen=True)
class Publication:
    """A layer table, its name in the sink, and its key; without a key it is replaced."""

    source: str
    table: str
    keys: tuple[str, ...] = ()


# Keyed tables keep their history. The reports are replaced: a zone that left a
# top list must not stay in it.
PUBLICATIONS = (
    Publication(C.DAILY, "dws_daily_taxi", ("trip_date",)),
    Publication(C.HOURLY, "dws_hourly_taxi", ("pickup_hour",)),
    Publication(C.LOCATION, "dws_location_taxi", ("PULocationID",)),
    Publication(C.LOCATION_ZONE, "dws_location_zone", ("PULocationID",)),
    Publication(C.OVERALL, "ads_overall_metrics"),
    Publication(C.TOP_TRIPS, "ads_location_trip_top10"),
    Publication(C.TOP_REVENUE, "ads_location_revenue_top10"),
    Publication(C.TOP_AVG_REVENUE, "ads_location_avg_revenue_top10"),
    Publication(C.BOROUGH_TOP, "ads_borough_location_top3"),
    Publication(C.UNMATCHED, "ads_location_data_quality"),
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("target_rows", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)


class PublishError(RuntimeError):
    """Some tables were not published; ``report`` has one row for each."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__("not published: " + ", ".join(failed))
        self.report = report


class ParquetSink:
    """Published tables as Parquet folders under one root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def replace(self, df: DataFrame, table: str) -> None:
        parquet.overwrite(df, f"{self.root}/{table}")

    def upsert(self, df: DataFrame, table: str, keys: list[str]) -> None:
        parquet.upsert(df, f"{self.root}/{table}", keys)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{table}")


def publish_table(df: DataFrame, sink, publication: Publication) -> None:
    rows = nan_to_null(df)
    if publication.keys:
        sink.upsert(rows, publication.table, list(publication.keys))
    else:
        sink.replace(rows, publication.table)


def publish_report(
    spark: SparkSession, warehouse: str, sink, publications=PUBLICATIONS, fail: bool = True, at_once: int = 4
) -> DataFrame:
    """Publish the tables, several at once, going on after an error; raise at the end unless ``fail`` is off.

    A replaced table must end with as many rows as its source, an upserted one
    with at least as many. A table not yet built is skipped. The source's rows are those in the footers of its
    files: a count taken while writing would count a task twice that ran twice before a shuffle.
    """
    tables = [publication.table for publication in publications]
    if len(set(tables)) < len(tables):
        raise ValueError(f"a table is published twice: {tables}")

    def publish(publication: Publication) -> tuple:
        path = f"{warehouse}/{publication.source}"
        source_rows = target_rows = None
        try:
            if not path_exists(spark, path):
                return publication.table, "skipped", None, None, "no source"
            df = spark.read.parquet(path)
            source_rows = df.count()
            publish_table(df, sink, publication)
            target_rows = sink.read(spark, publication.table).count()
            agrees = target_rows >= source_rows if publication.keys else target_rows == source_rows
            status, message = ("ok", None) if agrees else ("rows differ", None)
        except Exception as error:
            status, message = "failed", (str(error).splitlines() or [type(error).__name__])[0]
        return publication.table, status, source_rows, target_rows, message

    with ThreadPoolExecutor(at_once) as pool:
        # each thread has the job group and other local properties of the caller
        entries = list(pool.map(inheritable_thread_target(spark)(publish), publications))
    report = spark.createDataFrame(entries, REPORT_SCHEMA)
    failed = [table for table, status, *_ in entries if status not in ("ok", "skipped")]
    if fail and failed:
        raise PublishError(report, failed)
    return report


def audit_outputs(spark: SparkSession, root: str, datasets: list[str]) -> DataFrame:
    """Whether each dataset holds at least one Parquet file; files are listed, not read."""
    audit = None
    for name in datasets:
        files = list_files(spark, f"{root}/{name}", recursive=True).selectExpr(
            f"'{name}' AS dataset", "length AS bytes"
        )
        audit = files if audit is None else audit.unionByName(files)
    wanted = spark.createDataFrame([(name,) for name in datasets], "dataset string")
    found = audit.groupBy("dataset").agg({"bytes": "sum", "dataset": "count"})
    return (
        wanted.join(found, "dataset", "left")
        .selectExpr(
            "dataset",
            "coalesce(`count(dataset)`, 0) AS files",
            "coalesce(`sum(bytes)`, 0) AS bytes",
            "coalesce(`count(dataset)`, 0) > 0 AS ok",
        )
        .orderBy("dataset")
    )
