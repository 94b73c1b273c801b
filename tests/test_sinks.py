import datetime as dt
import glob
import os
import threading

import pytest
from trips import rows_of

from curbline.sinks import jdbc, parquet, publish
from curbline.sources.files import list_files

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def dated(spark, rows):
    return spark.createDataFrame(rows, "trip_date date, n int")


def files_of(path, day):
    return sorted(glob.glob(f"{path}/trip_date={day}/*.parquet"))


def test_replace_partitions_leaves_the_others(spark, folder):
    path = f"{folder}/t"
    parquet.replace_partitions(dated(spark, [(D1, 1), (D2, 2)]), path)
    before = files_of(path, D1)
    parquet.replace_partitions(dated(spark, [(D2, 20), (D3, 30)]), path)
    assert files_of(path, D1) == before
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D1, 1), (D2, 20), (D3, 30)]


def test_affected_partition_without_rows_vanishes(spark, folder):
    path = f"{folder}/t"
    parquet.replace_partitions(dated(spark, [(D1, 1), (D2, 2), (D3, 3)]), path)
    parquet.replace_partitions(dated(spark, [(D2, 20)]), path, affected=[D2, D3])
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D1, 1), (D2, 20)]
    parquet.replace_partitions(dated(spark, []), path, affected=[D2])
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D1, 1)]


def test_table_may_be_read_while_it_is_replaced(spark, folder):
    path = f"{folder}/t"
    parquet.replace_partitions(dated(spark, [(D1, 1), (D2, 2)]), path)
    rows = spark.read.parquet(path).selectExpr("n + 1 AS n", "trip_date")
    parquet.replace_partitions(rows, path)
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D1, 2), (D2, 3)]


def test_hot_date_is_split_and_small_dates_are_not(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 120_000, 1, 8).selectExpr(
            "if(id % 3 = 0, date'2024-01-01', date_add(date'2024-01-02', int(id % 20))) AS trip_date", "id", "uuid() AS u"
        )
        parquet.replace_partitions(rows, f"{folder}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len(files_of(f"{folder}/t", D1)) > 3
    assert spark.read.parquet(f"{folder}/t").count() == 120_000


@pytest.mark.parametrize("partition", [None, "k"])
def test_upsert_keeps_updates_inserts(spark, folder, partition):
    schema = "k string, a int, b int"
    parquet.upsert(spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], schema), f"{folder}/t", ["k"], partition)
    source = spark.createDataFrame([("b", 20, None), ("c", 30, 3)], schema)
    for _ in range(2):
        parquet.upsert(source, f"{folder}/t", ["k"], partition)
        merged = spark.read.parquet(f"{folder}/t").select("k", "a", "b")
        assert rows_of(merged) == [("a", 1, 1), ("b", 20, None), ("c", 30, 3)]
    assert glob.glob(f"{folder}/*") == [f"{folder}/t"]


def test_upsert_of_null_key_is_repeatable(spark, folder):
    source = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    for _ in range(2):
        parquet.upsert(source, f"{folder}/t", ["k"])
    assert spark.read.parquet(f"{folder}/t").count() == 2


def test_upsert_refuses_a_partition_that_is_no_key(spark, folder):
    with pytest.raises(ValueError, match="not one of the keys"):
        parquet.upsert(dated(spark, [(D1, 1)]), f"{folder}/t", ["n"], "trip_date")


def test_replace_with_nothing_empties(spark, folder):
    sink = publish.ParquetSink(folder)
    rows = spark.createDataFrame([(1,)], "k int")
    sink.replace(rows, "t")
    sink.replace(rows.limit(0), "t")
    assert sink.read(spark, "t").count() == 0


class BrokenSink(publish.ParquetSink):
    def replace(self, df, table):
        if table == "bad":
            raise ValueError("no room")
        super().replace(df, table)


def test_publish_report_goes_on_and_fails_at_the_end(spark, folder):
    spark.createDataFrame([(1, float("nan"))], "k int, x double").write.parquet(f"{folder}/w/t")
    jobs = [
        publish.Publication("none", "skipped"),
        publish.Publication("t", "bad"),
        publish.Publication("t", "good"),
        publish.Publication("t", "keyed", ("k",)),
    ]
    sink = BrokenSink(f"{folder}/out")
    with pytest.raises(publish.PublishError, match="bad") as raised:
        publish.publish_report(spark, f"{folder}/w", sink, jobs)
    statuses = {row["table"]: row["status"] for row in raised.value.report.collect()}
    assert statuses == {"skipped": "skipped", "bad": "failed", "good": "ok", "keyed": "ok"}
    assert sink.read(spark, "good").first()["x"] is None
    report = publish.publish_report(spark, f"{folder}/w", sink, jobs, fail=False)
    assert report.count() == 4


def test_audit(spark, folder):
    spark.range(3).write.parquet(f"{folder}/dws/full")
    audit = publish.audit_outputs(spark, folder, ["dws/full", "ads/none"])
    assert rows_of(audit.select("dataset", "ok")) == [("ads/none", False), ("dws/full", True)]
    assert list_files(spark, f"{folder}/ads/none").count() == 0


def test_published_tables_have_their_keys():
    keys = {p.table: p.keys for p in publish.PUBLICATIONS}
    assert keys["dws_daily_taxi"] == ("trip_date",)
    assert keys["ads_location_trip_top10"] == ()
    assert len(keys) == 10


def test_merge_statements():
    assert jdbc.merge_statement("t", "s", ["k", "a"], ["k"]) == (
        "MERGE INTO t t USING s s ON t.k = s.k WHEN MATCHED THEN UPDATE SET a = s.a"
        " WHEN NOT MATCHED THEN INSERT (k, a) VALUES (s.k, s.a)"
    )
    assert jdbc.duplicate_key_statement("t", "s", ["k", "a"], ["k"]) == (
        "INSERT INTO t (k, a) SELECT k, a FROM s ON DUPLICATE KEY UPDATE a = VALUES(a)"
    )
    only_keys = jdbc.merge_statement("t", "s", ["k"], ["k"])
    assert only_keys == "MERGE INTO t t USING s s ON t.k = s.k WHEN NOT MATCHED THEN INSERT (k) VALUES (s.k)"


RANKS = ["rank", "row_number", "zone"]


def test_merge_statements_quote_names():
    quote = '"{}"'.format
    assert jdbc.merge_statement("t", "s", RANKS, ["zone"], quote) == (
        'MERGE INTO t t USING s s ON t."zone" = s."zone" WHEN MATCHED THEN UPDATE SET "rank" = s."rank", "row_number" = s."row_number"'
        ' WHEN NOT MATCHED THEN INSERT ("rank", "row_number", "zone") VALUES (s."rank", s."row_number", s."zone")'
    )
    assert jdbc.duplicate_key_statement("t", "s", RANKS, ["zone"], "`{}`".format) == (
        "INSERT INTO t (`rank`, `row_number`, `zone`) SELECT `rank`, `row_number`, `zone` FROM s"
        " ON DUPLICATE KEY UPDATE `rank` = VALUES(`rank`), `row_number` = VALUES(`row_number`)"
    )


def ranked(spark):
    return spark.sql("SELECT 1L AS rank, 'a' AS zone, 2.5D AS x, CAST(1 AS decimal(12,2)) AS d, 'long' AS note")


def test_only_texts_of_a_key_have_a_length(spark):
    assert jdbc.column_types(ranked(spark), ["zone"]) == "`zone` VARCHAR(255)"
    assert jdbc.column_types(ranked(spark), []) == ""


@pytest.mark.parametrize(
    "url, columns",
    [
        (
            "jdbc:mysql://host/db",
            "`rank` BIGINT NOT NULL, `zone` VARCHAR(255) NOT NULL, `x` DOUBLE PRECISION NOT NULL, `d` DECIMAL(12,2) NOT NULL,"
            " `note` LONGTEXT NOT NULL, PRIMARY KEY (`zone`)",
        ),
        (
            "jdbc:postgresql://host/db",
            '"rank" BIGINT NOT NULL, "zone" VARCHAR(255) NOT NULL, "x" FLOAT8 NOT NULL, "d" NUMERIC(12,2) NOT NULL,'
            ' "note" TEXT NOT NULL, PRIMARY KEY ("zone")',
        ),
    ],
)
def test_create_statement(spark, url, columns):
    assert jdbc.create_statement(ranked(spark), url, "t", ["zone"]) == f"CREATE TABLE t ({columns})"


def test_created_keys_are_never_null(spark):
    df = spark.createDataFrame([(1, 2)], "k int, n int")
    statement = jdbc.create_statement(df, "jdbc:mysql://host/db", "t", ["k"])
    assert statement == "CREATE TABLE t (`k` INTEGER NOT NULL, `n` INTEGER , PRIMARY KEY (`k`))"


class RecordingSink(jdbc.JdbcSink):
    """Keeps the statements instead of sending them."""

    def __init__(self, url):
        super().__init__(url)
        self.sent, self.tables, self.fails = [], set(), False

    def fill(self, df, table, keys):
        self.sent.append(f"fill {table}")

    def exists(self, df, table):
        return table in self.tables

    def execute(self, df, statement):
        self.sent.append(statement.split(" (")[0])
        if self.fails and statement.startswith("MERGE"):
            raise RuntimeError("no merge")


def test_upsert_creates_merges_and_drops_its_staging_table(spark):
    sink = RecordingSink("jdbc:postgresql://host/db")
    df = spark.createDataFrame([(1, 2)], "k int, rank int")
    sink.upsert(df, "t", ["k"])
    assert [text.split(" USING")[0] for text in sink.sent] == ["fill t_staging", "CREATE TABLE t", "MERGE INTO t t", "DROP TABLE t_staging"]
    assert 't."k" = s."k"' in sink.sent[2]
    sink.sent, sink.tables = [], {"t"}
    sink.upsert(df, "t", ["k"])
    assert [text.split()[0] for text in sink.sent] == ["fill", "MERGE", "DROP"]
    sink.sent, sink.fails = [], True
    with pytest.raises(RuntimeError, match="no merge"):
        sink.upsert(df, "t", ["k"])
    assert sink.sent[-1] == "DROP TABLE t_staging"
    for keys in ([], ["none"]):
        with pytest.raises(ValueError, match="no key columns"):
            sink.upsert(df, "t", keys)


def test_tables_are_published_at_once_and_each_only_once(spark, folder):
    spark.range(3).write.parquet(f"{folder}/w/t")
    barrier = threading.Barrier(3, timeout=60)

    class Waiting(publish.ParquetSink):
        def replace(self, df, table):
            barrier.wait()
            super().replace(df, table)

    jobs = [publish.Publication("t", name) for name in ("a", "b", "c")]
    report = publish.publish_report(spark, f"{folder}/w", Waiting(f"{folder}/out"), jobs)
    assert rows_of(report.select("table", "status", "target_rows")) == [("a", "ok", 3), ("b", "ok", 3), ("c", "ok", 3)]
    with pytest.raises(ValueError, match="twice"):
        publish.publish_report(spark, f"{folder}/w", Waiting(f"{folder}/out"), [jobs[0], jobs[0]])


def test_replacement_that_broke_off_is_finished(spark, folder, monkeypatch):
    """The driver dies after the old date was deleted and before the new one took its place."""
    path = f"{folder}/t"
    parquet.replace_partitions(dated(spark, [(D1, 1), (D2, 2), (D3, 3)]), path)
    put, names = parquet._put_in_place, []

    def dies(spark, path, staged):
        file_system, target = parquet.file_system_of(spark, f"{path}/trip_date={D1}")
        file_system.delete(target, True)
        names.append(staged)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(parquet, "_put_in_place", dies)
    with pytest.raises(RuntimeError):
        parquet.replace_partitions(dated(spark, [(D1, 10), (D2, 20)]), path, affected=[D3])
    monkeypatch.setattr(parquet, "_put_in_place", put)
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D2, 2), (D3, 3)]
    done = parquet.recover(spark, path)
    assert sorted(done) == [f"trip_date={day}" for day in (D1, D2, D3)]
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D1, 10), (D2, 20)]
    assert parquet.recover(spark, path) == []
    assert glob.glob(f"{path}/*") == [f"{path}/trip_date={D1}", f"{path}/trip_date={D2}"] or len(glob.glob(f"{path}/*")) == 2


def test_replacement_that_was_not_staged_whole_is_given_up(spark, folder):
    path = f"{folder}/t"
    parquet.replace_partitions(dated(spark, [(D1, 1)]), path)
    dated(spark, [(D1, 5)]).write.partitionBy("trip_date").parquet(f"{path}/_staging/x")
    parquet.replace_partitions(dated(spark, [(D2, 2)]), path)
    assert rows_of(spark.read.parquet(path).select("trip_date", "n")) == [(D1, 1), (D2, 2)]
    assert glob.glob(f"{path}/_staging*") == []


def test_bucketed_upsert_rewrites_only_touched_folders(spark, folder):
    path = f"{folder}/t"
    schema = "k long, v string"
    parquet.upsert_buckets(spark.createDataFrame([(i, "old") for i in range(200)] + [(None, "old")], schema), path, ["k"], 16)
    before = set(glob.glob(f"{path}/*/*.parquet"))
    assert len({os.path.dirname(name) for name in before}) == 16
    for _ in range(2):
        # another type of the key, and a new column
        parquet.upsert_buckets(spark.createDataFrame([(7, "new", 1)], "k int, v string, extra int"), path, ["k"], 16)
    after = set(glob.glob(f"{path}/*/*.parquet"))
    assert len({os.path.dirname(name) for name in before ^ after}) == 1
    parquet.upsert_buckets(spark.createDataFrame([(None, "new"), (500, "new")], schema), path, ["k"], 16)
    rows = spark.read.option("mergeSchema", True).parquet(path).select("k", "v", "extra").collect()
    assert len(rows) == 202
    assert {(r["k"], r["extra"]) for r in rows if r["v"] == "new"} == {(7, 1), (None, None), (500, None)}
    with pytest.raises(ValueError, match="not laid out"):
        parquet.upsert_buckets(spark.createDataFrame([(1, "x")], schema), path, ["k"], 8)


def test_bucketed_upsert_of_keys_that_repeat(spark, folder):
    path = f"{folder}/t"
    twice = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k long, v string, at int")
    with pytest.raises(ValueError, match="more than once"):
        parquet.upsert_buckets(twice, path, ["k"], 4)
    assert not os.path.exists(path)
    parquet.upsert_buckets(twice, path, ["k"], 4, order="at")
    assert rows_of(spark.read.parquet(path).select("k", "v")) == [(1, "b"), (2, "c")]
    parquet.upsert_buckets(twice.limit(0), path, ["k"], 4)
    assert spark.read.parquet(path).count() == 2
