"""Publishing to a database through Spark's JDBC writer.

The caller passes URL, user and password; nothing of the kind is kept here. Names are quoted and types are named by
Spark's dialect of the URL, so that columns may be called `rank` or `order`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Quote = Callable[[str], str]


def plain(name: str) -> str:
    return name


def column_types(df: DataFrame, keys: list[str], key_length: int = 255) -> str:
    """Types for the text columns of a key, which cannot be a CLOB; all others have the dialect's own types."""
    texts = [f.name for f in df.schema.fields if f.name in keys and isinstance(f.dataType, T.StringType)]
    return ", ".join(f"`{name.replace('`', '``')}` VARCHAR({key_length})" for name in texts)


def merge_statement(table: str, staging: str, columns: list[str], keys: list[str], quote: Quote = plain) -> str:
    """Standard MERGE of the staging table into the published one."""
    rest = [quote(name) for name in columns if name not in keys]
    on = " AND ".join(f"t.{quote(key)} = s.{quote(key)}" for key in keys)
    names = ", ".join(quote(name) for name in columns)
    values = ", ".join(f"s.{quote(name)}" for name in columns)
    # the standard allows no table name before the column that is set
    updated = ", ".join(f"{name} = s.{name}" for name in rest)
    matched = f" WHEN MATCHED THEN UPDATE SET {updated}" if rest else ""
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on}{matched}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def duplicate_key_statement(table: str, staging: str, columns: list[str], keys: list[str], quote: Quote = plain) -> str:
    """The same for databases without MERGE; the published table needs its primary key."""
    names = ", ".join(quote(name) for name in columns)
    rest = [quote(name) for name in columns if name not in keys] or [quote(name) for name in keys]
    updated = ", ".join(f"{name} = VALUES({name})" for name in rest)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {updated}"


def create_statement(df: DataFrame, url: str, table: str, keys: list[str]) -> str:
    """The published table with its primary key, in the types that Spark's dialect gives the columns."""
    jvm = df.sparkSession._jvm
    fields = [T.StructField(f.name, f.dataType, f.nullable and f.name not in keys) for f in df.schema.fields]
    schema = jvm.org.apache.spark.sql.types.DataType.fromJson(T.StructType(fields).json())
    texts = column_types(df, keys)
    wanted = jvm.scala.Option.apply(texts) if texts else jvm.scala.Option.empty()
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    utils = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils
    columns = utils.schemaString(dialect, schema, False, wanted)
    named = ", ".join(dialect.quoteIdentifier(key) for key in keys)
    return f"CREATE TABLE {table} ({columns}, PRIMARY KEY ({named}))"


@dataclass
class JdbcSink:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    upsert_statement: Callable[[str, str, list[str], list[str], Quote], str] = merge_statement
    batch_size: int = 10_000
    connections: int = 8

    def replace(self, df: DataFrame, table: str) -> None:
        """Empty the table, keeping its definition, and insert; an empty frame leaves it empty."""
        self.fill(df, table, [])

    def fill(self, df: DataFrame, table: str, keys: list[str]) -> None:
        writer = (
            df.write.mode("overwrite")
            .option("truncate", True)
            .option("numPartitions", self.connections)
            .option("batchsize", self.batch_size)
        )
        types = column_types(df, keys)
        if types:
            writer = writer.option("createTableColumnTypes", types)
        writer.jdbc(self.url, table, properties=self.properties)

    def upsert(self, df: DataFrame, table: str, keys: list[str]) -> None:
        """Executors fill a staging table; one statement in the database merges it into the published one.

        The published table is created with its primary key if it is not there. The staging table goes
        afterwards, and also when the merge fails; one that a lost driver left is emptied by the next upsert.
        """
        missing = [key for key in keys if key not in df.columns]
        if missing or not keys:
            raise ValueError(f"no key columns {missing or keys} in {df.columns}")
        dialect = df.sparkSession._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        staging = f"{table}_staging"
        self.fill(df, staging, keys)
        try:
            if not self.exists(df, table):
                self.execute(df, create_statement(df, self.url, table, keys))
            self.execute(df, self.upsert_statement(table, staging, df.columns, keys, dialect.quoteIdentifier))
        finally:
            self.execute(df, f"DROP TABLE {staging}")

    def exists(self, df: DataFrame, table: str) -> bool:
        """Whether the dialect's own test query for the table succeeds."""
        jvm = df.sparkSession._jvm
        query = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).getTableExistsQuery(table)
        connection = self.connect(df)
        try:
            connection.prepareStatement(query).executeQuery()
            return True
        except Exception as error:
            cause = getattr(error, "java_exception", None)
            if cause is None or not jvm.java.lang.Class.forName("java.sql.SQLException").isInstance(cause):
                raise
            return False
        finally:
            connection.close()

    def connect(self, df: DataFrame):
        jvm = df.sparkSession._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def execute(self, df: DataFrame, statement: str) -> None:
        connection = self.connect(df)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    def read(self, spark, table: str) -> DataFrame:
        return spark.read.jdbc(self.url, table, properties=self.properties)
