"""Warehouse tables in any database that has a JDBC driver on Spark's class path."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """A database. Credentials are given by the caller and have no defaults.

    ``num_partitions`` bounds the connections open at a time, ``batch_size`` the rows per round trip. ``truncate``
    keeps the table with its indexes and grants on an overwrite instead of dropping it.
    """

    url: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None
    num_partitions: int = 16
    batch_size: int = 10_000
    truncate: bool = False

    def options(self) -> dict[str, str]:
        options = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "numPartitions": str(self.num_partitions),
            "batchsize": str(self.batch_size),
            "truncate": str(self.truncate).lower(),
        }
        return options if self.driver is None else {**options, "driver": self.driver}


def write_jdbc(df: DataFrame, table: str, target: JdbcTarget) -> None:
    """Replace ``table`` by ``df``."""
    df.write.format("jdbc").options(**target.options()).option("dbtable", table).mode("overwrite").save()


def read_jdbc(spark: SparkSession, table: str, target: JdbcTarget) -> DataFrame:
    return spark.read.format("jdbc").options(**target.options()).option("dbtable", table).load()


def count_jdbc(spark: SparkSession, table: str, target: JdbcTarget) -> int:
    """How many rows ``table`` has; the database counts them."""
    query = f"SELECT COUNT(*) AS row_count FROM {table}"
    reader = spark.read.format("jdbc").options(**target.options()).option("query", query)
    return int(reader.load().first()[0])


def has_table(spark: SparkSession, table: str, target: JdbcTarget) -> bool:
    """Whether the database lists a table of this name, in the letters it was given or in upper case."""
    jvm = spark._jvm
    if target.driver:
        jvm.java.lang.Class.forName(target.driver)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, target.user, target.password)
    try:
        listed = connection.getMetaData()
        return any(listed.getTables(None, None, name, None).next() for name in (table, table.upper()))
    finally:
        connection.close()
