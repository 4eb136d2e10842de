"""The warehouse load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tillmark.operators import dimensions, fact
from tillmark.operators.flaws import flaws
from tillmark.sinks.jdbc import JdbcTarget, count_jdbc, write_jdbc
from tillmark.sinks.metrics import write_counted, write_measured

Write = Callable[[DataFrame, str], None]


def star_schema(transactions: DataFrame, products: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the star schema by name."""
    geography = dimensions.dim_geography(countries)
    return {
        "dim_date": dimensions.dim_date(transactions),
        "dim_customers": dimensions.dim_customers(transactions),
        "dim_products": dimensions.dim_products(products),
        "dim_geography": geography,
        "fct_sales": fact.fct_sales(transactions, products, geography),
    }


def load_warehouse(tables: dict[str, DataFrame], write: Write) -> dict[str, int]:
    """Write every table once with ``write(df, name)``; returns the rows written per table."""
    return {name: write_counted(df, lambda counted, name=name: write(counted, name)) for name, df in tables.items()}


def load_measured(tables: dict[str, DataFrame], write: Write) -> dict[str, dict[str, int]]:
    """Like ``load_warehouse``; returns the rows of each table and how many of them have which flaw."""
    return {
        name: write_measured(df, lambda measured, name=name: write(measured, name), flaws(name)) for name, df in tables.items()
    }


def load_jdbc_warehouse(tables: dict[str, DataFrame], target: JdbcTarget, attempts: int = 3) -> dict[str, int]:
    """Replace the tables of a database.

    Each table is spread over as many tasks as there may be connections by a shuffle of its own. Left to itself the
    JDBC writer would merge partitions instead, and with them the tasks of the join that computes the fact.

    Tasks commit to a database on their own: one that is lost between its commit and its report runs again and leaves
    its rows twice. So each table is counted there and, if the number is not that of the rows computed, written anew.
    """
    counts = {}
    for name, df in tables.items():
        spread = df.repartition(target.num_partitions)
        for _ in range(attempts):
            counts[name] = write_counted(spread, lambda counted, name=name: write_jdbc(counted, name, target))
            if count_jdbc(df.sparkSession, name, target) == counts[name]:
                break
        else:
            raise RuntimeError(f"{name} is not complete after {attempts} attempts")
    return counts
