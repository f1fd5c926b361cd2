"""Customer dimension from an operational database over JDBC.

The read is split into ``num_partitions`` range queries on a numeric column so
that a large table is pulled by many tasks in parallel rather than by one.
Needs the database's JDBC driver jar on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _props(user, password, driver, fetch_size) -> dict:
    props = {"fetchsize": str(fetch_size)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver:
        props["driver"] = driver
    return props


def column_bounds(spark: SparkSession, url: str, table: str, column: str, props: dict) -> tuple:
    """``min`` and ``max`` of ``column``, computed by the database (one row)."""
    query = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(url, query, properties=props).first()
    return row["lo"], row["hi"]


def depth_bounds(spark: SparkSession, url: str, table: str, column: str, parts: int, props: dict) -> list:
    """Upper bounds of ``parts`` equal-depth slices of ``column``, computed by the database
    (at most ``parts`` rows); a value that fills several slices is one bound."""
    query = (f"(SELECT max(v) AS hi FROM (SELECT {column} AS v, ntile({parts}) OVER (ORDER BY {column}) AS part "
             f"FROM {table} WHERE {column} IS NOT NULL) slices GROUP BY part) bounds")
    return sorted({row["hi"] for row in spark.read.jdbc(url, query, properties=props).collect()})


def depth_predicates(column: str, bounds: list) -> list[str]:
    """One predicate for each slice; every row, those without a value too, satisfies exactly one."""
    if len(bounds) < 2:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    text = [str(b) if isinstance(b, (int, float)) else "'" + str(b).replace("'", "''") + "'" for b in bounds[:-1]]
    middle = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(text, text[1:])]
    return [f"{column} <= {text[0]} OR {column} IS NULL", *middle, f"{column} > {text[-1]}"]


def read_jdbc_table(spark: SparkSession, url: str, table: str, user: str | None = None,
                    password: str | None = None, partition_column: str | None = None,
                    lower_bound: int | None = None, upper_bound: int | None = None,
                    num_partitions: int = 8, fetch_size: int = 10_000,
                    driver: str | None = None, equal_depth: bool = False) -> DataFrame:
    """Read ``table``; with ``partition_column`` in ``num_partitions`` range
    queries.  Bounds left out are taken from the data (``column_bounds``).

    Ranges of equal width give unequal partitions where ids are skewed; with
    ``equal_depth`` the database's own quantiles bound ranges of equal row
    counts (of any ordered type), at the price of one sort of the column there."""
    props = _props(user, password, driver, fetch_size)
    if partition_column is not None and equal_depth:
        bounds = depth_bounds(spark, url, table, partition_column, num_partitions, props)
        return spark.read.jdbc(url, table, predicates=depth_predicates(partition_column, bounds), properties=props)
    if partition_column is not None and (lower_bound is None or upper_bound is None):
        lo, hi = column_bounds(spark, url, table, partition_column, props)
        lower_bound = lo if lower_bound is None else lower_bound
        upper_bound = hi if upper_bound is None else upper_bound
        if lower_bound is None:              # empty table
            partition_column = None
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=props)
