"""What a SQL database has to do around Spark's parallel inserts: look up a table, and one closing transaction."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

COMMITS = "stagewise_commits"


@contextmanager
def _connection(spark: SparkSession, url: str, properties: dict[str, str]) -> Iterator:
    jvm = spark._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    given = jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        yield conn
    finally:
        conn.close()


def _exists(conn, name: str) -> bool:
    meta = conn.getMetaData()
    upper, lower = meta.storesUpperCaseIdentifiers(), meta.storesLowerCaseIdentifiers()
    stored = name.upper() if upper else name.lower() if lower else name
    found = meta.getTables(conn.getCatalog(), None, stored, None)  # "_" in it stands for any character
    try:
        while found.next():
            if found.getString("TABLE_NAME") == stored:
                return True
        return False
    finally:
        found.close()


def table_exists(spark: SparkSession, url: str, name: str, properties: dict[str, str]) -> bool:
    """Whether the database has the table; a database that refuses or can't be reached raises."""
    with _connection(spark, url, properties) as conn:
        return _exists(conn, name)


def _committed(conn, commit_id: str) -> bool:
    query = conn.prepareStatement(f"SELECT commit_id FROM {COMMITS} WHERE commit_id = ?")
    query.setString(1, commit_id)
    try:
        return bool(query.executeQuery().next())
    finally:
        query.close()


def committed(spark: SparkSession, url: str, commit_id: str, properties: dict[str, str]) -> bool:
    with _connection(spark, url, properties) as conn:
        return _exists(conn, COMMITS) and _committed(conn, commit_id)


def _run(conn, statement: str, *values: str) -> None:
    query = conn.prepareStatement(statement)
    try:
        for k, v in enumerate(values, 1):
            query.setString(k, v)
        query.executeUpdate()
    finally:
        query.close()


def take_over(
    spark: SparkSession, url: str, staging: str, name: str, columns: list[str], mode: str, commit_id: str | None,
    properties: dict[str, str],
) -> None:
    """Move the staged rows into the table in one transaction, then drop the staging table."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    listed = ", ".join(dialect.quoteIdentifier(c) for c in columns)
    with _connection(spark, url, properties) as conn:
        if commit_id is not None and not _exists(conn, COMMITS):
            _run(conn, f"CREATE TABLE {COMMITS} (commit_id VARCHAR(200) NOT NULL PRIMARY KEY)")
        conn.setAutoCommit(False)
        try:
            if commit_id is not None:
                _run(conn, f"INSERT INTO {COMMITS} (commit_id) VALUES (?)", commit_id)  # a second run fails here
            if mode == "replace":
                _run(conn, f"DELETE FROM {name}")
            _run(conn, f"INSERT INTO {name} ({listed}) SELECT {listed} FROM {staging}")
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        conn.setAutoCommit(True)
        _run(conn, f"DROP TABLE {staging}")
