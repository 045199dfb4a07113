"""JDBC sinks: full overwrite, and an upsert through a staging table and one statement of the database."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame


def _keyed(df: DataFrame, keys: list[str]):
    """A writer that gives string keys a type that databases can compare."""
    kinds = dict(df.dtypes)
    short = ", ".join(f"{k} VARCHAR(256)" for k in keys if kinds[k] == "string")
    return df.write.option("createTableColumnTypes", short) if short else df.write


def overwrite(df: DataFrame, url: str, table: str, properties: dict[str, str], keys: list[str] | None = None, connections: int = 2) -> None:
    _keyed(df.coalesce(connections), keys or []).jdbc(url, table, mode="overwrite", properties=properties | {"truncate": "true"})


def upsert_statement(dialect: str, table: str, stage: str, columns: list[str], keys: list[str]) -> str:
    rest = [c for c in columns if c not in keys]
    quoted = ", ".join(f'"{c}"' for c in columns)
    if dialect == "postgresql":
        action = "DO UPDATE SET " + ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in rest) if rest else "DO NOTHING"
        return f"INSERT INTO {table} ({quoted}) SELECT {quoted} FROM {stage} ON CONFLICT ({', '.join(f'"{k}"' for k in keys)}) {action}"
    on = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    update = " WHEN MATCHED THEN UPDATE SET " + ", ".join(f'"{c}" = s."{c}"' for c in rest) if rest else ""
    values = ", ".join(f's."{c}"' for c in columns)
    return f"MERGE INTO {table} t USING {stage} s ON {on}{update} WHEN NOT MATCHED THEN INSERT ({quoted}) VALUES ({values})"


def staged_upsert(
    df: DataFrame, url: str, table: str, keys: list[str], properties: dict[str, str], connections: int = 4, epoch: tuple[str, int] | None = None, epochs: str = "drayage_epochs"
) -> bool:
    """Executors write a staging table of this run's own; the database merges it in one transaction, which is undone if it fails.

    epoch: (stream, number) is kept in the table `epochs` within that transaction, so a number that is there already, or less,
    changes nothing: a replayed batch, or a second writer of the same one, which waits for the first. Returns whether rows were
    merged.
    """
    spark, stage = df.sparkSession, f"{table}_stage_{uuid.uuid4().hex[:12]}"
    jvm = spark._jvm
    jvm.java.lang.Class.forName(properties["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    con = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        if epoch:
            _have_epochs(con, epochs)
            if _kept(con, epochs, epoch[0]) >= epoch[1]:
                return False
        _keyed(df.coalesce(connections), keys).jdbc(url, stage, mode="overwrite", properties=properties)
        con.setAutoCommit(False)
        try:
            due = not epoch or _take(con, epochs, *epoch)
            if due:
                con.createStatement().executeUpdate(upsert_statement(url.split(":")[1], table, stage, df.columns, keys))
            con.commit()
        except Exception:
            con.rollback()
            raise
        finally:
            con.setAutoCommit(True)
            con.createStatement().executeUpdate(f"DROP TABLE {stage}")
        return due
    finally:
        con.close()


def _have_epochs(con, epochs: str) -> None:
    """The table of epochs; another writer may make it at the same time."""
    found = con.getMetaData().getTables(None, None, None, None)
    while found.next():
        if found.getString("TABLE_NAME").lower() == epochs.lower():
            return
    try:
        con.createStatement().executeUpdate(f"CREATE TABLE {epochs} (stream VARCHAR(256) NOT NULL PRIMARY KEY, epoch BIGINT NOT NULL)")
    except Py4JJavaError:
        con.createStatement().executeQuery(f"SELECT epoch FROM {epochs}")


def _statement(con, text: str, *values: str | int):
    out = con.prepareStatement(text)
    for n, v in enumerate(values, 1):
        (out.setString if isinstance(v, str) else out.setLong)(n, v)
    return out


def _kept(con, epochs: str, stream: str) -> int:
    """The newest epoch of a stream; -1 where there is none, and the row that writers lock is made."""
    found = _statement(con, f"SELECT epoch FROM {epochs} WHERE stream = ?", stream).executeQuery()
    if found.next():
        return found.getLong(1)
    try:
        _statement(con, f"INSERT INTO {epochs} VALUES (?, ?)", stream, -1).executeUpdate()
    except Py4JJavaError:  # another writer was first
        return _kept(con, epochs, stream)
    return -1


def _take(con, epochs: str, stream: str, number: int) -> bool:
    """Advance a stream to an epoch within a transaction: the row stays locked until it ends."""
    return _statement(con, f"UPDATE {epochs} SET epoch = ? WHERE stream = ? AND epoch < ?", number, stream, number).executeUpdate() == 1
