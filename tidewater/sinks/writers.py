"""File, message and document sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False,
                    mode: str = "overwrite") -> None:
    """Delimited text with a chosen field separator (one file per task;
    ``header`` writes the column names into every file)."""
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def write_delimited_once(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited text whose folder, read as lines, has one header line: the
    column names are a file of their own, the rows follow without."""
    names = df.sparkSession.createDataFrame([tuple(df.columns)], ", ".join(f"`{c}` string" for c in df.columns))
    names.coalesce(1).write.mode("overwrite").option("sep", sep).csv(path)
    df.write.mode("append").option("sep", sep).csv(path)


def insert_into(df: DataFrame, table_name: str, overwrite: bool = False) -> None:
    """Append (or overwrite) a query result into a declared table."""
    df.write.insertInto(table_name, overwrite=overwrite)


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Append rows to a JDBC table (executors write their partitions)."""
    df.write.mode("append").jdbc(url, table, properties=dict(properties or {}))


def stream_to_jdbc(stream: DataFrame, url: str, table: str, checkpoint: str,
                   properties: dict | None = None, trigger: dict | None = None):
    """Streaming ``INSERT INTO jdbc_table SELECT ...`` that is safe to replay:
    see :func:`append_batch_once`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch_once(batch, batch_id, url, table, properties)

    w = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def append_batch_once(batch: DataFrame, batch_id: int, url: str, table: str, properties: dict | None = None) -> None:
    """Append a micro-batch to a JDBC table exactly once.  Executors write it
    to a staging table; one transaction then moves it over and notes the
    batch number in ``<table>_BATCHES``.  A batch that is noted already is
    passed over."""
    from tidewater.sinks.upsert import jdbc_connection
    spark, props = batch.sparkSession, dict(properties or {})
    with jdbc_connection(spark, url, props) as conn:
        found = conn.getMetaData().getTables(None, None, f"{table}_BATCHES".upper(), None)
        if not found.next():
            conn.createStatement().execute(f"CREATE TABLE {table}_BATCHES (BATCH_ID BIGINT PRIMARY KEY)")
        done = conn.createStatement().executeQuery(f"SELECT 1 FROM {table}_BATCHES WHERE BATCH_ID = {int(batch_id)}")
        if done.next():
            return
    names = batch.columns
    strings = [c for c, t in batch.dtypes if t == "string"]
    w = batch.write.mode("overwrite")
    if strings:
        w = w.option("createTableColumnTypes", ", ".join(f"{c} VARCHAR(1024)" for c in strings))
    w.jdbc(url, f"{table}_STAGE", properties=props)
    cols, quoted = ", ".join(names), ", ".join(f'"{c}"' for c in names)
    with jdbc_connection(spark, url, props) as conn:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        st.execute(f"INSERT INTO {table} ({cols}) SELECT {quoted} FROM {table}_STAGE")
        st.execute(f"INSERT INTO {table}_BATCHES VALUES ({int(batch_id)})")
        conn.commit()


def write_noop(df: DataFrame) -> None:
    """Discarding sink: runs the whole plan, keeps nothing."""
    df.write.format("noop").mode("overwrite").save()


def record_string(name: str, cols: list[str]) -> Column:
    """Record ``toString`` form ``Name(f1,f2,...)``: the payload a string
    producer sends for a typed record."""
    body = F.concat_ws(",", *[F.col(c).cast("string") for c in cols])
    return F.concat(F.lit(f"{name}("), body, F.lit(")"))


def csv_value(cols: list[str], sep: str = ",") -> Column:
    """CSV table sink payload: the row as one CSV line."""
    return F.to_csv(F.struct(*[F.col(c) for c in cols]), {"sep": sep})


def document_json(fields: dict[str, str]) -> Column:
    """JSON document with every value as a string: ``{out_name: column}``."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(k) for k, c in fields.items()]))


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, fmt: str = "kafka",
                options: dict | None = None, trigger: dict | None = None):
    """Streaming message sink of a ``value`` column."""
    w = (df.writeStream.format(fmt)
         .option("kafka.bootstrap.servers", servers)
         .option("topic", topic)
         .options(**(options or {}))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()
