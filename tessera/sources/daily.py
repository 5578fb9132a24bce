"""Daily loads into a table partitioned by date (SC7, SC15): a day is replaced, never doubled.

``load_days`` overwrites exactly the partitions that its rows lie in, so a rerun of a day replaces that day
and leaves the others alone. Columns that a later load brings are added to the table (null in earlier
days), columns that it lacks are null; a column whose type changed raises. Readers that join the table with a
filtered calendar get dynamic partition pruning: only the days that the calendar leaves are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.sinks import overwrite_partitions


def load_days(spark: SparkSession, rows: DataFrame, target: str, day: str, fmt: str = "parquet", path: str | None = None,
              files_a_day: int = 1) -> None:
    """Write ``rows`` into ``target``, partitioned by the date column ``day``. Rows are dealt to ``files_a_day``
    writers a day by a hash of the row, so a large day is written by many tasks."""
    if rows.filter(F.col(day).isNull()).limit(1).count():
        raise ValueError(f"rows without {day} have no partition")
    others = [c for c in rows.columns if c != day]
    dealt = rows.select(*others, day).repartition(F.col(day), F.pmod(F.xxhash64(*others), F.lit(files_a_day)))
    if not spark.catalog.tableExists(target):
        writer = dealt.write.format(fmt).partitionBy(day)
        (writer.option("path", path) if path else writer).saveAsTable(target)
        return
    stored = spark.table(target).schema
    known = {f.name: f.dataType for f in stored}
    for field in rows.schema:
        if field.name in known and known[field.name] != field.dataType:
            raise ValueError(f"{field.name} is {known[field.name].simpleString()} in {target}, not {field.dataType.simpleString()}")
    added = [f for f in rows.schema if f.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
        stored = spark.table(target).schema
    filled = dealt.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored))
    overwrite_partitions(filled, target)


def on_days(facts: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """The facts of the calendar's days. The calendar (a row a day, filtered by the caller) prunes the partitions
    of the facts while the query runs."""
    return facts.join(calendar, day)
