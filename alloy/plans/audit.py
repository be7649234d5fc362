"""Stage audit log: buffered events written once per stage as one append.

The original opens a database connection per event; here events are kept in
a bounded driver list (a handful per stage) and flushed as a single
DataFrame append to any Spark sink (parquet by default, JDBC on a cluster).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

AUDIT_SCHEMA = StructType(
    [
        StructField("ts", TimestampType(), False),
        StructField("level", StringType(), False),
        StructField("source", StringType(), False),
        StructField("message", StringType(), False),
    ]
)


def _missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND"


class AuditLog:
    def __init__(
        self,
        spark: SparkSession,
        path: str | None = None,
        fmt: str = "parquet",
        options: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = spark
        self.path = path
        self.fmt = fmt
        self.options = dict(options or {})
        self._rows: list[tuple] = []

    def ensure(self) -> None:
        """Create the log table if it is absent (append of an empty frame
        with the non-null schema; through JDBC this creates NOT NULL columns)."""
        if self.path is None and not self.options:
            return
        if self.path is not None:
            try:  # an existing table is left alone (a listing, no write)
                self.spark.read.schema(AUDIT_SCHEMA).format(self.fmt).options(**self.options).load(self.path)
                return
            except AnalysisException as e:
                if not _missing(e):
                    raise
        empty = self.spark.createDataFrame([], AUDIT_SCHEMA).coalesce(1)
        writer = empty.write.format(self.fmt).options(**self.options).mode("append")
        writer.save(self.path) if self.path is not None else writer.save()

    def add(self, level: str, source: str, message: str) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._rows.append((now, str(level), str(source), str(message)))

    def info(self, source: str, message: str) -> None:
        self.add("INFO", source, message)

    def error(self, source: str, message: str) -> None:
        self.add("ERROR", source, message)

    def pending(self) -> DataFrame:
        return self.spark.createDataFrame(list(self._rows), AUDIT_SCHEMA)

    def flush(self) -> int:
        """Append buffered events to the sink in one write; they stay buffered if it fails."""
        n = len(self._rows)
        if n:
            if self.path is None and not self.options:
                raise ValueError("the audit log has neither a path nor options to write to")
            writer = self.pending().coalesce(1).write.format(self.fmt).options(**self.options).mode("append")
            writer.save(self.path) if self.path is not None else writer.save()
        self._rows.clear()
        return n

    def read(self) -> DataFrame:
        reader = self.spark.read.schema(AUDIT_SCHEMA).format(self.fmt).options(**self.options)
        return reader.load(self.path) if self.path is not None else reader.load()
