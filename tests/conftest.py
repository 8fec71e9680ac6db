from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from doseline.session import configure  # noqa: E402
from doseline.sources.schemas import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("doseline-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def day(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


@pytest.fixture(scope="session")
def make(spark):
    """Build a declared table from rows; dates and stamps may be given as ISO text."""

    def build(table: str, *rows: dict | tuple):
        schema = TABLES[table]
        names = schema.fieldNames()
        kinds = {f.name: f.dataType.typeName() for f in schema.fields}

        def value(name, given):
            if isinstance(given, str) and kinds[name] == "date":
                return date.fromisoformat(given)
            if isinstance(given, str) and kinds[name] == "timestamp":
                return datetime.fromisoformat(given)
            if given is not None and kinds[name] == "decimal":
                from decimal import Decimal

                return Decimal(str(given))
            return given

        data = []
        for row in rows:
            given = row if isinstance(row, dict) else dict(zip(names, row, strict=True))
            data.append(tuple(value(n, given.get(n)) for n in names))
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture(scope="session")
def frame(spark):
    """A frame from a DDL schema and rows; dates may be given as ISO text."""

    def build(ddl: str, *rows: tuple):
        df = spark.createDataFrame([], ddl)
        kinds = [f.dataType.typeName() for f in df.schema.fields]
        data = [
            tuple(
                date.fromisoformat(v) if k == "date" and isinstance(v, str) else v
                for k, v in zip(kinds, row, strict=True)
            )
            for row in rows
        ]
        return spark.createDataFrame(data, df.schema)

    return build


def rows(df, *cols: str) -> list[tuple]:
    """Rows as sorted tuples, dates as ISO text."""

    def plain(v):
        return v.isoformat() if isinstance(v, date) else v

    out = [tuple(plain(v) for v in r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))
