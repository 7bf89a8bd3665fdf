"""Derived inputs written once in SQL both engines read, and the query registry."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_DAY = "replace(cast(cast({0} as date) as string), '-', '')"
_CLOCK = ("hour({0}) * 10000000L + minute({0}) * 100000L + "
          "cast(floor(extract(second from {0}) * 1000) as bigint)")

# The few places where the two dialects differ: <<NAME arg ; arg>>.
_DIALECT = {
    "spark": {
        "ADDSEC": "({0} + interval '1' second * {1})",
        "ISODOW": "(weekday({0}) + 1)",
        "CLOCK": f"({_CLOCK})",
        "TS17": f"concat({_DAY}, lpad(cast({_CLOCK} as string), 9, '0'))",
        "TS14": f"concat({_DAY}, substring(lpad(cast({_CLOCK} as string), 9, '0'), 1, 6))",
        "DAY8": _DAY,
    },
    "duckdb": {
        "ADDSEC": "({0} + to_seconds({1}))",
        "ISODOW": "isodow({0})",
        "CLOCK": "(hour({0}) * 10000000 + minute({0}) * 100000 + millisecond({0}))",
        "TS17": "strftime({0}, '%Y%m%d%H%M%S%g')",
        "TS14": "strftime({0}, '%Y%m%d%H%M%S')",
        "DAY8": "strftime({0}, '%Y%m%d')",
    },
}

INPUTS: dict[str, str] = {}


def dialect(sql: str, engine: str) -> str:
    def put(m: re.Match) -> str:
        return _DIALECT[engine][m.group(1)].format(*[a.strip() for a in m.group(2).split(";")])

    return re.sub(r"<<(\w+) (.+?)>>", put, sql, flags=re.S)


def _references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Driver tables and derived inputs of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in BASE:
                df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                sql = dialect(INPUTS[name], "spark")
                df = self.spark.sql(sql, **{r: self[r] for r in _references(sql)})
            self._made[name] = df
        return self._made[name]

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._made[name] = df

    def get(self, name: str, default=None):
        return self._made.get(name, default)

    def __contains__(self, name: str) -> bool:
        return name in self._made


def oracle(sql: str, extra: dict[str, str] | None = None) -> str:
    """Plain SQL with every derived input it names as a WITH entry."""
    known = {**INPUTS, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _references(text):
            if name not in BASE and name not in ordered:
                visit(known[name])
                ordered.append(name)

    visit(sql)
    plain = [(n, re.sub(r"\{(\w+)\}", r"\1", known[n])) for n in ordered]
    head = ",\n".join(f"{n} AS (\n{text}\n)" for n, text in plain)
    body = re.sub(r"\{(\w+)\}", r"\1", sql)
    return dialect(f"WITH {head}\n{body}" if head else body, "duckdb")


_TYPES = {"s": ("string", "varchar"), "i": ("bigint", "bigint"), "d": ("double", "double")}


@dataclass(frozen=True)
class Query:
    name: str
    columns: dict[str, str]
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.run(Tables(spark, folder))
        return df.select(*[
            F.col(c).cast(_TYPES[t][0]).alias(c) for c, t in self.columns.items()
        ])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        typed = ", ".join(f"cast({c} AS {_TYPES[t][1]}) AS {c}" for c, t in self.columns.items())
        return f"SELECT {typed} FROM (\n{self.sql}\n) AS _result"


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None, extra: dict[str, str] | None = None):
    """Registers ``fn(tables) -> DataFrame``. ``columns`` lists the result as
    'name:type ...' (s text, i whole number, d double); both sides are cast to it."""
    spec = dict(c.split(":") for c in columns.split())

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = Query(name, spec, fn, None if sql is None else oracle(sql, extra))
        return fn

    return add
