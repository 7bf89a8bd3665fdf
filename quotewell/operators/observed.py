"""Row rules counted while their rows are published: no scan of their own.

The counts ride along with whatever job the rows go through next
(``DataFrame.observe``) and are there once it has run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quotewell.operators.rules import DAY, count_rows

ROWS = "rows"


class RuleWatch:
    """Counts ``rules`` (name -> condition) on the rows of ``df``, per day of
    ``days``, in the job that uses ``watched``.

    A job that repeats a stage after a lost executor may count its rows twice.
    The rows themselves are counted, too: ``counts`` compares them with the
    number of rows there really are and counts afresh where the two differ, so
    the report is right either way. Days are named beforehand (a daily job has
    one); a row of another day is an error then."""

    def __init__(self, df: DataFrame, rules: Mapping[str, Column], days: Sequence[date]):
        self.df, self.rules, self.days = df, dict(rules), list(days)
        self._seen = Observation()
        metrics = [F.count("*").alias(ROWS)]
        for n, day in enumerate(self.days):
            own = F.col(DAY) == F.lit(str(day)).cast("date")
            metrics.append(F.count_if(own).alias(f"{ROWS}_{n}"))
            metrics += [F.count_if(own & bad).alias(f"{m}_{n}") for m, bad in enumerate(self.rules.values())]
        self.watched = df.observe(self._seen, *metrics)

    def counts(self, rows: int | None = None) -> DataFrame:
        """(trade_date, rule, n), after a job over ``watched``. ``rows``: how many
        there are, where the caller knows (else they are counted; stored tables
        know it without a scan)."""
        seen, spark = self._seen.get, self.df.sparkSession
        if seen[ROWS] != (self.df.count() if rows is None else rows):
            return count_rows(self.df, self.rules)
        inside = sum(seen[f"{ROWS}_{n}"] for n in range(len(self.days)))
        if inside != seen[ROWS]:
            raise ValueError(f"{seen[ROWS] - inside} rows of days that were not named")
        found = [
            (day, rule, seen[f"{m}_{n}"]) for n, day in enumerate(self.days) if seen[f"{ROWS}_{n}"] for m, rule in enumerate(self.rules)
        ]
        return spark.createDataFrame(found, f"{DAY} date, rule string, n bigint")
