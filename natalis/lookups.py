"""The three lookup tables of the algorithm."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.functions.classify import OUTCOMES

# Least days from a first outcome (row) to the next one (column).
MIN_DAYS = """
first  LB  SB  DELIV TRO ECT AB  SA
LB     182 168 168   70  70  70  70
SB     182 168 168   70  70  70  70
DELIV  182 168 168   70  70  70  70
TRO    168 154 154   730 56  56  365
ECT    168 154 154   365 56  56  56
AB     168 154 154   365 56  56  56
SA     168 154 154   365 56  56  56
"""

# Days of gestation allowed per outcome, and days to the next conception.
TERM_DURATIONS = """
category max_term min_term retry
LB       301      161      28
SB       301      100      28
DELIV    301      140      28
TRO      365      42       14
ECT      84       42       14
AB       168      42       14
SA       139      28       14
"""

# Assumed days of gestation per outcome.
GEST_EST = """
category preterm postterm fullterm nodata
LB       245     285      280      280
SB       196     285      280      196
DELIV    245     285      280      280
TRO      56      56       56       56
ECT      56      56       56       56
AB       70      70       70       70
SA       70      70       70       70
"""

LIMIT_SCHEMA = "outcome_limit_id int, first_preg_category string, outcome_preg_category string, min_days int"
TERM_SCHEMA = "category string, max_term int, min_term int, retry int"
EST_SCHEMA = "gest_est_id int, category string, preterm int, postterm int, fullterm int, nodata int"
CODE_SCHEMA = "concept_id int, category string, gest_value int, data_value string"
SCHEMAS = {"outcome_limit": LIMIT_SCHEMA, "term_durations": TERM_SCHEMA, "gest_est": EST_SCHEMA}

KEYS = {
    "outcome_limit": ("first_preg_category", "outcome_preg_category"),
    "term_durations": ("category",),
    "gest_est": ("category",),
}


def _grid(text: str) -> list[dict[str, str]]:
    header, *rows = [line.split() for line in text.strip().splitlines()]
    return [dict(zip(header, row)) for row in rows]


@dataclass(frozen=True)
class Lookups:
    """Spacing limits, term lengths and length estimates, keyed by category."""

    min_days: Mapping[tuple[str, str], int]
    max_term: Mapping[str, int]
    min_term: Mapping[str, int]
    retry: Mapping[str, int]
    preterm: Mapping[str, int]
    postterm: Mapping[str, int]
    fullterm: Mapping[str, int]
    nodata: Mapping[str, int]
    limit_ids: Mapping[tuple[str, str], int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # Evidence belongs to the next outcome after the start it stands for, which needs both.
        if any(days < 1 for days in self.min_term.values()) or any(days < 0 for days in self.retry.values()):
            raise ValueError("min_term must be at least 1 day and retry at least 0")

    @classmethod
    def fixed(cls) -> Lookups:
        """The tables as shipped."""
        limits = {(r["first"], o): int(r[o]) for r in _grid(MIN_DAYS) for o in OUTCOMES}
        # The shipped ids are 1 to 8 and 11 to 51.
        ids = {pair: i if i <= 8 else i + 2 for i, pair in enumerate(limits, 1)}
        return cls._of(limits, ids, _grid(TERM_DURATIONS), _grid(GEST_EST))

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str) -> Lookups:
        """Read edited tables: outcome_limit.csv, term_durations.csv and gest_est.csv."""
        return cls._read({name: read_csv(spark, folder, name, schema) for name, schema in SCHEMAS.items()})

    @classmethod
    def from_tables(cls, spark: SparkSession, schema: str) -> Lookups:
        """Read the tables stored in ``schema``."""
        return cls._read({name: spark.table(f"{schema}.{name}") for name in SCHEMAS})

    @classmethod
    def _read(cls, tables: Mapping[str, DataFrame]) -> Lookups:
        rows = {name: _small(table, name) for name, table in tables.items()}
        limits = {
            (r["first_preg_category"], r["outcome_preg_category"]): r["min_days"] for r in rows["outcome_limit"]
        }
        ids = {(r["first_preg_category"], r["outcome_preg_category"]): r["outcome_limit_id"] for r in rows["outcome_limit"]}
        return cls._of(limits, ids, rows["term_durations"], rows["gest_est"])

    @classmethod
    def _of(cls, limits: Mapping, ids: Mapping, terms: Iterable[Mapping], estimates: Iterable[Mapping]) -> Lookups:
        def column(rows: Iterable[Mapping], name: str) -> dict[str, int]:
            return {r["category"]: int(r[name]) for r in rows}

        return cls(
            dict(limits),
            *(column(terms, name) for name in ("max_term", "min_term", "retry")),
            *(column(estimates, name) for name in ("preterm", "postterm", "fullterm", "nodata")),
            dict(ids),
        )

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The lookups as DataFrames, under their table names."""
        limits = [(self.limit_ids.get((a, b), i), a, b, d) for i, ((a, b), d) in enumerate(self.min_days.items(), 1)]
        terms = [(c, self.max_term[c], self.min_term[c], self.retry[c]) for c in self.max_term]
        estimates = [
            (i, c, self.preterm[c], self.postterm[c], self.fullterm[c], self.nodata[c])
            for i, c in enumerate(self.preterm, 1)
        ]
        rows = {"outcome_limit": limits, "term_durations": terms, "gest_est": estimates}
        return {name: values(spark, rows[name], schema) for name, schema in SCHEMAS.items()}


def read_csv(spark: SparkSession, folder: str, name: str, schema: str | None) -> DataFrame:
    """One headed CSV file of ``folder``, with the given schema or with types found in the file."""
    path = f"{folder.rstrip('/')}/{PurePath(name).name}.csv"
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def values(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few literal rows as a relation of known size."""

    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    fields = [field.split() for field in schema.split(",")]
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(name for name, _ in fields)})")
    return table.selectExpr(*(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields))


def _small(table: DataFrame, name: str) -> list[dict]:
    """Rows of a lookup for the known categories, which become literals of the plan; a key must not repeat."""
    keys = KEYS[name]
    known = reduce(and_, (F.col(key).isin(*OUTCOMES) for key in keys))
    rows = table.where(known)
    if rows.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"{name} has a repeated {' and '.join(keys)}")
    return [row.asDict() for row in rows.collect()]
