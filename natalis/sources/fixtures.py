"""Clinical tables laid over the driver's order tables, as set out in FIXTURES.md."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.lookups import CODE_SCHEMA, values
from natalis.operators.temporal import parts_for
from natalis.sources.cdm import CONDITION, DRUG, MEASUREMENT, NUMBER, OBSERVATION, PROCEDURE, Cdm, Ranges

# Categories of concepts 0 to 31, in order.
CONCEPT_CATEGORIES = (
    "LB LB DELIV DELIV SB AB AB SA SA ECT TRO AGP PCONF PCOMP TA ECT_SURG1 ECT_SURG2 LMP LMP "
    "GEST GEST GEST OVUL OVUL2 NULS AFP AMEN UP PREM POSTT FT DIAB"
).split()

# Drug code sets.
DRUG_CONCEPTS = {101: "CONTRA", 102: "MTX", 103: "OVULDR"}

# Domain of a fact by its last digit.
DOMAINS = {
    CONDITION: (0, 1, 2, 3),
    PROCEDURE: (4, 5),
    OBSERVATION: (6,),
    MEASUREMENT: (7,),
    DRUG: (8, 9),
}


# Columns read, with their types: naming them spares a look into the files per plan.
ORDERS = "o_orderkey bigint, o_custkey bigint"
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_shipdate timestamp_ntz"
)
CUSTOMER = "c_custkey bigint"


@dataclass(frozen=True)
class FactsCdm(Cdm):
    """Clinical tables that are all cut from one table of facts.

    Reading every record is then one scan of the facts rather than one per table. Their concepts are computed,
    so that no scan can skip by them: ranges of ids are not asked for.
    """

    facts: DataFrame
    lines: DataFrame

    skips_by_concept = False

    def clinical_records(self, listed: Ranges | None = None) -> DataFrame:
        return self._all().filter(F.col("type") != DRUG)

    def all_records(self, listed: Ranges | None = None, listed_drugs: Ranges | None = None) -> DataFrame:
        return self._all()

    def record_count(self, coded: DataFrame) -> int:
        """As many as there are line items, a number that the files state."""
        return self.lines.count()

    def _all(self) -> DataFrame:
        kind = F.lit(None)
        for name, digits in DOMAINS.items():
            kind = F.when(F.col("dom").isin(*digits), name).otherwise(kind)
        valued = F.col("type").isin(OBSERVATION, MEASUREMENT)
        return self.facts.withColumn("type", kind).select(
            "person_id",
            F.when(F.col("type") == DRUG, F.col("drug_concept_id"))
            .otherwise(F.col("concept_id"))
            .alias("concept_id"),
            F.col("d").alias("start_date"),
            "type",
            F.when(valued, F.col("flag")).otherwise(F.lit(" ")).alias("value_as_string"),
            F.when(valued, F.col("number")).cast(NUMBER).alias("value_as_number"),
        )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coded record per line item."""
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person_id")
    )
    lines = line_items(spark, sf_dir)
    parts = parts_for(spark, lines.count())
    if parts > spark.sparkContext.defaultParallelism:
        # as many partitions as keep the sorts of the join small
        lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "l_orderkey")
    quantity = F.col("l_quantity").cast("int")
    return lines.join(orders, "l_orderkey").select(
        "person_id",
        F.col("l_shipdate").cast("date").alias("d"),
        F.when(F.col("person_id") % 50 == 7, F.lit(31))
        .otherwise((F.col("l_partkey") % 40).cast("int"))
        .alias("concept_id"),
        (1000 + F.col("l_partkey") % 40).cast("int").alias("drug_concept_id"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 10).cast("int").alias("dom"),
        F.col("l_returnflag").alias("flag"),
        F.when(quantity % 3 == 0, quantity + quantity % 2 * F.lit("0.1").cast("decimal(2,1)")).alias("number"),
    )


def concepts(spark: SparkSession) -> DataFrame:
    kind = F.when(F.col("id") == 1040, "Dose Form").when(F.col("id") % 2 == 0, "Ingredient")
    return spark.range(1000, 1041).select(
        F.col("id").cast("int").alias("concept_id"),
        F.concat(F.lit("drug "), F.col("id").cast("string")).alias("concept_name"),
        kind.otherwise("Clinical Drug").alias("concept_class_id"),
    )


def concept_ancestors(spark: SparkSession) -> DataFrame:
    x = F.col("id")
    above = F.filter(
        F.array(
            F.when(x % 4 == 0, 101),
            F.when(x % 4 == 1, 102),
            F.when(x % 8 == 2, 103),
            F.when(x % 8 == 1, 101),
        ),
        lambda a: a.isNotNull(),
    )
    below_40 = spark.range(0, 40).select(F.explode(above).alias("ancestor_concept_id"), x.alias("x"))
    dose_form = spark.range(40, 41).select(F.lit(102).alias("ancestor_concept_id"), x.alias("x"))
    return below_40.union(dose_form).select(
        "ancestor_concept_id", (1000 + F.col("x")).cast("int").alias("descendant_concept_id")
    )


def code_set(spark: SparkSession) -> DataFrame:
    """The caller's code set: concept, category, weeks of gestation, value asked for."""
    weeks = {19: 30, 20: 45}
    rows = [
        (i, category, weeks.get(i), "R" if category == "FT" else "N/A")
        for i, category in enumerate(CONCEPT_CATEGORIES)
    ]
    rows += [(i, category, None, "N/A") for i, category in DRUG_CONCEPTS.items()]
    return values(spark, rows, CODE_SCHEMA)


def persons(customers: DataFrame) -> DataFrame:
    """Sex and year of birth by customer key.

    They come out of a generator to stand for stored columns: as plain
    expressions of the key, a filter on sex would turn into a filter on the
    person ids of the facts, in some branches of a plan and not in others, and
    the facts would be scanned once for each.
    """
    key = F.col("c_custkey")
    traits = F.struct(
        F.when(key % 10 == 0, 8507).otherwise(8532).alias("gender_concept_id"),
        (1940 + (key * 7) % 50).cast("int").alias("year_of_birth"),
    )
    return customers.select(key.alias("person_id"), F.inline(F.array(traits)))


def observation_periods(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    start = F.date_add(F.to_date(F.lit("1995-01-01")), ((key * 13) % 200).cast("int"))

    def period(first: Column, last: str) -> Column:
        return F.struct(
            first.alias("observation_period_start_date"),
            F.to_date(F.lit(last)).alias("observation_period_end_date"),
        )

    gap = F.array(period(start, "1998-06-30"), period(F.to_date(F.lit("1998-07-15")), "2001-12-31"))
    whole = F.array(period(start, "2001-12-31"))
    return customers.select(
        key.alias("person_id"), F.inline(F.when(key % 3 == 0, gap).otherwise(whole))
    )


def fixture_cdm(spark: SparkSession, sf_dir: str) -> FactsCdm:
    """The nine clinical tables over the tables in ``sf_dir``."""
    coded = facts(spark, sf_dir)
    customers = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")

    def domain(kind: str, concept: str, date: str, **more: str) -> DataFrame:
        source = F.col("drug_concept_id" if kind == DRUG else "concept_id")
        extra = [F.col(column).alias(name) for name, column in more.items()]
        return coded.filter(F.col("dom").isin(*DOMAINS[kind])).select(
            "person_id", source.alias(concept), F.col("d").alias(date), *extra
        )

    return FactsCdm(
        condition_occurrence=domain(CONDITION, "condition_concept_id", "condition_start_date"),
        procedure_occurrence=domain(PROCEDURE, "procedure_concept_id", "procedure_date"),
        observation=domain(
            OBSERVATION,
            "observation_concept_id",
            "observation_date",
            value_as_string="flag",
            value_as_number="number",
        ),
        measurement=domain(
            MEASUREMENT,
            "measurement_concept_id",
            "measurement_date",
            value_source_value="flag",
            value_as_number="number",
        ),
        drug_exposure=domain(DRUG, "drug_concept_id", "drug_exposure_start_date"),
        concept=concepts(spark),
        concept_ancestor=concept_ancestors(spark),
        observation_period=observation_periods(customers),
        person=persons(customers),
        facts=coded,
        lines=line_items(spark, sf_dir),
    )


def split_cdm(spark: SparkSession, sf_dir: str) -> Cdm:
    """The same clinical tables, each read on its own as stored tables would be."""
    whole = fixture_cdm(spark, sf_dir)
    return Cdm(**{field.name: getattr(whole, field.name) for field in fields(Cdm)})
