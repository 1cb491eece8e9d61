"""Voters, election results and civic listings computed from the order tables.

The order tables carry no voters, so these give the analytics an input that grows with
them. Integer and date arithmetic only, so that any SQL engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: the state of each nation key, and the civic name templates --------------------
NATION_STATES = (
    "AL", "AZ", "CA", "CO", "FL", "GA", "IL", "IN", "IA", "MA", "MD", "MI", "MN",
    "MO", "NC", "NJ", "NV", "NY", "OH", "OR", "PA", "TX", "VA", "WA", "WI",
)
CIVIC_TEMPLATES = (
    "Presidential Primary",
    "Special Senate Election",
    "Governor General Election",
    "County Election",
    "House Election in CA",
    "City Council Election",
    "State Legislature Election",
    "Runoff",
)


# The columns read; naming them saves reading file footers for a schema.
TABLES = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _nation_state(nation: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in NATION_STATES]), nation.cast("int") + 1)


def _whole_days(count: Column, start: str) -> Column:
    return F.date_add(F.lit(start).cast("date"), count.cast("int"))


def voters(spark: SparkSession, folder: str) -> DataFrame:
    """Raw voter rows: one per customer, some repeated and some in conflicting versions."""
    k = F.col("c_custkey")
    buyer = F.col("o_custkey")
    voted = _whole_days(
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) * 3, "2005-06-01"
    )
    last_votes = (
        table(spark, folder, "orders")
        .where((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % (buyer % 5 + 1) == 0))
        .groupBy(buyer.alias("c_custkey"))
        .agg(F.max(voted).alias("last_voted_date"))
    )
    segment = F.col("c_mktsegment")
    base = (
        table(spark, folder, "customer")
        .join(last_votes, "c_custkey", "left")
        .select(
            k,
            k.cast("string").alias("source_id"),
            F.concat(F.lit("F"), (k % 97).cast("string")).alias("first_name"),
            F.concat(F.lit("L"), (k % 89).cast("string")).alias("last_name"),
            (k * 31 % 80 + 16).cast("int").alias("age"),
            F.when(k % 53 == 0, None).when(k % 2 == 0, "M").otherwise("F").alias("gender"),
            F.when(k % 41 == 0, "XXX").otherwise(_nation_state(F.col("c_nationkey"))).alias("state"),
            F.when(k % 11 == 0, "Green")
            .when(segment.isin("AUTOMOBILE", "MACHINERY"), "Democrat")
            .when(segment.isin("BUILDING", "FURNITURE"), "Republican")
            .otherwise("Independent")
            .alias("party"),
            F.when(k % 29 == 0, "no-at-sign")
            .otherwise(F.concat(F.lit("Voter"), k.cast("string"), F.lit("@Example.COM")))
            .alias("email"),
            _whole_days(k * 7919 % 12000, "1985-01-01").alias("registered_date"),
            "last_voted_date",
        )
    )
    # The row itself, an exact copy for some, and a version with another last vote for some.
    versions = F.filter(
        F.array(
            F.struct(F.col("last_voted_date").alias("voted"), F.lit(True).alias("kept")),
            F.struct(F.col("last_voted_date").alias("voted"), (k % 13 == 0).alias("kept")),
            F.struct(F.date_add("registered_date", 30).alias("voted"), (k % 17 == 0).alias("kept")),
        ),
        lambda version: version["kept"],
    )
    return (
        base.withColumn("version", F.explode(versions))
        .withColumn("last_voted_date", F.col("version.voted"))
        .drop("version", "c_custkey")
    )


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate results, one row per order; ``seq`` is the row order."""
    key = F.col("o_orderkey")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), _nation_state(F.col("c_nationkey")).alias("state_po")
    )
    votes = F.floor(F.col("o_totalprice") / 1000.0).cast("int")
    return (
        table(spark, folder, "orders")
        .join(customers, "o_custkey")
        .select(
            (key % 12 * 4 + 1976).cast("int").alias("year"),
            "state_po",
            F.concat(F.lit("CAND "), (key % 5).cast("string")).alias("candidate"),
            F.when(key % 5 == 0, "DEMOCRAT")
            .when(key % 5 == 1, "REPUBLICAN")
            .when(key % 5 == 2, "LIBERTARIAN")
            .otherwise("OTHER")
            .alias("party_simplified"),
            votes.alias("candidatevotes"),
            (votes * 3).cast("int").alias("totalvotes"),
            key.alias("seq"),
        )
    )


def civic(spark: SparkSession, folder: str) -> DataFrame:
    """Civic listings, one per order; ``seq`` is their order."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    templates = F.array(*[F.lit(t) for t in CIVIC_TEMPLATES])
    template = F.element_at(templates, (key % len(CIVIC_TEMPLATES) + 1).cast("int"))
    year = (key % 5 + 2023).cast("int")
    held = F.make_date(year, F.month(day), F.least(F.dayofmonth(day), F.lit(28)))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, folder, "orders")
        .join(customers, "o_custkey")
        .join(nations, "n_nationkey")
        .select(
            key.cast("string").alias("id"),
            F.concat_ws(" ", "n_name", year.cast("string"), template).alias("name"),
            F.concat(F.date_format(held, "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("electionDay"),
            key.alias("seq"),
        )
    )


def voter_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The voters as all-text file rows, with the kinds of dirt voter files carry."""
    k = F.col("source_id").cast("bigint")
    return voters(spark, folder).select(
        F.col("source_id").alias("id"),
        F.when(k % 10 == 0, "nan")
        .when(k % 43 == 0, F.concat(F.col("first_name"), F.lit(', the\n"second"')))
        .when(k % 3 == 0, F.concat(F.lit("  "), F.col("first_name"), F.lit(" ")))
        .otherwise(F.col("first_name"))
        .alias("first_name"),
        F.when(k % 19 == 0, "N/A").otherwise(F.col("last_name")).alias("last_name"),
        F.when(k % 23 == 0, "x")
        .when(k % 4 == 0, F.concat(F.col("age").cast("string"), F.lit(".0")))
        .otherwise(F.col("age").cast("string"))
        .alias("age"),
        "gender",
        "state",
        F.when(k % 7 == 0, F.concat(F.col("party"), F.lit("\t"))).otherwise(F.col("party")).alias("party"),
        "email",
        F.when(k % 31 == 0, F.date_format("registered_date", "yyyy/MM/dd"))
        .otherwise(F.date_format("registered_date", "yyyy-MM-dd"))
        .alias("registered_date"),
        F.when(k % 37 == 0, "2020-02-30")
        .when(k % 5 == 0, F.date_format("last_voted_date", "yyyy-MM-dd'T23:15:00'"))
        .otherwise(F.date_format("last_voted_date", "yyyy-MM-dd"))
        .alias("last_voted_date"),
    )
