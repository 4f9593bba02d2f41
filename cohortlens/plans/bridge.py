"""The driver's star-schema tables in the shape of postings, by a deterministic rule that SQL states as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF, RECENT_DAYS = "2001-08-01", 110


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order; place and company from its customer."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    role = F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise(F.col("o_orderpriority"))
    by_remainder = {0: "USD", 1: "EUR", 2: "GBP", 3: "PLN"}
    currency, visa = F.lit(None).cast("string"), F.lit("not_mentioned")
    for r, c in by_remainder.items():
        currency = F.when(k % 5 == r, c).otherwise(currency)
    for r, v in {1: "offered", 2: "explicitly_not"}.items():
        visa = F.when(k % 3 == r, v).otherwise(visa)
    mode = F.when(F.col("o_orderstatus") == "O", "remote").when(F.col("o_orderstatus") == "F", "onsite").otherwise("unclear")
    return rows.select(
        k.alias("posting_id"),
        F.concat(F.lit("s"), (k % 7).cast("string")).alias("source"),
        k.cast("string").alias("source_id"),
        F.concat_ws(" ", "o_orderpriority", "c_mktsegment").alias("title"),
        F.col("c_name").alias("company"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        role.alias("role"),
        role.alias("role_hint"),
        F.when(k % 2 == 0, "full").otherwise("excerpt").alias("text_quality"),
        F.col("o_orderdate").cast("timestamp").alias("posted_at"),
        p.alias("salary_min"),
        F.when(k % 3 == 0, F.lit(None)).when(k % 11 == 0, p * 3).otherwise(p * 1.2).alias("salary_max"),
        currency.alias("salary_currency"),
        (k % 4 == 0).alias("salary_is_predicted"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "unclear").otherwise(F.col("c_mktsegment")).alias("seniority"),
        mode.alias("work_mode"),
        visa.alias("visa_sponsorship"),
        F.when(F.col("o_custkey") % 12 != 0, F.col("o_custkey") % 12).cast("int").alias("years_experience_min"),
        F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderpriority").alias("dedupe_key"),
    )


def recent(spark: SparkSession, sf_dir: str, quiet_role: str = "other") -> DataFrame:
    """Postings of the window before AS_OF with a role."""
    from ..operators.marts import is_recent

    rows = postings(spark, sf_dir)
    return rows.where((F.col("role") != quiet_role) & is_recent(F.col("posted_at"), F.lit(AS_OF).cast("date"), RECENT_DAYS))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mention per line item: the part's name, capital on odd lines."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    raw = F.when(F.col("l_linenumber") % 2 == 1, F.upper("p_name")).otherwise(F.col("p_name"))
    wish = F.when(F.col("l_returnflag") == "R", "required").when(F.col("l_returnflag") == "A", "preferred").otherwise("unclear")
    return rows.select(F.col("l_orderkey").alias("posting_id"), raw.alias("skill_raw"), F.lower(F.element_at(F.split("p_type", " "), -1)).alias("kind"), wish.alias("requirement"))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names and their second word as canonical name; names that start with `hot` stay unmapped."""
    names = table(spark, sf_dir, "part").select(F.lower("p_name").alias("alias")).distinct().where(~F.col("alias").startswith("hot"))
    second = F.element_at(F.split("alias", " "), 2)
    return names.select("alias", second.alias("canonical_skill"), F.when(second < "m", "tool").otherwise("concept").alias("kind"))
