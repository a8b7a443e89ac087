"""Loyalty operators: points, tiers, members, profile.

Keys B5, C8, D13, D14, E1, E2, E6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators.common import has_column, table


def loyalty_tier(df: DataFrame, points_col: str = "loyalty_points", cuts=S.TIER_CUTS) -> DataFrame:
    """Tier column from points (>= cuts: Platinum, Gold, Silver; else Bronze)."""
    return df.withColumn("tier", S.loyalty_tier(points_col, cuts))


def loyalty_points(t) -> DataFrame:
    """Per customer COALESCE(SUM(FLOOR(total)::INT), 0) over all customers.

    The correlated subquery becomes a pre-aggregation of orders per customer
    (partial aggregation map side) and a left join onto customers.
    """
    per = (table(t, "orders").groupBy("customer_id")
           .agg(F.sum(F.floor("total").cast("int")).alias("_pts"))
           .withColumnRenamed("customer_id", "id"))
    c = table(t, "customers").select("id")
    return c.join(per, "id", "left").select(
        "id", F.coalesce(F.col("_pts"), F.lit(0)).cast("long").alias("loyalty_points"))


def backfill_points(t) -> DataFrame:
    """ADD COLUMN loyalty_points + UPDATE from the order aggregate.

    Returns the customers frame with loyalty_points set for every row
    (idempotent: any existing value is replaced by the recomputed one).
    """
    c = table(t, "customers")
    base = c.drop("loyalty_points") if has_column(c, "loyalty_points") else c
    return base.join(loyalty_points(t), "id", "left")


def enroll_members(customers: DataFrame, at, cuts=S.TIER_CUTS, existing: DataFrame | None = None,
                   exact: bool = False) -> DataFrame:
    """Members (email, tier, enrolled_at, total_earned) for points > 0.

    Default keys membership on email: customers already in ``existing`` keep
    their row (INSERT ... ON CONFLICT (email) DO NOTHING), so a replay changes
    nothing. ``exact=True`` copies the reference, whose conflict target is the
    serial id and never fires: every replay appends all members again.
    Returns the full member table (existing + new).
    """
    new = (customers.filter(F.col("loyalty_points") > 0)
           .select("email", S.loyalty_tier("loyalty_points", cuts).alias("tier"),
                   F.lit(at).cast("timestamp_ntz").alias("enrolled_at"),
                   F.col("loyalty_points").cast("long").alias("total_earned")))
    if existing is None:
        return new
    if exact:
        return existing.unionByName(new)
    from emporia.operators.sync import insert_if_absent
    return insert_if_absent(existing, new, ["email"])


def tier_distribution(members: DataFrame) -> DataFrame:
    """Members per tier."""
    return members.groupBy("tier").agg(F.count(F.lit(1)).alias("members"))


def member_profile(t, members: DataFrame) -> DataFrame:
    """Loyalty members JOIN customers on email."""
    c = table(t, "customers").select(F.col("id").alias("customer_id"), "name", "email")
    return members.join(c, "email").select("customer_id", "name", "email", "tier", "total_earned", "enrolled_at")


def award_points(customers: DataFrame, earned: DataFrame, key: str = "customer_id",
                 points_col: str = "points") -> DataFrame:
    """loyalty_points += earned per customer (earned pre-aggregated by key)."""
    e = earned.groupBy(key).agg(F.sum(points_col).alias("_earned")).withColumnRenamed(key, "id")
    return (customers.join(e, "id", "left")
            .withColumn("loyalty_points",
                        (F.col("loyalty_points") + F.coalesce(F.col("_earned"), F.lit(0))).cast("long"))
            .drop("_earned"))


def account_profile(t, customer_id, members: DataFrame | None = None) -> DataFrame:
    """Account page: id, name, email, plus loyalty_points / email_verified when
    the customers table has them (B3), plus tier, total earned and enrolment
    date from the loyalty members (C8) when given."""
    c = table(t, "customers").filter(F.col("id") == customer_id)
    cols = [F.col("id"), F.col("name"), F.col("email")]
    cols += [F.col(x) for x in ("loyalty_points", "email_verified") if has_column(c, x)]
    out = c.select(*cols)
    if members is None:
        return out
    m = members.select("email", F.col("tier").alias("loyalty_tier"),
                       F.col("total_earned").alias("loyalty_total_earned"),
                       F.col("enrolled_at").alias("loyalty_enrolled_at"))
    return out.join(m, "email", "left")
