"""Registered loyalty queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators import loyalty as L
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

# TD points are order totals (1,000-500,000 each), so the reference cuts
# (3000/1500/500) would make everyone Platinum; these split TD customers.
TD_CUTS = (3000000, 1500000, 500000)
ENROLLED_AT = "2024-06-01 00:00:00"

_POINTS_SQL = """(SELECT c.id, CAST(COALESCE(SUM(CAST(FLOOR(o.total) AS INTEGER)), 0) AS BIGINT) AS loyalty_points
    FROM customers c LEFT JOIN orders o ON o.customer_id = c.id GROUP BY c.id)"""
_BACKFILL_SQL = f"(SELECT c.*, pts.loyalty_points FROM customers c JOIN {_POINTS_SQL} pts ON pts.id = c.id)"
_MEMBERS_SQL = (f"(SELECT email, {S.loyalty_tier_sql('loyalty_points', TD_CUTS)} AS tier, "
                f"TIMESTAMP '{ENROLLED_AT}' AS enrolled_at, loyalty_points AS total_earned "
                f"FROM {_BACKFILL_SQL} WHERE loyalty_points > 0)")


def _members(t):
    return L.enroll_members(L.backfill_points(t), ENROLLED_AT, TD_CUTS)


@register("loyalty_points", with_sql(f"SELECT * FROM {_POINTS_SQL}", "customers", "orders"))
def q_loyalty_points(t):
    """D13 points per customer (correlated subquery as pre-aggregation + left join)."""
    return L.loyalty_points(t)


@register("backfill_points", with_sql(f"SELECT * FROM {_BACKFILL_SQL}", "customers", "orders"))
def q_backfill_points(t):
    """E1 customers with loyalty_points backfilled."""
    return L.backfill_points(t)


@register("loyalty_tier", with_sql(f"""
    SELECT *, {S.loyalty_tier_sql('loyalty_points', TD_CUTS)} AS tier FROM {_BACKFILL_SQL}""", "customers", "orders"))
def q_loyalty_tier(t):
    """B5 tier for every customer."""
    return L.loyalty_tier(L.backfill_points(t), "loyalty_points", TD_CUTS)


@register("enroll_members", with_sql(f"SELECT * FROM {_MEMBERS_SQL}", "customers", "orders"))
def q_enroll_members(t):
    """E2 loyalty members for points > 0, keyed on email."""
    return _members(t)


@register("enroll_members_replay", with_sql(f"SELECT * FROM {_MEMBERS_SQL}", "customers", "orders"))
def q_enroll_members_replay(t):
    """E2 replayed onto its own output: keyed on email, nothing changes."""
    first = _members(t)
    return L.enroll_members(L.backfill_points(t), ENROLLED_AT, TD_CUTS, existing=first)


@register("tier_distribution", with_sql(f"""
    SELECT tier, COUNT(*) AS members FROM {_MEMBERS_SQL} GROUP BY tier""", "customers", "orders"))
def q_tier_distribution(t):
    """D14 members per tier."""
    return L.tier_distribution(_members(t))


@register("member_profile", with_sql(f"""
    SELECT c.id AS customer_id, c.name, m.email, m.tier, m.total_earned, m.enrolled_at
    FROM {_MEMBERS_SQL} m JOIN customers c ON c.email = m.email""", "customers", "orders"))
def q_member_profile(t):
    """C8 loyalty members JOIN customers on email."""
    return L.member_profile(t, _members(t))


@register("enroll_members_exact_replay", with_sql(f"SELECT * FROM {_MEMBERS_SQL} UNION ALL SELECT * FROM {_MEMBERS_SQL}",
                                                  "customers", "orders"))
def q_enroll_members_exact_replay(t):
    """E2 exact=True: the reference's ON CONFLICT (id) never fires, so a replay duplicates every member."""
    first = _members(t)
    return L.enroll_members(L.backfill_points(t), ENROLLED_AT, TD_CUTS, existing=first, exact=True)


ONE_ACCOUNT = 7


@register("account_profile", with_sql(f"""
    SELECT b.id, b.name, b.email, b.loyalty_points, (b.id % 3 = 0) AS email_verified,
           m.tier AS loyalty_tier, m.total_earned AS loyalty_total_earned, m.enrolled_at AS loyalty_enrolled_at
    FROM {_BACKFILL_SQL} b LEFT JOIN {_MEMBERS_SQL} m ON m.email = b.email WHERE b.id = {ONE_ACCOUNT}""",
                                     "customers", "orders"))
def q_account_profile(t):
    """Account page after the loyalty and email-verified migrations (B3 + C8)."""
    from emporia.operators.orders import email_verified
    # Filter the customer first: the join to orders then infers
    # orders.customer_id = ONE_ACCOUNT, so only that customer's orders are read.
    one = {"customers": t.customers.filter(F.col("id") == ONE_ACCOUNT), "orders": t.orders}
    migrated = email_verified(L.backfill_points(one))
    members = L.enroll_members(migrated, ENROLLED_AT, TD_CUTS)
    return L.account_profile({"customers": migrated}, ONE_ACCOUNT, members)
