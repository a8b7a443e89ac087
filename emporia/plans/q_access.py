"""Registered row access views (J1-J4) over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators import access as J
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

USER = "customer#000000007@example.com"
ROLE = "managers"
MANAGER_SEGMENT = "BUILDING"


def _grants(t):
    """Each order is granted to its customer and to the customer with the next lower id."""
    o = t.orders.select("id", "customer_id")
    own = o.join(t.customers.select(F.col("id").alias("customer_id"), F.col("email").alias("user_name")), "customer_id")
    nxt = o.join(t.customers.select((F.col("id") + 1).alias("customer_id"), F.col("email").alias("user_name")),
                 "customer_id")
    return own.unionByName(nxt).select("user_name", "id")


_GRANTS_SQL = ("(SELECT c.email AS user_name, o.id FROM orders o JOIN customers c ON c.id = o.customer_id "
               "UNION ALL SELECT c.email, o.id FROM orders o JOIN customers c ON c.id + 1 = o.customer_id)")


@register("rows_for_ids", with_sql(f"""
    SELECT * FROM orders WHERE id IN (SELECT id FROM {_GRANTS_SQL} WHERE user_name = '{USER}')""",
                                   "orders", "customers"))
def q_rows_for_ids(t):
    """J1 orders whose id is granted to the user."""
    return J.rows_for_ids(t.orders, _grants(t), USER)


def _assigned(t):
    return t.orders.join(t.customers.select(F.col("id").alias("customer_id"), F.col("email").alias("assigned_to")),
                         "customer_id")


@register("rows_for_owner", with_sql(f"""
    SELECT o.*, c.email AS assigned_to FROM orders o JOIN customers c ON c.id = o.customer_id
    WHERE c.email = '{USER}'""", "orders", "customers"))
def q_rows_for_owner(t):
    """J2 orders assigned to the user."""
    return J.rows_for_owner(_assigned(t), USER)


@register("rows_for_tenant", with_sql(f"""
    SELECT o.*, c.nation_id AS tenant_id FROM orders o JOIN customers c ON c.id = o.customer_id
    WHERE c.nation_id IN (SELECT nation_id FROM customers WHERE email = '{USER}')""", "orders", "customers"))
def q_rows_for_tenant(t):
    """J3 orders of the user's tenant (nation)."""
    scoped = t.orders.join(t.customers.select(F.col("id").alias("customer_id"), F.col("nation_id").alias("tenant_id")),
                           "customer_id")
    user_tenants = t.customers.select(F.col("email").alias("user_email"), F.col("nation_id").alias("tenant_id"))
    return J.rows_for_tenant(scoped, user_tenants, USER)


@register("rows_for_role", with_sql(f"""
    SELECT * FROM orders WHERE status = 'pending' OR EXISTS (
      SELECT 1 FROM customers WHERE email = '{USER}' AND segment = '{MANAGER_SEGMENT}')""", "orders", "customers"))
def q_rows_for_role(t):
    """J4 pending orders, or all orders for members of the managers role."""
    members = t.customers.filter(F.col("segment") == MANAGER_SEGMENT).select(
        F.col("email").alias("member"), F.lit(ROLE).alias("role"))
    return J.rows_for_role(t.orders, members, USER, ROLE)


@register("rows_for_role_manager", with_sql(f"""
    SELECT * FROM orders WHERE status = 'pending' OR EXISTS (
      SELECT 1 FROM customers m JOIN customers u ON u.segment = m.segment
      WHERE u.email = '{USER}' AND m.email = '{USER}')""", "orders", "customers"))
def q_rows_for_role_manager(t):
    """J4 where the role is every customer of the user's own segment: the user is a member and sees all orders."""
    seg = t.customers.filter(F.col("email") == USER).select("segment")
    members = t.customers.join(seg, "segment").select(F.col("email").alias("member"), F.lit(ROLE).alias("role"))
    return J.rows_for_role(t.orders, members, USER, ROLE)


@register("safe_identifier", with_sql(f"""
    SELECT id, email, {S.safe_identifier_sql('email')} AS schema_name FROM customers""", "customers"))
def q_safe_identifier(t):
    """K name cleaning: an email turned into a safe lower-case identifier."""
    return t.customers.select("id", "email", S.safe_identifier("email").alias("schema_name"))
