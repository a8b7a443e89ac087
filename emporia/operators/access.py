"""Row access views (keys J1-J4).

The reference shows row-level security policies. These functions select
the rows such a policy lets a user see; they filter data and are not a
security boundary. Lookups are semi joins or scalar subqueries, so no
grant table is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_for_ids(df: DataFrame, grants: DataFrame, user: str, id_col: str = "id",
                 user_col: str = "user_name", grant_col: str = "id") -> DataFrame:
    """USING (id IN (ids granted to the user))."""
    g = grants.filter(F.col(user_col) == user).select(F.col(grant_col).alias(id_col))
    return df.join(g, id_col, "left_semi")


def rows_for_owner(df: DataFrame, user: str, owner_col: str = "assigned_to") -> DataFrame:
    """USING (assigned_to = current_user)."""
    return df.filter(F.col(owner_col) == user)


def rows_for_tenant(df: DataFrame, user_tenants: DataFrame, user: str, tenant_col: str = "tenant_id",
                    user_col: str = "user_email") -> DataFrame:
    """USING (tenant_id = (SELECT tenant_id FROM user_tenants WHERE user_email = current_user)).

    A semi join on the user's tenant rows (PostgreSQL would raise if the
    subquery returned several rows; here any of them matches).
    """
    t = user_tenants.filter(F.col(user_col) == user).select(tenant_col)
    return df.join(t, tenant_col, "left_semi")


def rows_for_role(df: DataFrame, members: DataFrame, user: str, role: str, status_col: str = "status",
                  open_status: str = "pending", user_col: str = "member", role_col: str = "role") -> DataFrame:
    """USING (status = 'pending' OR pg_has_role(current_user, role, 'member')).

    Membership is a scalar subquery evaluated once by Spark, not collected.
    """
    is_member = members.filter((F.col(user_col) == user) & (F.col(role_col) == role)) \
        .select(F.count(F.lit(1)) > 0).scalar()
    return df.filter((F.col(status_col) == open_status) | is_member)
