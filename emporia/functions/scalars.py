"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen. Each helper that has a DuckDB twin
(used by the oracle SQL) keeps the twin right next to it, so the two cannot
drift apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for right results.
# Loyalty tier cut points (points >= cut), highest first.
TIER_NAMES = ("Platinum", "Gold", "Silver", "Bronze")
TIER_CUTS = (3000, 1500, 500)
# Order priority bounds: total > high -> 'high', > medium -> 'medium'.
PRIORITY_HIGH = 500
PRIORITY_MEDIUM = 200
# Order statuses allowed by the orders CHECK constraint.
ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled")
# Review ratings allowed by the reviews CHECK constraint.
RATING_LOW, RATING_HIGH = 1, 5
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def loyalty_tier(points: str | Column, cuts=TIER_CUTS) -> Column:
    """Tier name for a points value: >= cuts[0] Platinum ... else Bronze."""
    p = col(points)
    c1, c2, c3 = cuts
    return (F.when(p >= c1, F.lit(TIER_NAMES[0]))
            .when(p >= c2, F.lit(TIER_NAMES[1]))
            .when(p >= c3, F.lit(TIER_NAMES[2]))
            .otherwise(F.lit(TIER_NAMES[3])))


def loyalty_tier_sql(points: str, cuts=TIER_CUTS) -> str:
    c1, c2, c3 = cuts
    return (f"CASE WHEN {points} >= {c1} THEN '{TIER_NAMES[0]}' WHEN {points} >= {c2} THEN '{TIER_NAMES[1]}' "
            f"WHEN {points} >= {c3} THEN '{TIER_NAMES[2]}' ELSE '{TIER_NAMES[3]}' END")


def order_priority(total: str | Column, high=PRIORITY_HIGH, medium=PRIORITY_MEDIUM) -> Column:
    t = col(total)
    return (F.when(t > high, F.lit("high"))
            .when(t > medium, F.lit("medium"))
            .otherwise(F.lit("normal")))


def order_priority_sql(total: str, high=PRIORITY_HIGH, medium=PRIORITY_MEDIUM) -> str:
    return f"CASE WHEN {total} > {high} THEN 'high' WHEN {total} > {medium} THEN 'medium' ELSE 'normal' END"


def points_for_price(price: str | Column) -> Column:
    """FLOOR(price)::INT -- loyalty points earned per unit."""
    return F.floor(col(price)).cast("int")


def _unit(scale: int) -> Column:
    """10^-scale as a literal DECIMAL(scale+1, scale)."""
    return F.lit(f"0.{'0' * (scale - 1)}1" if scale else "1").cast(f"decimal({scale + 1},{scale})")


def half_up_div(num: str | Column, den: str | Column, scale: int) -> Column:
    """Exact ``round(num / den, scale)`` for integral num, den > 0; halves go away from zero.

    64-bit integer arithmetic (``div``), then the integer is scaled into a
    DECIMAL(18, scale): no float rounding and no wide-decimal slow path, so it
    is cheap enough per row. Needs num * 2 * 10^scale + den < 2^63; for sums
    that may grow past that use ``half_up_div_wide``. NULL when den is 0/NULL.
    """
    p = 10 ** scale
    n = col(num).cast("long")
    d = col(den).cast("long")
    # Rounded on the absolute value: ``div`` cuts towards zero.
    q = F.call_function("div", F.abs(n) * (2 * p) + d, d * 2) * F.signum(n).cast("long")
    return F.when(d > 0, (q.cast("decimal(18,0)") * _unit(scale)).cast(f"decimal(18,{scale})"))


def half_up_div_wide(num: str | Column, den: str | Column, scale: int) -> Column:
    """``half_up_div`` in DECIMAL(38,0) for per-group values of any size
    (used once per group, where the wide-decimal cost does not matter)."""
    p = 10 ** scale
    n = col(num).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    a = F.abs(n) * (2 * p) + d
    b = d * 2
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    q = F.when(n < 0, -q).otherwise(q)
    return F.when(d > 0, (q * _unit(scale)).cast(f"decimal(38,{scale})"))


def half_up_div_sql(num: str, den: str, scale: int) -> str:
    p = 10 ** scale
    return (f"CAST(CASE WHEN ({den}) > 0 THEN CAST(sign({num}) AS HUGEINT) * "
            f"((abs(CAST({num} AS HUGEINT)) * {2 * p} + CAST({den} AS HUGEINT)) "
            f"// (CAST({den} AS HUGEINT) * 2)) END / {p}.0 AS DECIMAL(38,{scale}))")


def avg_round(amount: str | Column, scale: int, unit_scale: int = 0) -> Column:
    """Aggregate: exact ROUND(AVG(x), scale) of x with ``unit_scale`` decimals; halves go away from zero.

    Per row only the plain SUM and COUNT run (partial aggregation map side;
    a decimal sum stays on Spark's compact-long fast path). Once per group the
    sum is turned into integer units and divided exactly. DECIMAL(18, scale).
    """
    a = col(amount)
    units = (F.sum(a) * (10 ** unit_scale)).cast("decimal(38,0)")
    d = F.count(a) * (10 ** unit_scale)
    return half_up_div_wide(units, d, scale).cast(f"decimal(18,{scale})")


def avg_round_sql(amount: str, scale: int, unit_scale: int = 0) -> str:
    u = 10 ** unit_scale
    units = f"SUM(CAST(ROUND({amount} * {u}) AS HUGEINT))"
    d = f"(COUNT({amount}) * {u})"
    return f"CAST({half_up_div_sql(units, d, scale)} AS DECIMAL(18,{scale}))"


def money(c: str | Column) -> Column:
    """Money columns are DECIMAL(18,2)."""
    return col(c).cast("decimal(18,2)")


def safe_identifier(c: str | Column) -> Column:
    """Lower-case name cleaned to [a-z0-9_], runs of '_' squeezed, edges trimmed; '' -> 'user'."""
    v = F.lower(F.trim(col(c)))
    v = F.regexp_replace(v, r"[^a-z0-9_]", "_")
    v = F.regexp_replace(v, r"_+", "_")
    v = F.regexp_replace(v, r"^_+|_+$", "")
    return F.when(v == "", F.lit("user")).otherwise(v)


def safe_identifier_sql(c: str) -> str:
    v = f"regexp_replace(regexp_replace(lower(trim({c})), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g')"
    v = f"regexp_replace({v}, '^_+|_+$', '', 'g')"
    return f"CASE WHEN {v} = '' THEN 'user' ELSE {v} END"


def stock_status(quantity: str | Column, reorder_level: str | Column) -> Column:
    q = col(quantity)
    return (F.when(q <= 0, F.lit("Out of Stock"))
            .when(q <= col(reorder_level), F.lit("Low Stock"))
            .otherwise(F.lit("In Stock")))


def stock_status_sql(q: str, r: str) -> str:
    return f"CASE WHEN {q} <= 0 THEN 'Out of Stock' WHEN {q} <= {r} THEN 'Low Stock' ELSE 'In Stock' END"
