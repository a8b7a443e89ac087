"""Structured Streaming forms.

Sources are any streaming DataFrame (parquet/Kafka/...); sinks are chosen by
the caller. All stateful operators carry a watermark, so state is dropped
once a window can no longer change; late rows beyond the watermark are
dropped by Spark (the documented late-data rule for the activity views).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from emporia.sources.store import sync_continuous  # noqa: F401  (A10 lives with the store)


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; TD times are TIMESTAMP_NTZ (same wall time in a UTC session)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def row_activity_stream(log: DataFrame, width: str = "5 minutes", watermark: str = "10 minutes",
                        ts: str = "ts") -> DataFrame:
    """I3 streaming: inserts / updates / deletes per window; append mode emits a
    window once the watermark passes its end."""
    op = F.col("operation")
    return (_event_time(log, ts).withWatermark(ts, watermark)
            .groupBy(F.window(ts, width).alias("w"))
            .agg(F.count(F.when(op == "insert", 1)).alias("inserts"),
                 F.count(F.when(op == "update", 1)).alias("updates"),
                 F.count(F.when(op == "delete", 1)).alias("deletes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "inserts", "updates", "deletes"))


def working_set_stream(log: DataFrame, width: str = "15 minutes", slide: str = "5 minutes",
                       watermark: str = "10 minutes", item: str = "user_id", ts: str = "ts") -> DataFrame:
    """I4 streaming: approximate distinct items per sliding window (HyperLogLog state)."""
    return (_event_time(log, ts).withWatermark(ts, watermark)
            .groupBy(F.window(ts, width, slide).alias("w"))
            .agg(F.approx_count_distinct(item).alias("items"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "items"))


def cache_hit_stream(log: DataFrame, width: str = "1 hour", watermark: str = "10 minutes",
                     target: float = 0.99, ts: str = "ts") -> DataFrame:
    """I5 streaming: hit rate per window, flagged below target."""
    g = (_event_time(log, ts).filter(F.col("cache_hit").isNotNull()).withWatermark(ts, watermark)
         .groupBy(F.window(ts, width).alias("w"))
         .agg(F.count(F.lit(1)).alias("reads"), F.count(F.when(F.col("cache_hit"), 1)).alias("hits")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "reads", "hits",
                    (F.col("hits") / F.col("reads")).alias("hit_rate"),
                    ((F.col("hits") / F.col("reads")) < target).alias("below_target"))


def replication_lag_stream(commits: DataFrame, applies: DataFrame, bound: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """I8 streaming: commit-to-apply gap per version, of two streams joined as they run.

    ``commits`` (version, committed_at: one time a version) and ``applies``
    (version, applied_at) meet on the version, an apply at most ``bound`` after
    its commit. Both have watermarks, so a commit is held for the bound and the
    lateness and an apply no longer than a commit may still come; then the state
    is dropped. A version's row is out once nothing can change it: the last apply,
    how many there were, and the gap in seconds. A commit without any apply in its bound comes
    out with NULL applies: the copy is behind by more than the bound. Applies
    later than the bound, or later than the watermark allows, are not counted.
    """
    c = _event_time(commits, "committed_at").withWatermark("committed_at", watermark)
    a = (_event_time(applies, "applied_at").withWatermark("applied_at", watermark)
         .select(F.col("version").alias("_v"), "applied_at"))
    within = ((F.col("version") == F.col("_v")) & (F.col("applied_at") >= F.col("committed_at"))
              & (F.col("applied_at") <= F.col("committed_at") + F.expr(f"INTERVAL {bound}")))
    per_version = (c.join(a, within, "left_outer").groupBy("version", "committed_at")
                   .agg(F.max("applied_at").alias("applied_at"), F.count("_v").alias("applied_rows")))
    lag = F.timestamp_diff("SECOND", F.col("committed_at"), F.col("applied_at"))
    return per_version.withColumn("lag_seconds", lag.cast("long"))


CART_OUT = "customer_id long, product_id long, quantity long"
CART_EVENTS = "at long, event_id long"
CART_EVENT = "action string, product_id long, quantity long, known boolean"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def apply_cart_event(cart, action: str, product: int | None, quantity: int | None, known: bool) -> None:
    """One event on a cart (``get``, ``put``, ``drop``, ``clear`` by product), by H1's rules; an update without a quantity removes the item."""
    if action == "clear":
        cart.clear()
    elif action == "add" and known and quantity is not None and quantity >= 1:
        cart.put(product, (cart.get(product) or 0) + quantity)
    elif action == "update" and product is not None and cart.get(product) is not None:
        if quantity is None or quantity <= 0:
            cart.drop(product)
        else:
            cart.put(product, quantity)


class CartLines(dict):
    """A cart in memory."""

    def put(self, product, quantity):
        self[product] = quantity

    def drop(self, product):
        del self[product]


class StoredCart:
    """A cart as map state: one entry a product, so an event touches only its own."""

    def __init__(self, state):
        self.state = state

    def get(self, product):
        found = self.state.getValue((product,)) if self.state.containsKey((product,)) else None
        return None if found is None else int(found[0])

    def put(self, product, quantity):
        self.state.updateValue((product,), (quantity,))

    def drop(self, product):
        self.state.removeKey((product,))

    def clear(self):
        self.state.clear()


class CartProcessor(StatefulProcessor):
    """One customer's cart: map states of its lines and of the events that are still open, and the time of the last event.

    An event is open until the watermark has passed it; until then others may
    come before it. A timer at its time folds it into the lines. Another timer, ``expire``
    after the last event, drops the customer's state.
    """

    def __init__(self, expire_ms: int):
        self.expire_ms = expire_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.lines = handle.getMapState("lines", "product_id long", "quantity long")
        self.open = handle.getMapState("open", CART_EVENTS, CART_EVENT)
        self.last = handle.getValueState("last", "at long")

    def _opened(self):
        return sorted(((int(k[0]), int(k[1])), tuple(v)) for k, v in self.open.iterator())

    def handleInputRows(self, key, rows, timerValues):
        last = int(self.last.get()[0]) if self.last.exists() else 0
        before = last
        for frame in rows:
            for t, e, a, p, q, k in zip(frame["at"], frame["event_id"], frame["action"], frame["product_id"], frame["quantity"], frame["known"]):
                number = lambda x: None if x is None else int(x)
                self.open.updateValue((int(t), int(e)), (a, number(p), number(q), bool(k)))
                self.handle.registerTimer(int(t) // 1000 + 1)
                last = max(last, int(t))
        if last > before:
            self.last.update((last,))
            self.handle.registerTimer(last // 1000 + self.expire_ms)
        now = CartLines({int(k[0]): int(v[0]) for k, v in self.lines.iterator()})
        for _, event in self._opened():
            apply_cart_event(now, *event)
        yield self._cart(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        lines = StoredCart(self.lines)
        for place, event in self._opened():
            if place[0] >= closed:
                break
            apply_cart_event(lines, *event)
            self.open.removeKey(place)
        if self.last.exists() and int(self.last.get()[0]) // 1000 + self.expire_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.lines.clear()
            self.open.clear()
            self.last.clear()
            yield self._cart(key, {})

    def _cart(self, key, cart) -> pd.DataFrame:
        return pd.DataFrame({"customer_id": [int(key[0])] * max(1, len(cart)), "product_id": pd.array(list(cart) or [None], "Int64"),
                             "quantity": list(cart.values()) or [0]})

    def close(self) -> None:
        pass


def cart_state_stream(events: DataFrame, products: DataFrame, watermark: str = "1 hour", expire: str = "30 days") -> DataFrame:
    """H1 streaming: per-customer cart state across micro-batches (``CartProcessor``).

    Events apply in (ts, event_id) order, also those that arrive in a later
    micro-batch. Events older than the watermark are late and dropped. ``expire``
    after its last event a customer's state is dropped, too (an abandoned cart
    ends empty). What a batch writes to the state grows with its events, not
    with the carts they change.

    Ids and quantities travel as text, so they stay exact integers beside NULLs. Output
    mode 'update': each batch emits the whole current cart of every customer it
    touched (an empty cart as one row with NULL product). Map state and timers need the RocksDB state store.
    """
    spark = events.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STATE_STORE}")
    known = products.select(F.col("id").alias("product_id"), F.lit(True).alias("known"))
    text = lambda c: F.col(c).cast("string").alias(c)
    ev = (_event_time(events, "ts").withWatermark("ts", watermark).join(known, "product_id", "left")
          .select("customer_id", "ts", F.unix_micros("ts").cast("string").alias("at"), text("event_id"), "action",
                  text("product_id"), text("quantity"), F.coalesce(F.col("known"), F.lit(False)).alias("known")))
    return ev.groupBy("customer_id").transformWithStateInPandas(
        CartProcessor(int(pd.Timedelta(expire).total_seconds() * 1000)), CART_OUT, "Update", "EventTime")
