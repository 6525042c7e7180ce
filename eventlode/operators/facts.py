"""The event fact table and the purchase facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventlode.operators.dedup import keep_first
from eventlode.operators.dims import lookup_device, lookup_product, lookup_time, lookup_user
from eventlode.operators.keys import assign_keys, highest_key
from eventlode.operators.observe import materialize_observed
from eventlode.operators.validate import accepted, route
from eventlode.schemas import CONSTANT_PURCHASE_AMOUNT, FACT_EVENTS, FACT_PURCHASES
from eventlode.session import materialize
from eventlode.sources.tables import BucketedTable


def measures(amount: Column | None = None, quantity: Column | None = None) -> dict[str, Column]:
    """Measure and flag columns. Without arguments a purchase counts as one item at a constant price."""
    kind = F.col("event_type")
    amount = F.lit(CONSTANT_PURCHASE_AMOUNT).cast("decimal(12,2)") if amount is None else amount
    quantity = F.lit(1) if quantity is None else quantity
    bought = kind == "purchase"
    return {
        "page_view_count": F.when(kind == "page_view", 1).otherwise(0),
        "purchase_amount": F.when(bought, amount).otherwise(F.lit(0)).cast("decimal(12,2)"),
        "purchase_quantity": F.when(bought, quantity).otherwise(F.lit(0)).cast("int"),
        "is_conversion": F.coalesce(bought, F.lit(False)),
        "is_error": F.coalesce(kind == "payment_failed", F.lit(False)),
    }


def build_facts(events: DataFrame, dim_user: DataFrame, dim_device: DataFrame, dim_time: DataFrame,
                constant_amount: bool = False) -> DataFrame:
    """One fact row per event, without its key.

    Events need event_id, user_id, event_type, device_type, ip_address, geo_location and
    event_timestamp; idempotency_key, total_amount, quantity and payload_json are used when there.
    The dimensions join by size: the calendar and the devices are small enough to broadcast by their
    statistics, the users are shuffled when they are not.
    """
    has = set(events.columns)
    optional = {
        "idempotency_key": F.col("event_id"),
        "schema_version": F.lit("v1"),
        "session_id": F.lit(None).cast("string"),
        "payload_json": F.lit(None).cast("string"),
        "kafka_timestamp": F.lit(None).cast("timestamp"),
        "ingestion_timestamp": F.lit(None).cast("timestamp"),
    }
    filled = events.withColumns({name: value for name, value in optional.items() if name not in has})
    keyed = lookup_user(lookup_device(lookup_time(filled, dim_time), dim_device), dim_user)
    real = not constant_amount and {"total_amount", "quantity"} <= has
    measured = measures(F.col("total_amount"), F.col("quantity")) if real else measures()
    place = F.col("geo_location")
    return keyed.withColumns({
        **measured,
        "geo_country": place["country"],
        "geo_region": place["region"],
        "geo_city": place["city"],
        "geo_latitude": F.expr("try_cast(geo_location['lat'] as decimal(10,8))"),
        "geo_longitude": F.expr("try_cast(geo_location['lon'] as decimal(11,8))"),
        "warehouse_loaded_at": F.current_timestamp(),
        "data_quality_score": F.lit(1).cast("decimal(3,2)"),
    }).select(*[name for name in FACT_EVENTS.names if name != "event_key"])


def events_of_bronze(bronze: DataFrame) -> DataFrame:
    """Valid bronze rows, one per idempotency key, with their true time and the payload's amounts."""
    valid = accepted(route(bronze))
    first = keep_first(valid)
    return first.select(
        "event_id", "idempotency_key", "user_id", "event_type", "schema_version", "device_type", "ip_address",
        "geo_location", "event_timestamp",
        F.expr("try_cast(payload['total_amount'] as decimal(12,2))").alias("total_amount"),
        F.coalesce(F.expr("try_cast(payload['quantity'] as int)"), F.lit(1)).alias("quantity"),
        F.col("payload")["session_id"].alias("session_id"),
        F.to_json("payload").alias("payload_json"),
        "kafka_timestamp",
        F.col("ingestion_time").alias("ingestion_timestamp"),
    )


def absent_facts(offered: DataFrame, stored: DataFrame, buckets: int | None = None) -> DataFrame:
    """Offered rows, one per idempotency key, that are not stored yet (insert or do nothing).

    ``buckets`` is the bucket count of the stored table. Splitting the offered rows the same way
    makes them the only side that moves, whatever the session's shuffle setting.
    """
    first = keep_first(offered)
    if buckets:
        first = first.repartition(buckets, "idempotency_key")
    return first.join(stored.select("idempotency_key"), "idempotency_key", "left_anti")


@dataclass(frozen=True)
class Load:
    """What a load did: rows added, and the stored loads whose keys it had to look at."""

    added: int
    joined: tuple[str, ...]


def load_new_facts(table: BucketedTable, facts: DataFrame, load_date: str) -> Load:
    """Append the facts that are new to the table.

    The filters of the stored loads tell which of them may hold a key of this one. Only their partitions are joined; a
    load of new keys reads none. Loads without a filter are joined always. The filter and the key range of the new rows
    are recorded before the rows, so a load lost in between costs a gap in the keys and nothing else. A second load of
    the same rows finds all its keys stored and appends nothing.
    """
    key = "idempotency_key"
    offered = materialize(keep_first(facts), "offered-facts")
    filters, ledger = table.filters, table.ledger
    hits = filters.possible(offered).select("load").distinct().collect()
    joined = sorted({r.load for r in hits} | (table.loads() - filters.loads()))
    new = offered
    if joined:
        stored = table.read().where(F.col(table.partition).isin(joined))
        new = absent_facts(offered, stored, table.buckets)
    added, seen = materialize_observed(new, "new-facts", F.count("*").alias("rows"))
    if seen["rows"]:
        if ledger.highest() is None:
            ledger.begin(highest_key(table.read(), "event_key"))
        after = ledger.reserve(seen["rows"], load_date)
        filters.add(added.select(key), seen["rows"], load_date)
        keyed = assign_keys(added, key, "event_key", after)
        table.append(keyed.withColumn(table.partition, F.lit(load_date)))
    return Load(seen["rows"], tuple(joined))


def load_facts(table: BucketedTable, facts: DataFrame, load_date: str) -> int:
    """Append the facts that are new to the table and return how many there were."""
    return load_new_facts(table, facts, load_date).added


def build_purchases(events: DataFrame, dim_user: DataFrame, dim_time: DataFrame,
                    dim_product: DataFrame) -> DataFrame:
    """Purchase facts of the second layout from events carrying a ``payload`` text map."""
    wanted = events.where(F.col("event_type").isin("purchase", "payment_failed")).select(
        "event_id", "user_id", "event_type", "event_timestamp",
        F.col("payload")["product_id"].alias("product_id"),
        F.col("payload")["transaction_id"].alias("transaction_id"),
        F.col("payload")["payment_method"].alias("payment_method"),
        F.col("payload")["currency"].alias("currency"),
        F.expr(
            "try_cast(coalesce(payload['total_amount'], payload['attempted_amount']) as decimal(15,2))"
        ).alias("amount"),
        F.expr("try_cast(payload['tax_amount'] as decimal(15,2))").alias("tax_amount"),
        F.expr("try_cast(payload['discount_amount'] as decimal(15,2))").alias("discount_amount"),
        F.coalesce(F.expr("try_cast(payload['quantity'] as int)"), F.lit(1)).alias("quantity"),
    )
    keyed = lookup_product(lookup_user(lookup_time(wanted, dim_time), dim_user), dim_product)
    return keyed.withColumns({
        "status": F.when(F.col("event_type") == "purchase", "completed").otherwise("failed"),
        "processed_at": F.current_timestamp(),
    }).select(*[name for name in FACT_PURCHASES.names if name != "purchase_key"])


def wrong_totals(purchases: DataFrame) -> DataFrame:
    """Purchases whose total is not unit price times quantity less the discount."""
    expected = F.round(F.col("unit_price") * F.col("quantity") - F.col("discount_amount"), 2)
    return purchases.where(~F.col("total_amount").eqNullSafe(expected))
