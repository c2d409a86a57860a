"""Version history: neighbours in time, type-2 dimension, point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import surrogate_key


ROWS_PER_SLOT = 1_000_000  # of one key that a window sorts together
MOST_CUTS = 4_096  # of one key; the sketch they come from is exact to 1 in 10,000


def hot_key_cuts(df: DataFrame, keys: Sequence[str], order: str, rows_per_slot: int) -> DataFrame | None:
    """(keys, _cuts): for each key of more than ``rows_per_slot`` rows the values of ``order`` that
    cut them into parts of about that many; None if there is no such key.

    The cuts follow the distribution of the key itself, so a key whose rows crowd into one
    month, or one hour, is cut inside it. At most one key in ``rows_per_slot`` rows is hot.
    """
    hot = df.groupBy(*keys).agg(F.count(order).alias("_n")).where(F.col("_n") > rows_per_slot)
    largest = hot.agg(F.max("_n")).first()[0]
    if largest is None:
        return None
    parts = min(-(-largest // rows_per_slot), MOST_CUTS)
    fractions = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    return df.join(hot.drop("_n"), list(keys), "left_semi").groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx(order, fractions)).alias("_cuts"))


def with_slots(df: DataFrame, cuts: DataFrame | None, keys: Sequence[str], order: str) -> DataFrame:
    """``df`` with ``_slot``, which grows with ``order`` within a key; 0 for keys that are not hot."""
    if cuts is None:
        return df.withColumn("_slot", F.lit(0))
    below = F.size(F.filter("_cuts", lambda c: c <= F.col(order)))
    return df.join(cuts, list(keys), "left").withColumn(
        "_slot", F.when(F.col("_cuts").isNull(), 0).otherwise(below)).drop("_cuts")


def with_neighbours(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Add ``_previous`` and ``_next``: structs of ``values`` from the adjacent
    rows of the same key, NULL at the ends (lag and lead for keys of any size).

    Without a hot key this is lag and lead in one window. A hot key is cut into slots of
    equal numbers of rows; the window runs per (key, slot), and only the edges of its slots,
    one row each after partial aggregation, are ordered per key. ``order`` must be unique
    within a key and keys not NULL.
    """
    payload = F.struct(*values)
    cuts = hot_key_cuts(df, keys, order, rows_per_slot)
    if cuts is None:
        plain = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({"_previous": F.lag(payload).over(plain), "_next": F.lead(payload).over(plain)})
    slotted = with_slots(df, cuts, keys, order)
    inner = Window.partitionBy(*keys, "_slot").orderBy(order)
    rows = slotted.withColumns({"_lag": F.lag(payload).over(inner), "_lead": F.lead(payload).over(inner)})
    at = F.struct(F.col(order).alias("_at"), payload.alias("_row"))
    edges = slotted.groupBy(*keys, "_slot").agg(F.min(at).alias("_low"), F.max(at).alias("_high"))
    outer = Window.partitionBy(*keys).orderBy("_slot")
    edges = edges.select(
        *keys, "_slot",
        F.lag("_high._row").over(outer).alias("_from_before"),
        F.lead("_low._row").over(outer).alias("_from_after"))
    return (
        rows.join(edges, [*keys, "_slot"], "left")
        .withColumns({
            "_previous": F.coalesce("_lag", "_from_before"),
            "_next": F.coalesce("_lead", "_from_after")})
        .drop("_slot", "_lag", "_lead", "_from_before", "_from_after")
    )


def customer_history(versions: DataFrame) -> DataFrame:
    """Type-2 customer dimension (W7) from one row per (customer, updated_at).

    One shared window: a daily feed gives a customer at most one version a day,
    which bounds its rows. The first version is open towards the past and the last towards the
    future; both real dates stay visible as customer_since and observed_from.
    """
    order = Window.partitionBy("customer_id").orderBy("updated_at")
    rows = versions.withColumns({
        "_number": F.row_number().over(order), "_next": F.lead("updated_at").over(order)})
    return rows.select(
        surrogate_key(F.col("customer_id"), F.col("updated_at")).alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "loyalty_tier",
        F.col("created_at").alias("customer_since"),
        F.when(F.col("_number") > 1, F.col("updated_at")).alias("valid_from"),
        F.col("_next").alias("valid_to"),
        F.col("updated_at").alias("observed_from"),
        F.col("_next").isNull().alias("is_current"),
    )


def interval_join(
    facts: DataFrame, versions: DataFrame, key: str, at: str, payload: Sequence[str],
) -> DataFrame:
    """Left join to the version valid at ``at`` (J2): NULL bounds are open, the
    lower bound is inclusive and the upper one exclusive.

    Planned as a sort-merge join on the key with the bounds as residual. A hot
    key on the fact side is split by the adaptive skew join. A fact is compared
    with the versions of its own key only, and a daily feed adds at most one
    version per key and day; for histories without such a bound use
    ``asof_join``, which is linear.
    """
    v = versions.select(F.col(key).alias("_key"), "valid_from", "valid_to", *payload)
    covers = (
        (F.col(key) == F.col("_key"))
        & (F.col("valid_from").isNull() | (F.col(at) >= F.col("valid_from")))
        & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))))
    return facts.join(v, covers, "left").drop("_key", "valid_from", "valid_to")


def asof_join(
    facts: DataFrame, versions: DataFrame, key: str, at: str, since: str,
    payload: Sequence[str], rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Left join to the last version whose ``since`` is not after ``at``, else
    to the first version of the key: the same answer as ``interval_join`` over
    a gap-free history, without comparing facts with versions pairwise.

    A prefix scan finds the version of every distinct (key, instant): instants and versions
    are merged in time order per (key, slot), where slots cut a hot key at its own quantiles,
    and the version that enters a slot comes from one row per (key, slot). The facts then
    meet their instant by equality, so the facts of a hot key are spread by their times, and
    an adaptive skew join splits those of one instant. Facts are read twice; hand in a stored
    table, not a long plan. A fact without key or time gets no version.
    """
    version = F.struct(since, *payload)
    states = versions.select(F.col(key).alias("_key"), F.col(since).alias("_at"), version.alias("_v"))
    kind = states.schema["_v"].dataType
    instants = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at")).where(
        F.col("_key").isNotNull() & F.col("_at").isNotNull()).distinct()
    times = states.withColumn("_side", F.lit(0)).unionByName(
        instants.withColumns({"_side": F.lit(1), "_v": F.lit(None).cast(kind)}))
    cuts = hot_key_cuts(times, ["_key"], "_at", rows_per_slot)
    merged = with_slots(times, cuts, ["_key"], "_at")
    slot = Window.partitionBy("_key", "_slot")
    so_far = slot.orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    scanned = merged.withColumns({
        "_found": F.last("_v", ignorenulls=True).over(so_far), "_first": F.min("_v").over(slot)})
    if cuts is None:
        answers = scanned.where("_side = 1").select("_key", "_at", F.coalesce("_found", "_first").alias("_v"))
    else:
        order = Window.partitionBy("_key").orderBy("_slot")
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        edges = merged.groupBy("_key", "_slot").agg(F.max("_v").alias("_last"), F.min("_v").alias("_low"))
        carried = edges.select(
            "_key", "_slot", F.coalesce(
                F.last("_last", ignorenulls=True).over(earlier),
                F.first("_low", ignorenulls=True).over(whole)).alias("_carried"))
        answers = scanned.where("_side = 1").join(carried, ["_key", "_slot"], "left").select(
            "_key", "_at", F.coalesce("_found", "_carried").alias("_v"))
    return facts.join(answers, (F.col(key) == F.col("_key")) & (F.col(at) == F.col("_at")), "left").select(
        *[facts[c] for c in facts.columns], *[F.col(f"_v.{c}").alias(c) for c in payload])


def history_defects(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys whose versions have a gap or overlap, or not exactly one current
    and one first version (W8)."""
    chained = with_neighbours(
        dim.select(key, "observed_from", "valid_from", "valid_to"), [key], "observed_from", ["valid_from"])
    following = F.col("_next.valid_from")
    broken = chained.where(
        following.isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") != following)))
    counted = dim.groupBy(key).agg(
        F.count_if("is_current").alias("current"),
        F.count_if(F.col("valid_from").isNull()).alias("first"))
    # Fixed labels of the check result.
    return (
        broken.select(key, F.lit("trou ou chevauchement").alias("probleme"))
        .unionByName(counted.where("current != 1").select(
            key, F.lit("versions courantes != 1").alias("probleme")))
        .unionByName(counted.where("first != 1").select(
            key, F.lit("premières versions != 1").alias("probleme")))
    )
