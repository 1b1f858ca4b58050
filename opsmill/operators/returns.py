"""Return and refund rules over whole tables of return requests.

A request has order_id, line_no, product_id, customer_id, amount, ordered_at,
delivered_on, requested_on, item_condition; an order (shipment) has order_id,
customer_id, order_value, ordered_at."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import flags, in_yearly_period, ratio, timestamp
from opsmill.operators.trailing import trailing_counts
from opsmill.session import materialise


def customer_tiers(orders: DataFrame, as_of) -> DataFrame:
    """VIP, NEW or STANDARD as of a day."""
    day = timestamp(as_of).cast("date")
    placed = F.col("ordered_at").cast("date")
    recent = (placed <= day) & (placed >= F.add_months(day, -12))
    df = (orders.filter(placed <= day).groupBy("customer_id", "order_id")
          .agg(F.max(recent.cast("int")).alias("recent"))
          .groupBy("customer_id").agg(F.count("*").alias("total_orders"), F.sum("recent").alias("orders_12m")))
    return df.withColumn("tier", F.when(F.col("orders_12m") >= config.VIP_MIN_ORDERS, "VIP")
                         .when(F.col("total_orders") == 1, "NEW").otherwise("STANDARD"))


def running_tiers(orders: DataFrame) -> DataFrame:
    """Orders in the 12 months up to every order day of every customer."""
    df = trailing_counts(orders, "customer_id", "ordered_at", 12, "orders_12m")
    return df.withColumn("is_vip", F.col("orders_12m") >= config.VIP_MIN_ORDERS)


def with_vip(requests: DataFrame, orders: DataFrame, day: str) -> DataFrame:
    """Requests with ``is_vip`` as of their own day."""
    counts = trailing_counts(orders, "customer_id", "ordered_at", 12, "orders_12m", requests, day)
    counts = counts.withColumnRenamed("day", "_day")
    joined = requests.withColumn("_day", F.col(day).cast("date")).join(counts, ["customer_id", "_day"], "left")
    return joined.withColumn("is_vip", F.coalesce(F.col("orders_12m"), F.lit(0)) >= config.VIP_MIN_ORDERS).drop("_day")


def high_return_customers(lines: DataFrame) -> DataFrame:
    orders = (lines.filter(F.col("customer_id") > 0).groupBy("customer_id", "order_id")
              .agg(F.max(F.col("returned").cast("int")).alias("r")))
    df = orders.groupBy("customer_id").agg(F.count("*").alias("total_orders"), F.sum("r").alias("returned_orders"))
    return (df.withColumn("return_rate", ratio(F.col("returned_orders"), F.col("total_orders")))
            .withColumn("review", F.col("return_rate") > config.HIGH_RETURN_RATE))


def return_window(requests: DataFrame) -> DataFrame:
    """Needs ``is_vip``; adds days_used, window_rule, days_left, eligible."""
    holiday = in_yearly_period(F.col("ordered_at"), config.RETURN_HOLIDAYS)
    rule = F.when(holiday, "holiday").when(F.col("is_vip"), "vip").otherwise("standard")
    allowed = F.when(F.col("window_rule") == "standard", config.RETURN_WINDOW_DAYS).otherwise(config.EXTENDED_WINDOW_DAYS)
    df = requests.withColumns({"window_rule": rule, "days_used": F.datediff("requested_on", "delivered_on")})
    return (df.withColumn("days_left", allowed - F.col("days_used"))
            .withColumn("eligible", F.col("days_left") >= 0))


def refund_form(condition: Column, is_vip: Column) -> Column:
    return (F.when(condition == "adverse_reaction", "full_refund_expedited")
            .when(condition == "damaged", "refund_or_replacement_plus_10pct")
            .when(condition == "unopened", "full_refund")
            .when((condition == "opened") & is_vip, "full_refund_manager_discretion")
            .when(condition == "opened", "store_credit"))


def _by_tier(amount: Column, pick) -> Column:
    out = None
    for tier in config.REFUND_TIERS:
        _, high, inclusive, _, _ = tier
        fits = F.lit(True) if high is None else ((amount <= high) if inclusive else (amount < high))
        out = (F if out is None else out).when(fits, F.lit(pick(tier)))
    return out


def approval_tier(amount: Column) -> Column:
    return _by_tier(amount, lambda t: t[3])


def response_hours(amount: Column) -> Column:
    return _by_tier(amount, lambda t: t[4])


def return_abuse(requests: DataFrame) -> DataFrame:
    """Customers with too many returns in six months or repeated products."""
    peak = (trailing_counts(requests, "customer_id", "requested_on", 6, "n6")
            .groupBy("customer_id").agg(F.max("n6").alias("max_returns_6m")))
    repeated = (requests.groupBy("customer_id", "product_id").agg(F.count("*").alias("n"))
                .groupBy("customer_id").agg(F.count_if(F.col("n") > 1).alias("repeated_products")))
    df = peak.join(repeated, "customer_id")
    return df.withColumn("red_flags", flags(
        (F.col("max_returns_6m") > config.RETURNS_IN_SIX_MONTHS, "many_returns"),
        (F.col("repeated_products") > 0, "repeated_product")))


def allocate_returns(returned: DataFrame, purchases: DataFrame, components: DataFrame) -> DataFrame:
    """Which purchase each returned unit comes from: returned rows (order_id, line_no) with
    source_order, source_set (null where the product was bought alone) and units.

    ``purchases`` is (order_id, customer_id, product_id, units, ordered_at), sets under their
    own ids, ``returned`` (order_id, line_no, customer_id, product_id, units, requested_on),
    ``components`` (set_id, product_id). A customer's units of a product are used up in the
    order they were bought (on one day those bought alone first), and only once they have been
    bought. Units without a purchase have a null source_order. Rows without customer, product,
    day or units above zero have no part in it.

    A return takes the units [used before, used after) of the running units bought. Used is
    the least of what was asked so far and what there was when it was asked:
    asked + min(0, least bought - asked until now), a running minimum. Both kinds of intervals are
    then cut at each other's edges in one pass, so no purchase is paired with a return it
    does not overlap. Purchases shrink to a row per customer, product, order and set first."""
    owned = purchases.where("units > 0 AND customer_id IS NOT NULL AND product_id IS NOT NULL AND ordered_at IS NOT NULL")
    own = owned.select("customer_id", "product_id", F.col("ordered_at").cast("date").alias("day"), F.lit(0).alias("kind"),
                       "order_id", F.lit(None).cast("bigint").alias("set_id"), "units")
    sets = components.select(F.col("set_id").alias("of_set"), F.col("product_id").alias("part"))
    parts = own.drop("set_id").withColumnRenamed("product_id", "of_set").join(sets, "of_set").select(
        "customer_id", F.col("part").alias("product_id"), "day", F.lit(1).alias("kind"), "order_id", F.col("of_set").cast("bigint").alias("set_id"), "units")
    bought = own.unionByName(parts).groupBy("customer_id", "product_id", "day", "kind", "order_id", "set_id").agg(F.sum("units").alias("units"))
    back = returned.where("units > 0 AND customer_id IS NOT NULL AND product_id IS NOT NULL AND requested_on IS NOT NULL")
    asked = back.select("customer_id", "product_id", F.col("requested_on").cast("date").alias("day"), F.lit(2).alias("kind"),
                        "order_id", F.lit(None).cast("bigint").alias("set_id"), F.col("units").cast("bigint").alias("units"), "line_no")
    # Only what is returned at all needs the purchases.
    keys = asked.select("customer_id", "product_id").distinct()
    events = bought.join(keys, ["customer_id", "product_id"], "left_semi").withColumn("line_no", F.lit(None).cast("bigint")).unionByName(
        asked.withColumn("line_no", F.col("line_no").cast("bigint")))

    so_far = (Window.partitionBy("customer_id", "product_id").orderBy("day", "kind", "order_id", F.col("set_id").asc_nulls_first(), "line_no")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    is_back = F.col("kind") == 2
    events = events.withColumns({"had": F.coalesce(F.sum(F.when(~is_back, F.col("units"))).over(so_far), F.lit(0)),
                                 "asked": F.coalesce(F.sum(F.when(is_back, F.col("units"))).over(so_far), F.lit(0))})
    short = F.least(F.lit(0), F.min(F.when(is_back, F.col("had") - F.col("asked"))).over(so_far))
    events = events.withColumn("used", F.when(is_back, F.col("asked") + short))
    before = F.coalesce(F.max("used").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    events = events.withColumns({"first": F.when(is_back, before).otherwise(F.col("had") - F.col("units")),
                                 "past": F.when(is_back, F.col("used")).otherwise(F.col("had"))})

    missing = events.where(is_back & (F.col("past") - F.col("first") < F.col("units"))).select(
        "customer_id", "product_id", "order_id", "line_no", F.lit(None).cast("bigint").alias("source_order"), F.lit(None).cast("bigint").alias("source_set"),
        (F.col("units") - (F.col("past") - F.col("first"))).alias("units"))
    edges = events.where("past > first").select(
        "customer_id", "product_id", "first", F.when(is_back, F.struct("order_id", "line_no", "past")).alias("back"),
        F.when(~is_back, F.struct("order_id", "set_id", "past")).alias("buy"))
    by_place = Window.partitionBy("customer_id", "product_id").orderBy("first")
    # At one place both kinds may begin: what begins there holds from there on.
    spots = edges.groupBy("customer_id", "product_id", "first").agg(F.max("back").alias("back"), F.max("buy").alias("buy"))
    spots = spots.withColumns({"back": F.last("back", True).over(by_place), "buy": F.last("buy", True).over(by_place),
                               "next": F.lead("first").over(by_place)})
    end = F.least("next", "back.past", "buy.past")  # nulls do not count
    pieces = spots.where(F.col("back").isNotNull() & F.col("buy").isNotNull()).withColumn("units", end - F.col("first")).where("units > 0")
    taken = pieces.groupBy("customer_id", "product_id", "back.order_id", "back.line_no", F.col("buy.order_id").alias("source_order"),
                           F.col("buy.set_id").alias("source_set")).agg(F.sum("units").alias("units"))
    return taken.unionByName(missing)


def bundle_returns(returned: DataFrame, purchases: DataFrame, components: DataFrame, products: DataFrame) -> DataFrame:
    """Returned parts per set bought: whole sets brought back refund the set's
    price, other parts their own price if they are sold separately; parts that are
    not are refused. ``components`` is (set_id, product_id, sold_separately). Parts bought alone
    belong to no set. One row per set purchase with a returned part."""
    units = allocate_returns(returned, purchases, components).where("source_set IS NOT NULL")
    came = units.groupBy("customer_id", F.col("source_order").alias("order_id"), F.col("source_set").alias("set_id"), "product_id").agg(F.sum("units").alias("units"))
    price = products.select("product_id", "price")
    size = components.groupBy("set_id").agg(F.count("*").alias("n_components"))
    bought = purchases.groupBy("customer_id", "order_id", F.col("product_id").alias("set_id")).agg(F.sum("units").alias("sets_bought"))
    key = ["customer_id", "order_id", "set_id"]
    sets = came.groupBy(*key).agg(F.count("*").alias("n_returned"), F.min("units").alias("least")).join(size, "set_id")
    sets = sets.withColumn("full_sets", F.when(F.col("n_returned") == F.col("n_components"), F.col("least")).otherwise(0)).drop("least")
    rest = came.join(sets.select(*key, "full_sets"), key).join(components, ["set_id", "product_id"]).join(price, "product_id")
    over = F.col("units") - F.col("full_sets")
    apart = F.col("sold_separately")
    rest = rest.groupBy(*key).agg(
        F.sum("units").alias("returned_units"), F.sum(F.when(apart, over).otherwise(0)).alias("single_units"), F.sum(F.when(~apart, over).otherwise(0)).alias("refused_units"),
        F.sum(F.when(apart, over * F.col("price")).otherwise(0.0)).alias("singles_value"))
    set_price = price.select(F.col("product_id").alias("set_id"), F.col("price").alias("set_price"))
    df = sets.join(rest, key).join(bought, key).join(set_price, "set_id")
    return df.select(*key, "sets_bought", "n_components", "n_returned", "full_sets", "returned_units", "single_units", "refused_units",
                     (F.col("full_sets") * F.col("set_price") + F.col("singles_value")).alias("refund_value"))


def _with_product(requests: DataFrame, products: DataFrame, *columns: str) -> DataFrame:
    """Every request with its product's columns; ``unknown_product`` where there is none. Products are
    shuffled: of a table that compresses well Spark takes the files' size for that of the rows, and would
    send millions of them through the driver."""
    known = products.select("product_id", *columns, F.lit(True).alias("_known")).hint("merge")
    df = requests.join(known, "product_id", "left")
    return df.withColumn("unknown_product", F.col("_known").isNull()).drop("_known")


def discontinued_resolution(requests: DataFrame, products: DataFrame) -> DataFrame:
    gone = F.coalesce("discontinued", F.lit(False))
    return _with_product(requests, products, "discontinued").select(
        "order_id", "line_no", "product_id", "amount",
        F.when(F.col("unknown_product"), "check_product").when(gone, "refund_only").otherwise("refund_or_replacement").alias("resolution"),
        F.when(gone, F.col("amount") * config.DISCONTINUED_CREDIT_RATE).otherwise(0.0).alias("keep_credit"), "unknown_product")


def disposition(condition: Column) -> Column:
    return (F.when(condition == "unopened", "restock").when(condition == "damaged", "carrier_flag")
            .otherwise("write_off"))


def inventory_disposition(requests: DataFrame) -> DataFrame:
    return (requests.groupBy(disposition(F.col("item_condition")).alias("disposition"))
            .agg(F.count("*").alias("n_items"), F.sum("amount").alias("total_amount")))


def return_costs(requests: DataFrame, products: DataFrame) -> DataFrame:
    return _with_product(requests, products, "margin_pct").select(
        "order_id", "line_no", "product_id", (F.col("amount") * config.RETURN_COST_RATE).alias("return_cost"),
        F.coalesce(F.col("margin_pct") > config.HIGH_MARGIN_PCT, F.lit(False)).alias("prefer_replacement"), "unknown_product")


def monthly_return_rates(lines: DataFrame) -> DataFrame:
    month = F.trunc("order_date", "month").alias("month")
    orders = (lines.groupBy("product_id", month, "order_id")
              .agg(F.max(F.col("returned").cast("int")).alias("r")))
    df = orders.groupBy("month", "product_id").agg(F.count("*").alias("orders"), F.sum("r").alias("returned_orders"))
    return (df.withColumn("return_rate", ratio(F.col("returned_orders"), F.col("orders")))
            .withColumn("over_target", F.col("return_rate") >= config.MONTHLY_RETURN_TARGET))


def decide(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Decision with the ids and inputs of the rules that decided it. Needs the
    columns of ``return_window``. Every request is decided, also one whose
    product is not in the catalogue.

    An adverse reaction overrides every other rule. A denied request has no
    refund form and no approval. A discontinued product is never replaced. What
    only a VIP gets (refund of opened items, days beyond the standard window) is
    at a manager's discretion, whatever the amount."""
    cond, vip, rule = F.col("item_condition"), F.col("is_vip"), F.col("window_rule")
    adverse = cond == "adverse_reaction"
    df = _with_product(requests, products, "discontinued")
    gone = F.coalesce("discontinued", F.lit(False)) & (cond == "damaged")
    df = df.withColumns({"approved": adverse | F.col("eligible"), "plain": F.col("eligible") & ~adverse})
    opened = F.col("plain") & (cond == "opened")
    late = F.col("plain") & (rule == "vip") & (F.col("days_used") > config.RETURN_WINDOW_DAYS)
    discretion = (opened & vip) | late
    tier = approval_tier(F.col("amount"))
    df = df.withColumns({
        "decision": F.when(F.col("approved"), "approve").otherwise("deny"),
        "refund_form": F.when(F.col("approved"), F.when(gone, "refund_only").otherwise(refund_form(cond, vip))),
        "approval": F.when(F.col("approved"), F.when(adverse, "auto").when(discretion & (tier == "auto"), "manager").otherwise(tier)),
    })
    fired = flags(
        (adverse, "adverse_override"),
        (F.col("plain"), "inside_window"),
        (~F.col("approved"), "outside_window"),
        (~adverse & (rule == "holiday"), "holiday_window"),
        (~adverse & (rule == "vip"), "vip_window"),
        (opened & vip, "vip_opened_refund"),
        (opened & ~vip, "opened_store_credit"),
        (F.col("plain") & (cond == "damaged") & ~gone, "damage_sop"),
        (F.col("plain") & gone, "discontinued_refund_only"),
        (discretion, "manager_discretion"),
        (F.col("approval") == "manager", "manager_approval"),
        (F.col("approval") == "director", "director_approval"),
        (F.col("unknown_product"), "unknown_product"))
    inputs = F.to_json(F.struct("days_used", "item_condition", "is_vip", "window_rule"))
    return df.select("order_id", "line_no", "product_id", "customer_id", "decision", "refund_form", "approval",
                     fired.alias("rules"), inputs.alias("inputs"))


def request_text(condition: Column, line: Column, discontinued: Column, rule: Column, decision: Column, form: Column) -> Column:
    """What is asked of the corpus for a request, from its facts."""
    plain = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    return F.concat_ws(" ", plain(condition), F.lit("return of"), F.when(discontinued, "discontinued"),
                       F.coalesce(F.lower(line), F.lit("unknown")), F.lit("product"), plain(rule), F.lit("window"),
                       decision, F.coalesce(plain(form), F.lit("no refund")))


def evidence_pack(decisions: DataFrame, products: DataFrame, customers: DataFrame, orders: DataFrame,
                  retrieve: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """Each decision (as from ``decide``) with its table facts and the corpus rows
    nearest to it: structs ``product``, ``customer``, ``order`` (null where unknown),
    ``request_text`` and ``evidence``, by rank.

    ``products`` is (product_id, name, category, price, stock_level, discontinued),
    ``customers`` (customer_id, state, total_orders), ``orders`` (order_id, order_value, carrier,
    ordered_at, delivered_on). ``retrieve`` gets (query_id, text), one row per distinct text, and
    returns hits with query_id, rank, ``key``, distance, source and text_preview; so
    requests that ask the same are looked up once, and the hits joined back."""
    def facts(table, of, name):
        rest = [c for c in table.columns if c != of]
        return table.select(of, F.struct(*rest).alias(name)).hint("merge")

    asked = F.from_json("inputs", "item_condition STRING, window_rule STRING")
    df = (decisions.join(facts(products, "product_id", "product"), "product_id", "left")
          .join(facts(customers, "customer_id", "customer"), "customer_id", "left")
          .join(facts(orders, "order_id", "order"), "order_id", "left")
          .withColumn("_asked", asked))
    line = F.element_at(F.split("product.category", " "), 1)
    df = df.withColumn("request_text", request_text(F.col("_asked.item_condition"), line, F.col("product.discontinued"),
                                                    F.col("_asked.window_rule"), F.col("decision"), F.col("refund_form"))).drop("_asked")
    df = materialise(df.withColumn("query_id", F.sha2("request_text", 256)), "requests")
    hits = retrieve(df.select("query_id", F.col("request_text").alias("text")).distinct())
    best = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(
        F.struct("rank", F.col(key).alias("id"), "distance", "source", "text_preview"))).alias("evidence"))
    return df.join(best, "query_id", "left").drop("query_id")
