"""Repurchase frequency: how many customers ordered how often in a window."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from odsflow.functions.scalars import day_range, platform_class, shop_flag, typed_range, zero_if_null
from odsflow.operators.skew import split_join
from odsflow.sizing import task_parts

# Labels of rows that cover every department or shop kind.
ALL_DEPARTMENTS = "rbz"
ALL_SHOPS = "zy+pt"


# The columns of the clean detail, in order.
LINE_COLUMNS = (
    "parent_id", "order_id", "cust_id", "cust_type", "order_type", "allot_quantity", "bargin_price",
    "receiver_country_id", "receiver_province_id", "receiver_city_id", "shop_id", "order_source", "from_platform",
    "product_id",
)
PRODUCT_COLUMNS = ("category_path", "category_path2", "path2_name", "category_path3", "path3_name")
LAST_COLUMNS = ("order_status", "order_creation_date", "send_date", "bd_id")


def clean_detail(
    detail: DataFrame, product: DataFrame, start: str, end: str, sampled: DataFrame | None = None
) -> DataFrame:
    """Distinct order lines of the range with their product's categories.

    Lines and products are each made distinct before they meet, so no product
    text goes through the lines' shuffle and no pair comes twice. Lines whose product
    has no department are left out, so only products with one are joined; a
    product with very many lines does not end in one task. ``sampled`` holds
    ``product_id`` as the lines' base table has it, to find such products
    without running the query behind ``detail``.
    """
    mapped = {
        "allot_quantity": zero_if_null(F.col("allot_quantity")),
        "bargin_price": zero_if_null(F.col("bargin_price")),
        "shop_id": shop_flag(F.col("shop_id")),
        "from_platform": platform_class(F.col("from_platform")),
    }
    kept = [c for c in (*LINE_COLUMNS, *LAST_COLUMNS) if c != "bd_id"]
    in_range = detail.where(typed_range(detail, "data_date", start, end))
    lines = in_range.select(*[mapped.get(c, F.col(c)).alias(c) for c in kept]).distinct()
    placed = product.where(F.col("bd_id").isNotNull()).select("product_id", *PRODUCT_COLUMNS, "bd_id").distinct()
    joined = split_join(lines, placed, "product_id", sampled=sampled)
    return joined.select(*LINE_COLUMNS, *PRODUCT_COLUMNS, *LAST_COLUMNS)


def order_info(clean: DataFrame, start: str, end: str, bds: Sequence[int]) -> DataFrame:
    """Per customer, department and shop kind: orders and amount sent in the window.

    Counted in two steps, first one row per order, so a customer with very many
    lines is reduced before each shuffle.
    """
    sent = clean.where(day_range(F.col("send_date"), start, end) & F.col("bd_id").isin(*bds))
    by = ["cust_id", "bd_id", "shop_id"]
    per_order = sent.groupBy(*by, "parent_id").agg(
        F.sum(F.col("allot_quantity") * F.col("bargin_price")).alias("amt")
    )
    return per_order.groupBy(*by).agg(
        F.sum("amt").alias("ck_amt"), F.count("parent_id").alias("ck_parent_id")
    )


def distribution(
    info: DataFrame, all_bd: str = ALL_DEPARTMENTS, all_shop: str = ALL_SHOPS, parts: int | None = None
) -> DataFrame:
    """Customers and amount per order count, for each department and shop kind
    and for all of either.

    The "all" rows regroup the per-customer counts, they do not recount orders.
    A customer has one ``info`` row per department and shop kind, so placing
    them by customer is even; the four groupings then count customers without
    moving the rows again. ``parts`` is the number of partitions they are placed
    in, as ``task_parts`` gives it; without it the session's settings decide.
    """
    bd, shop = F.col("bd_id").cast("string"), F.col("shop_id").cast("string")
    groups = F.array(
        *[
            F.struct(b.alias("bd_id"), s.alias("shop_id"))
            for b, s in (
                (bd, shop), (bd, F.lit(all_shop)), (F.lit(all_bd), shop), (F.lit(all_bd), F.lit(all_shop)),
            )
        ]
    )
    by_customer = info.repartition(*([parts] if parts else []), "cust_id")
    placed = by_customer.select("cust_id", "ck_parent_id", "ck_amt", F.inline(groups))
    per_customer = placed.groupBy("bd_id", "shop_id", "ck_parent_id", "cust_id").agg(
        F.sum("ck_amt").alias("amt")
    )
    return per_customer.groupBy("bd_id", "shop_id", "ck_parent_id").agg(
        F.count("cust_id").alias("ck_custnum"), F.sum("amt").alias("ck_amt")
    )


def repurchase(
    detail: DataFrame,
    product: DataFrame,
    detail_range: tuple[str, str],
    window: tuple[str, str],
    bds: Sequence[int],
    sampled: DataFrame | None = None,
) -> DataFrame:
    clean = clean_detail(detail, product, *detail_range, sampled=sampled)
    # There are at most as many orders as lines; a stored table counts by its footers.
    parts = task_parts(detail.sparkSession, (detail if sampled is None else sampled).count())
    return distribution(order_info(clean, *window, bds), parts=parts)


def repurchase_job(
    detail: DataFrame,
    product: DataFrame,
    detail_range: tuple[str, str],
    windows: Mapping[str, tuple[str, str]],
    bds: Sequence[int],
    root: str,
    sampled: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The whole analysis as stored steps: the clean detail once, then each window's counts and distribution.

    Every step is written to a new folder under ``root`` and read by those that
    follow; the first that fails ends the job. Returns the steps by name:
    ``clean``, and ``<window>_info`` and ``<window>`` for each window.
    """
    spark, steps = detail.sparkSession, {}

    def store(name: str, rows: DataFrame) -> DataFrame:
        folder = f"{root}/{name}/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        steps[name] = spark.read.schema(rows.schema).parquet(folder)
        return steps[name]

    clean = store("clean", clean_detail(detail, product, *detail_range, sampled=sampled))
    for name, window in windows.items():
        info = store(f"{name}_info", order_info(clean, *window, bds))
        store(name, distribution(info, parts=task_parts(spark, info.count())))
    return steps
