"""The two wide tables as whole plans."""

from pyspark.sql import Column, DataFrame

from rivermill import schemas as S
from rivermill.functions.scalars import create_parts, time_parts
from rivermill.operators import dau, dims, orders
from rivermill.operators.records import copy_matching


def dau_dims(
    visits: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | None = None,
    on_missing: str = "null",
    salt: int = 1,
) -> DataFrame:
    """First visits -> DAU_INFO."""
    rows = copy_matching(visits, S.DAU_INFO)
    rows = dims.with_user_dim(rows, users, as_of=as_of, on_missing=on_missing, salt=salt)
    rows = dims.with_province_dim(
        rows, provinces, names="dau", on_missing=on_missing, salt=salt
    )
    return time_parts(rows).select(*S.DAU_INFO.names)


def dau_wide(
    page_log: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | None = None,
    on_missing: str = "null",
) -> DataFrame:
    """Page log -> DAU_INFO, one row per device and day."""
    visits = dau.daily_first_visit(dau.first_pages(page_log))
    return dau_dims(visits, users, provinces, as_of, on_missing)


def order_dims(
    rows: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | None = None,
    on_missing: str = "null",
    salt: int = 1,
) -> DataFrame:
    """Fill the user and province columns of headers or wide rows."""
    filled = dims.with_user_dim(
        rows, users, as_of=as_of, on_missing=on_missing, age_type="int", salt=salt
    )
    return dims.with_province_dim(
        filled, provinces, names="order", on_missing=on_missing, salt=salt
    ).select(*rows.columns)


def order_wide(
    info: DataFrame,
    detail: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | None = None,
    retention: str = "24 hours",
    on_missing: str = "null",
) -> DataFrame:
    """Headers and lines -> ORDER_WIDE. Headers, the smaller side, get the dimensions."""
    headers = order_dims(create_parts(info), users, provinces, as_of, on_missing)
    return orders.merge_order_wide(orders.order_wide_join(headers, detail, retention))
