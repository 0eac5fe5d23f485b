"""User and province lookups as joins.

No broadcast hints: a dimension is broadcast when Catalyst's size estimate is below
`spark.sql.autoBroadcastJoinThreshold` and sort-merge joined otherwise. Rows of a hot
or missing key then share one partition; in batch, adaptive execution splits it. A
stateful stream runs without adaptive execution, so its jobs pass `salt`.
"""

from pyspark.sql import Column, DataFrame, functions as F

from rivermill.functions.keyed import every_salt, salt_of
from rivermill.functions.scalars import age_years

# Province attribute -> column, per wide table.
PROVINCE_NAMES = {
    "dau": {
        "name": "province_name",
        "iso_code": "province_iso_code",
        "iso_3166_2": "province_3166_2",
        "area_code": "province_area_code",
    },
    "order": {
        "name": "province_name",
        "area_code": "province_area_code",
        "iso_3166_2": "province_3166_2_code",
        "iso_code": "province_iso_code",
    },
}


def _lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    added: dict[str, Column],
    on_missing: str,
    salt: int,
) -> DataFrame:
    """Add columns from the dimension row whose id equals `key`."""
    if on_missing not in ("null", "drop", "fail"):
        raise ValueError(f"on_missing must be 'null', 'drop' or 'fail', not {on_missing!r}")
    key_type = df.schema[key].dataType
    side = dim.select(
        F.col("id").try_cast(key_type).alias("dim_id"),
        *[c.alias(f"dim_{name}") for name, c in added.items()],
    )
    on = F.col(key) == F.col("dim_id")
    left = df
    if salt > 1:
        left = df.withColumn("row_salt", salt_of(df.columns, salt))
        side = every_salt(side, salt, "dim_salt")
        on = on & (F.col("row_salt") == F.col("dim_salt"))
    joined = left.join(side, on, "inner" if on_missing == "drop" else "left")

    def value(name):
        found = F.col(f"dim_{name}")
        if on_missing == "fail":
            missing = F.raise_error(
                F.concat(F.lit(f"no dimension row for {key} "), F.col(key).cast("string"))
            )
            found = F.when(F.col("dim_id").isNull(), missing).otherwise(found)
        return found.alias(name)

    kept = [c for c in df.columns if c not in added]
    return joined.select(*kept, *[value(name) for name in added])


def with_user_dim(
    df: DataFrame,
    users: DataFrame,
    key: str = "user_id",
    as_of: Column | None = None,
    on_missing: str = "null",
    age_type: str = "string",
    salt: int = 1,
) -> DataFrame:
    """Add user_gender and user_age (years at `as_of`, today by default)."""
    added = {
        "user_gender": F.col("gender"),
        "user_age": age_years("birthday", as_of).cast(age_type),
    }
    return _lookup(df, users, key, added, on_missing, salt)


def with_province_dim(
    df: DataFrame,
    provinces: DataFrame,
    key: str = "province_id",
    names: str = "dau",
    on_missing: str = "null",
    salt: int = 1,
) -> DataFrame:
    """Add the province's name and codes under the wide table's column names."""
    added = {name: F.col(attr) for attr, name in PROVINCE_NAMES[names].items()}
    return _lookup(df, provinces, key, added, on_missing, salt)
