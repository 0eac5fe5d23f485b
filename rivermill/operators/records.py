"""Moving whole rows between row types and into message text."""

from pyspark.sql import DataFrame, functions as F, types as T


def to_message(df: DataFrame, topic: str) -> DataFrame:
    """(topic, key, value) with the row as JSON; null fields are left out."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def copy_matching(src: DataFrame, target: T.StructType) -> DataFrame:
    """Target row type filled from the source columns of the same name and type.

    Other source columns are dropped; other target columns hold the type's default
    (0 for numbers, NULL for text).
    """
    have = {f.name: f.dataType for f in src.schema}

    def cell(field):
        if have.get(field.name) == field.dataType:
            return F.col(field.name)
        default = None if isinstance(field.dataType, T.StringType) else 0
        return F.lit(default).cast(field.dataType).alias(field.name)

    return src.select(*[cell(f) for f in target])
