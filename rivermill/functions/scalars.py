"""Date and age columns."""

from pyspark.sql import Column, DataFrame, functions as F


def age_years(birthday: Column | str, as_of: Column | None = None) -> Column:
    """Whole years between two dates, counted in months with a day correction.

    `months_between / 12` differs for 29 February and for future birthdays.
    """
    born = (F.col(birthday) if isinstance(birthday, str) else birthday).try_cast("date")
    now = F.current_date() if as_of is None else as_of
    months = (F.year(now) - F.year(born)) * 12 + F.month(now) - F.month(born)
    days = F.dayofmonth(now) - F.dayofmonth(born)
    whole = (
        months
        - F.when((months > 0) & (days < 0), 1).otherwise(0)
        + F.when((months < 0) & (days > 0), 1).otherwise(0)
    )
    # Casting to int truncates toward zero for both signs.
    return (whole / 12).cast("int")


def day_of(ts: Column | str) -> Column:
    """Epoch millis -> 'yyyy-MM-dd' in the session time zone."""
    return F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd")


def time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add dt ('yyyy-MM-dd') and hr (two digits) of an epoch-millis column."""
    return df.withColumns(
        {"dt": day_of(ts), "hr": F.date_format(F.timestamp_millis(ts), "HH")}
    )


def create_parts(df: DataFrame) -> DataFrame:
    """Add create_date and create_hour, cut out of create_time's text."""
    part = lambda text, mark, n: F.split_part(text, F.lit(mark), F.lit(n))
    created = F.col("create_time")
    return df.withColumns(
        {
            "create_date": part(created, " ", 1),
            "create_hour": part(part(created, " ", 2), ":", 1),
        }
    )
