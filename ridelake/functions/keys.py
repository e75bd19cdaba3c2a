"""Hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.rules import NULL_KEY_TOKEN, UNKNOWN_STATION_ID


def surrogate_key(*columns: Column) -> Column:
    """MD5 of the values as text, joined by '-', with a token for null."""
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def instant_text(at: Column) -> Column:
    """A UTC instant as the warehouse prints it: no, three or six decimals, then +00."""
    micros = F.pmod(F.unix_micros(at), F.lit(1_000_000))
    text = (
        F.when(micros == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(micros % 1000 == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return F.concat(text, F.lit("+00"))


def unknown_station_key() -> Column:
    return surrogate_key(F.lit(UNKNOWN_STATION_ID))
