"""Projections applied on the way out of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.types import resolve, to_text


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip blanks from both ends of every text column."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.trim(n) for n in names})


def _secret(df: DataFrame, key: bytes) -> Column:
    """The key as a subquery over a table of one row: no plan, and so no log of plans, shows its bytes."""
    return df.sparkSession.createDataFrame([(bytearray(key),)], "secret binary").scalar()


def encrypt(df: DataFrame, columns: list[str], key: bytes) -> DataFrame:
    """Encrypt columns (AES-GCM, base64 text). The key comes from the caller only.

    The initial vector is a keyed hash of the value. Equal values of a column so have equal texts: an unchanged row
    stays unchanged for history loads, and an encrypted key column still finds its rows. What this gives away is which
    rows hold the same value.
    """
    names, secret = resolve(columns, df.columns), _secret(df, key)

    def sealed(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        inner = F.sha2(F.concat(secret, F.lit(name.lower()).cast("binary"), value.cast("binary")), 256)
        vector = F.substring(F.unhex(F.sha2(F.concat(secret, F.unhex(inner)), 256)), 1, 12)
        return F.base64(F.aes_encrypt(value, secret, F.lit("GCM"), F.lit("DEFAULT"), vector))

    return df.withColumns({n: sealed(n) for n in names})


def decrypt(df: DataFrame, columns: list[str], key: bytes) -> DataFrame:
    names, secret = resolve(columns, df.columns), _secret(df, key)
    return df.withColumns({n: F.aes_decrypt(F.unbase64(n), secret).cast("string") for n in names})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as staged text, names kept."""
    return df.select([to_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def numbered_text(df: DataFrame) -> DataFrame:
    """Every column of a custom query as text, named COLUMN_1, COLUMN_2, ..."""
    return df.toDF(*[f"COLUMN_{i}" for i in range(1, len(df.columns) + 1)]).transform(as_text)


def quoted(df: DataFrame) -> DataFrame:
    """Every value in double quotes, quotes inside doubled, NULL as an empty pair."""
    text = as_text(df)
    return text.select([
        F.concat(F.lit('"'), F.replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit('"'), F.lit('""')),
                 F.lit('"')).alias(c)
        for c in text.columns])
