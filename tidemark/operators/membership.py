"""A membership filter of fixed size: hashed bitmaps of keys that rule rows out before a shuffle.

The keys are hashed to bit positions and gathered in bitmaps of 32,768 bits each, with map-side partial bitmaps. A row whose
bit is unset has no partner; one whose bit is set may have one. The bitmaps are broadcast: their number follows from
``bits``, whatever the number of keys. With very many keys most bits are set, and the filter keeps nearly all rows: it saves
less then, but never loses a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bits of a filter: 2 MB of bitmaps.
BITS = 1 << 24


def _position(keys: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def bitmaps(keys: DataFrame, *columns: Column, bits: int = BITS) -> DataFrame:
    """(bucket, members): at most ``bits / 32768`` rows of 4 KB."""
    at = _position(list(columns), bits)
    return (keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("members")))


def frequent(rows: DataFrame, *columns: Column, limit: int, bits: int = BITS) -> DataFrame:
    """The same bitmaps, of the positions that more than ``limit`` rows share: all keys of more rows are among them."""
    at = _position(list(columns), bits)
    crowded = rows.select(at.alias("at")).groupBy("at").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    return (crowded.select(F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at").alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("members")))


def bits_for(keys: int) -> int:
    """Bits of a filter of so many keys: eight for each, and 1 to 16 MB of bitmaps in all."""
    return 1 << min(27, max(23, (8 * keys - 1).bit_length()))


def in_words(members: DataFrame) -> DataFrame:
    """The bitmaps as words of 32 bits, for filters that very many rows are held against: a bit is then looked up without a text between."""
    start = F.sequence(F.lit(1), F.lit(4093), F.lit(4))
    word = F.transform(start, lambda i: F.conv(F.hex(F.substring(F.col("members"), i, F.lit(4))), 16, 10).cast("long"))
    return members.select("bucket", word.alias("members"))


def may_match(rows: DataFrame, members: DataFrame, *columns: Column, bits: int = BITS, flag: str = "_may_match") -> DataFrame:
    """The rows with a boolean column: FALSE where no key of the filter equals theirs."""
    at = _position(list(columns), bits)
    bit = F.bitmap_bit_position(at)
    if isinstance(members.schema["members"].dataType, T.ArrayType):
        # a word's first byte is its highest, and a byte's first bit its lowest
        word = F.get(F.col("_members"), F.shiftright(bit, 5).cast("int"))
        one = F.getbit(word, (bit % 32).bitwiseXOR(F.lit(24)).cast("int"))
    else:
        byte = F.conv(F.hex(F.substring(F.col("_members"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        one = F.getbit(byte, (bit % 8).cast("int"))
    small = F.broadcast(members.select(F.col("bucket").alias("_bucket_of"), F.col("members").alias("_members")))
    joined = rows.join(small, F.bitmap_bucket_number(at) == F.col("_bucket_of"), "left")
    held = F.coalesce(one == 1, F.lit(False))
    return joined.select(*[rows[f"`{c.replace('`', '``')}`"] for c in rows.columns], held.alias(flag))
