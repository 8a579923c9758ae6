"""Loads that move narrow rows first: keys and digests are joined, and wide rows only where something changes.

A target that keeps a digest of its compared columns beside each row is matched to the work rows by key and digest alone.
What comes out, the keys and digests of rows that end and the keys that begin, is made into membership filters of fixed
size; wide rows that a filter rules out go around the second join by union, without a shuffle. So what is shuffled follows
the number of keys and of changes, not the width of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.digests import row_digest
from tidemark.functions.predicates import all_of
from tidemark.functions.types import resolve, split_keys
from tidemark.operators.membership import BITS, bitmaps, may_match
from tidemark.operators.merge import align, new_versions, upsert_pass
from tidemark.session import workspace

DIGEST = "row_digest"


def with_digest(rows: DataFrame, compare: list[str], null_safe: bool = False) -> DataFrame:
    """The rows with the digest of their compared columns as ``row_digest``."""
    return rows.withColumn(DIGEST, row_digest(rows, compare, null_safe))


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = workspace(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _whole(keys: list[str]) -> Column:
    return all_of([F.col(k).isNotNull() for k in keys])


def _parted(rows: DataFrame, found: DataFrame, on: list[str], bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows that ``found`` holds, rows that it may hold and does not, rows that a filter rules out). ``found`` is distinct."""
    members = _written(bitmaps(found, *[F.col(c) for c in on], bits=bits), "narrow-members")
    flagged = may_match(rows, members, *[F.col(c) for c in on], bits=bits)
    possible = flagged.where("_may_match").drop("_may_match")
    marked = possible.join(found.withColumn("_found", F.lit(True)), on, "left")
    return (marked.where("_found").select(*rows.columns), marked.where("_found IS NULL").select(*rows.columns),
            flagged.where("not _may_match").drop("_may_match"))


def scd2_digest(target: DataFrame, work: DataFrame, keys: list[str], run_ts, compare: list[str] | None = None,
                null_safe: bool = False, bits: int = BITS) -> DataFrame:
    """SCD2 on a target with ``row_digest``: the result of ``merge.scd2`` with the digest kept for all its rows.

    ``compare`` and ``null_safe`` have to be those the target's digests were made with. Several current rows of a
    key are each compared on their own; NULL keys match nothing.
    """
    plain = target.drop(DIGEST)
    keys, values = split_keys(plain.columns, keys)
    compare = resolve(compare, values) if compare is not None else values
    work = with_digest(align(work, plain), compare, null_safe)
    is_current = F.coalesce("is_current", F.lit(False))
    current, closed = target.where(is_current), target.where(~is_current)
    ours = work.where(_whole(keys)).select(*keys, F.col(DIGEST).alias("_new"))
    theirs = current.where(_whole(keys)).select(*keys, DIGEST)
    met = _written(ours.join(theirs, keys, "left"), "narrow-met")  # keys and digests only
    ended = _written(met.where(F.col(DIGEST) != F.col("_new")).select(*keys, DIGEST).distinct(), "narrow-ended")
    state = met.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col(DIGEST) == F.col("_new")), F.lit(False)).alias("_stays"))
    begun = _written(state.where("not _stays").select(*keys), "narrow-begun")

    gone, near, far = _parted(current, ended, [*keys, DIGEST], bits)
    gone = gone.withColumns({"is_current": F.lit(False), "eff_end_date": F.lit(run_ts).cast("timestamp_ntz")})
    fresh, _, _ = _parted(work.where(_whole(keys)), begun, keys, bits)
    fresh = fresh.unionByName(work.where(~_whole(keys)))  # a NULL key is always a new one
    parts = [closed, far, near, gone, new_versions(fresh, run_ts)]
    out = parts[0].select(*target.columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*target.columns))
    return out


def upsert_filtered(target: DataFrame, work: DataFrame, keys: list[str], bits: int = BITS) -> DataFrame:
    """SCD1 by ``merge.upsert_pass``, with target rows whose key cannot be among the work rows sent around its join.

    The target is read twice and shuffled only where it may match. Worth it where the work rows are too many for a broadcast
    and yet few beside the target; the result is the same in any case.
    """
    keys, _ = split_keys(target.columns, keys)
    names = resolve(keys, work.columns)
    found = work.select(*[F.col(n).cast(target.schema[k].dataType).alias(k) for k, n in zip(keys, names)]).where(_whole(keys))
    members = _written(bitmaps(found, *[F.col(k) for k in keys], bits=bits), "upsert-members")
    flagged = may_match(target, members, *[F.col(k) for k in keys], bits=bits)
    possible = flagged.where(F.col("_may_match") & _whole(keys)).select(*target.columns)
    around = flagged.where(~(F.col("_may_match") & _whole(keys))).select(*target.columns)
    return upsert_pass(possible, work, keys).drop("_state").unionByName(around)
