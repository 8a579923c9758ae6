"""Versioned target tables on plain parquet.

A target is a folder. Every load writes new data folders and then one small manifest
listing the folders that make up the new version; a version exists once Spark's ``_SUCCESS``
marker is in its manifest folder. Readers never see half a load, a load that dies leaves
the target as it was, and a retry starts clean. Old versions stay until ``clean_up``.

Rows are placed by slice and by kind: closed history rows apart from current ones. A slice is a hash of the
key (``slices`` in all) or, with a partition column, a month of that date and a hash within it; the partition
column must be part of the key, so that a row's place never changes. A load rewrites only the slices its work
rows touch, and never reads or rewrites closed history; changes of one month leave all other months alone.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark import fs
from tidemark.functions.predicates import all_of
from tidemark.functions.types import HISTORY_FIELDS, data_columns, has_history, resolve, with_history
from tidemark.operators import membership, merge
from tidemark.session import workspace

_MANIFEST = pa.schema([("kind", pa.string()), ("slice", pa.int32()), ("folder", pa.string()), ("schema", pa.string()),
                       ("keys", pa.string()), ("slices", pa.int32()), ("partition", pa.string()),
                       ("applied", pa.string())])
# A slice that lies in more folders than this is written as one folder again by ``compact``.
MOST_FOLDERS = 8
# A history load of which there are so many times as many live rows moves only the live rows that it may match.
FEW = 2


def add_to_ranges(ranges: list[list[int]], numbers: list[int]) -> list[list[int]]:
    """A set of whole numbers as sorted closed ranges, with some more numbers."""
    out: list[list[int]] = []
    for low, high in sorted([*ranges, *[[n, n] for n in numbers]]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


class Segment(NamedTuple):
    """One live data folder: ``live`` rows or ``closed`` history rows of one slice."""

    kind: str
    slice: int
    folder: str


class LoadCounts(NamedTuple):
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_expired: int = 0


class Token(NamedTuple):
    """Batches of a source that a version takes in, and sources whose batches need not be known any more."""

    source: str
    batches: tuple[int, ...]
    forget: tuple[str, ...] = ()


class Target:
    """One target table. There may be one writer at a time, and any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- versions ---------------------------------------------------------------------

    def _found(self) -> list[int]:
        """Versions that were begun, oldest first."""
        return sorted(int(n[2:]) for n in fs.children(self.spark, f"{self.root}/_manifest") if n.startswith("v="))

    def _complete_version(self, version: int) -> bool:
        return fs.exists(self.spark, f"{self.root}/_manifest/v={version}/_SUCCESS")

    def versions(self) -> list[int]:
        return [v for v in self._found() if self._complete_version(v)]

    def latest(self) -> int | None:
        """The current version; looks at the newest first and stops."""
        return next((v for v in reversed(self._found()) if self._complete_version(v)), None)

    def exists(self) -> bool:
        return self.latest() is not None

    def _load(self, version: int | None = None) -> dict:
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no target at {self.root}")
        rows = self.spark.read.schema(
            from_arrow_schema(_MANIFEST)).parquet(f"{self.root}/_manifest/v={version}").collect()
        head = next(r for r in rows if r["schema"])  # one row carries what all have in common
        return {
            "version": version,
            "schema": T.StructType.fromJson(json.loads(head["schema"])),
            "keys": json.loads(head["keys"]),
            "slices": head["slices"],
            "partition": head["partition"],
            "applied": json.loads(head["applied"]),
            "segments": [Segment(r["kind"], r["slice"], r["folder"]) for r in rows if r["folder"]],
        }

    def _commit(self, state: dict, segments: list[Segment], token: Token | None = None) -> int:
        version = state["version"] + 1
        folder = f"{self.root}/_manifest/v={version}"
        if fs.exists(self.spark, folder) and not fs.exists(self.spark, f"{folder}/_SUCCESS"):
            fs.remove(self.spark, folder)  # left by a writer that died here
        applied = dict(state["applied"])
        if token:
            applied[token.source] = add_to_ranges(applied.get(token.source, []), list(token.batches))
            for name in token.forget:
                applied.pop(name, None)
        common = (json.dumps(state["schema"].jsonValue()), json.dumps(state["keys"]), state["slices"],
                  state["partition"], json.dumps(applied))
        rows = [(None, None, None, *common)] + [(*s, *[None] * len(common)) for s in segments]
        table = pa.Table.from_pylist([dict(zip(_MANIFEST.names, r)) for r in rows], _MANIFEST)
        (self.spark.createDataFrame(table).coalesce(1)
         .write.mode("errorifexists").parquet(folder))
        return version

    def create(self, schema: T.StructType, keys: list[str] | None = None, slices: int = 1,
               partition: str | None = None) -> Target:
        """Make an empty target, unless it is there. Only ``evolve`` changes its schema.

        ``partition`` names a date or time column of the key: loads then rewrite only the months they touch.
        """
        if not self.exists():
            keys = resolve(keys or [], schema.names)
            if partition:
                partition = resolve([partition], schema.names)[0]
                if partition not in keys:
                    raise ValueError(f"the partition column {partition} must be part of the key {keys}")
                if not isinstance(schema[partition].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                    raise ValueError(f"the partition column {partition} must be a date or a time")
            self._commit({"version": 0, "schema": schema, "keys": keys, "slices": slices if keys else 1,
                          "partition": partition, "applied": {}}, [])
        return self

    def evolve(self, schema: T.StructType) -> Target:
        """A version with the same rows under a schema with more columns or wider types; nothing is rewritten."""
        state = self._load()
        if schema != state["schema"]:
            self._commit({**state, "schema": schema}, state["segments"])
        return self

    def applied(self, source: str) -> list[list[int]]:
        """The batches of a source that are part of the current version, as closed ranges."""
        return self._load()["applied"].get(source, [])

    def is_applied(self, source: str, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.applied(source))

    # -- reading ----------------------------------------------------------------------

    @property
    def schema(self) -> T.StructType:
        return self._load()["schema"]

    def read(self, version: int | None = None, kind: str | None = None) -> DataFrame:
        state = self._load(version)
        return self._read(state, [s for s in state["segments"] if kind in (None, s.kind)])

    def _read(self, state: dict, segments: list[Segment]) -> DataFrame:
        schema = state["schema"]
        if not segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.folder}" for s in segments])

    def current(self, version: int | None = None) -> DataFrame:
        """The current rows: all rows of a plain target, ``is_current`` rows of a history one."""
        live = self.read(version, "live")
        return live.where("is_current") if has_history(live.columns) else live

    def count(self) -> int:
        return self.current().count()

    def publish(self, view: str) -> None:
        """Point a catalog view at the current version."""
        state = self._load()
        if not state["segments"]:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in state["schema"])
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {nothing} WHERE false")
            return
        columns = ", ".join(f"`{c}`" for c in state["schema"].names)
        folders = ",".join(s.folder for s in state["segments"])
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{self.root}/{{{folders}}}`")

    # -- writing ----------------------------------------------------------------------

    def _slice_of(self, state: dict) -> Column:
        place = F.lit(0)
        if state["slices"] > 1:
            # The hash depends on the type, so work keys take the target's types first.
            keys = [F.col(k).cast(state["schema"][k].dataType) for k in state["keys"]]
            place = F.pmod(F.xxhash64(*keys), F.lit(state["slices"])).cast("int")
        if state["partition"]:
            day = F.col(state["partition"]).cast(state["schema"][state["partition"]].dataType)
            month = F.coalesce(F.year(day) * 12 + F.month(day), F.lit(0))
            place = month * state["slices"] + place
        return place

    def _write(self, state: dict, rows: DataFrame, kind: Column | str = "live") -> list[Segment]:
        """Write rows to new folders by kind and slice and list what came out."""
        folder = f"data/{uuid.uuid4().hex[:16]}"
        kind = F.lit(kind) if isinstance(kind, str) else kind
        out = rows.withColumns({"_slice": self._slice_of(state), "_kind": kind})
        if state["slices"] > 1 or state["partition"]:
            # Adaptive execution merges small slices and splits large ones.
            out = out.hint("rebalance", "_slice")
        out = out.select(*[F.col(f.name).cast(f.dataType) for f in state["schema"]], "_kind", "_slice")
        out.write.partitionBy("_kind", "_slice").parquet(f"{self.root}/{folder}")
        found = []
        for k in fs.children(self.spark, f"{self.root}/{folder}"):
            if k.startswith("_kind="):
                found += [Segment(k[6:], int(n[7:]), f"{folder}/{k}/{n}")
                          for n in fs.children(self.spark, f"{self.root}/{folder}/{k}")
                          if n.startswith("_slice=")]
        return found

    def _touched(self, state: dict, rows: DataFrame) -> set[int]:
        """Slices some rows fall into: at most ``slices`` numbers, a month."""
        if state["slices"] <= 1 and not state["partition"]:
            return {0}
        return {r[0] for r in rows.select(self._slice_of(state)).distinct().collect()}

    def _measure(self, state: dict, work: DataFrame) -> tuple[list[Segment], bool, int]:
        """In one pass over the work rows: the live segments of the slices they touch, may they be broadcast, and how many they are."""
        seen = work.select(self._slice_of(state).alias("s"), merge.row_bytes(work).alias("b")).agg(
            F.collect_set("s").alias("slices"), F.sum("b").alias("size"), F.count(F.lit(1)).alias("n")).first()
        touched = set(seen["slices"])
        before = [s for s in state["segments"] if s.kind == "live" and s.slice in touched]
        return before, (seen["size"] or 0) <= merge.BROADCAST_BYTES, seen["n"]

    def _hits(self, state: dict, rows: DataFrame, work: DataFrame, keys: list[str], small: bool) -> dict[int, int]:
        """How many of the target rows of each slice have a work row."""
        found = rows.select(*keys).join(F.broadcast(work.select(*keys)) if small else work.select(*keys), keys, "left_semi")
        counts = found.groupBy(self._slice_of(state).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()
        return {r["s"]: r["n"] for r in counts}

    def _matches(self, state: dict, work: DataFrame, keys: list[str]) -> tuple[list[Segment], bool, dict[int, int]]:
        """Live segments of the touched slices, may the work rows be broadcast, and how many target rows
        of each slice have a work row.

        Reads the key columns only. Slices without a match need no rewrite: all they get is new rows.
        """
        before, small, _ = self._measure(state, work)
        return before, small, self._hits(state, self._read(state, before), work, keys, small) if before else {}

    def _guard(self, state: dict, allow: bool, what: str) -> None:
        if has_history(state["schema"].names) and not allow:
            raise merge.HistoryLossError(f"{what} would lose the history of {self.root}; "
                                         "pass allow_history_loss")

    def _complete(self, state: dict, work: DataFrame, run_ts=None) -> DataFrame:
        """Work rows in the target's columns, types and order; history columns as versions new at ``run_ts``
        (now, in UTC, if the caller has no run)."""
        schema = state["schema"]
        names = resolve(data_columns(schema.names), work.columns)
        out = work.select(*[F.col(n).alias(c) for n, c in zip(names, data_columns(schema.names))])
        if has_history(schema.names):
            run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
            out = merge.new_versions(out, run_ts)
        return out.select(*schema.names)

    def _count(self, state: dict, segments: list[Segment]) -> int:
        # Counted from the files that were written, which stays right when tasks are retried.
        return self._read(state, segments).count() if segments else 0

    def replace(self, work: DataFrame, allow_history_loss: bool = False, token=None, run_ts=None) -> LoadCounts:
        """Full replace: the new version holds the work rows only."""
        state = self._load()
        self._guard(state, allow_history_loss, "a full replace")
        written = self._write(state, self._complete(state, work, run_ts))
        self._commit(state, written, token)
        return LoadCounts(rows_inserted=self._count(state, written))

    def append(self, work: DataFrame, allow_history_loss: bool = False, token=None, run_ts=None) -> LoadCounts:
        """SCD0: the new version lists one more set of folders; nothing is read."""
        state = self._load()
        self._guard(state, allow_history_loss, "an append")
        written = self._write(state, self._complete(state, work, run_ts))
        self._commit(state, state["segments"] + written, token)
        return LoadCounts(rows_inserted=self._count(state, written))

    def reload(self, work: DataFrame, condition: str | None, allow_history_loss: bool = False,
               token=None, run_ts=None) -> LoadCounts:
        """Filtered reload: rewrite the slices with a row to drop, add the work rows as new folders."""
        if not condition:
            return self.replace(work, allow_history_loss, token, run_ts)
        state = self._load()
        self._guard(state, allow_history_loss, "a filtered reload")
        hit = self._touched(state, self._read(state, state["segments"]).where(condition))
        stale = [s for s in state["segments"] if s.slice in hit]
        kept = self._write(state, self._read(state, stale).where(~F.coalesce(F.expr(condition), F.lit(False))))
        added = self._write(state, self._complete(state, work, run_ts))
        self._commit(state, [s for s in state["segments"] if s.slice not in hit] + kept + added, token)
        return LoadCounts(rows_inserted=self._count(state, added))

    def _keys(self, state: dict, keys: list[str] | None) -> list[str]:
        keys = resolve(keys or state["keys"], state["schema"].names)
        if not keys:
            raise ValueError(f"{self.root}: this load needs key columns")
        if (state["slices"] > 1 or state["partition"]) and keys != state["keys"]:
            raise ValueError(f"{self.root} is sliced by {state['keys']}, not by {keys}")
        return keys

    def seed(self, rows: DataFrame, token=None) -> LoadCounts:
        """First content of a target, history columns included where it has them."""
        state = self._load()
        written = self._write(state, rows, self._kind_of(state))
        self._commit(state, written, token)
        return LoadCounts(rows_inserted=self._count(state, written))

    def add_history(self, run_ts) -> None:
        """Turn a plain target into a history one: every row is current since ``run_ts``."""
        state = self._load()
        if has_history(state["schema"].names):
            return
        rows = with_history(self._read(state, state["segments"]), run_ts)
        state["schema"] = T.StructType(list(state["schema"]) + HISTORY_FIELDS)
        self._commit(state, self._write(state, rows))

    def upsert(self, work: DataFrame, keys: list[str] | None = None, allow_history_loss: bool = False,
               token=None) -> LoadCounts:
        """SCD1 on the slices the work rows touch. ``work`` must be a written table."""
        state = self._load()
        self._guard(state, allow_history_loss, "an upsert")
        keys = self._keys(state, keys)
        before, small, hits = self._matches(state, work, keys)
        stale = [s for s in before if s.slice in hits]
        values = set(data_columns(state["schema"].names)) - set(keys)
        if not small and stale and values and not has_history(state["schema"].names):
            # One join reads the rows to rewrite once and gives kept, updated and new rows in one write.
            written = self._write(state, merge.upsert_pass(self._read(state, stale), work, keys).drop("_state"))
            self._commit(state, [s for s in state["segments"] if s not in stale] + written, token)
            return LoadCounts(rows_inserted=self._count(state, written) - self._count(state, stale),
                              rows_updated=sum(hits.values()))
        new = merge.unmatched(self._read(state, stale), work, keys, small)
        added = self._write(state, self._complete(state, new))
        # Only non-key columns can change, so a table of keys alone is left as it is.
        if not values:
            kept, hits = stale, {}
        elif stale:
            kept = self._write(state, merge.upserted(self._read(state, stale), work, keys, small).drop("_hit"))
        else:
            kept = []
        self._commit(state, [s for s in state["segments"] if s not in stale] + kept + added, token)
        return LoadCounts(rows_inserted=self._count(state, added), rows_updated=sum(hits.values()))

    def track(self, work: DataFrame, run_ts, keys: list[str] | None = None,
              compare: list[str] | None = None, null_safe: bool = False, token=None) -> LoadCounts:
        """SCD2 on the slices the work rows touch. ``work`` must be a written table.

        The current rows are joined to the work rows once and written, split into still
        current and now closed. The new versions are then found against the keys of what was
        written as still current, a scan of the key columns only.
        """
        state = self._load()
        if not has_history(state["schema"].names):
            return self.upsert(work, keys, token=token)
        keys = self._keys(state, keys)
        before, small, n = self._measure(state, work)
        plain = not any("collate" in state["schema"][k].dataType.simpleString() for k in keys)  # equal keys hash alike
        if plain and not small and self._count(state, before) >= FEW * n:
            return self._track_few(state, before, work, n, run_ts, keys, compare, null_safe, token)
        hits = self._hits(state, self._read(state, before), work, keys, small) if before else {}
        stale = [s for s in before if s.slice in hits]
        flagged = merge.flag_changes(self._read(state, stale), work, keys, run_ts, compare, null_safe,
                                     small).drop("_hit", "_expired")
        kept = self._write(state, flagged, F.when(F.col("is_current"), "live").otherwise("closed")) if stale else []
        live = [s for s in kept if s.kind == "live"]
        closed = [s for s in kept if s.kind == "closed"]
        still = merge.matched_keys(self._read(state, live), work, keys, small)
        new = merge.anti_join(merge.align(work, flagged), still, keys)
        added = self._write(state, merge.new_versions(new, run_ts))
        self._commit(state, [s for s in state["segments"] if s not in stale] + kept + added, token)
        return LoadCounts(rows_inserted=self._count(state, added), rows_expired=self._count(state, closed))

    def _track_few(self, state: dict, before: list[Segment], work: DataFrame, n: int, run_ts, keys: list[str],
                   compare: list[str] | None, null_safe: bool, token) -> LoadCounts:
        """The same where ``n`` work rows are too many for a broadcast and yet few beside the live rows.

        Live rows that a membership filter of the work keys rules out are copied as they are, without a shuffle; only the others
        are joined. Two scans read the live rows: one for the join, one for the copy.
        """
        aside = workspace(self.spark, "track")
        live, on = self._read(state, before), [F.col(k) for k in keys]
        whole, bits = all_of([k.isNotNull() for k in on]), membership.bits_for(n)

        def kept_aside(rows: DataFrame, name: str) -> DataFrame:
            rows.write.parquet(f"{aside}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{aside}/{name}")

        ours = merge.align(work, live).where(whole)
        members = kept_aside(membership.in_words(membership.bitmaps(ours, *on, bits=bits)), "members")

        def may(rows: DataFrame) -> DataFrame:
            return membership.may_match(rows, members, *on, bits=bits).withColumn("_may_match", F.col("_may_match") & whole)

        met = may(live).where("_may_match").drop("_may_match")
        flagged = kept_aside(merge.flag_changes(met, work, keys, run_ts, compare, null_safe).drop("_expired"), "flagged")
        hit = {r[0] for r in flagged.where("_hit").select(self._slice_of(state)).distinct().collect()}
        stale, kept = [s for s in before if s.slice in hit], []
        if stale:
            rest = may(self._read(state, stale)).where("not _may_match").withColumn("is_current", F.lit(True))
            kept = (self._write(state, rest) + self._write(
                state, flagged.where(self._slice_of(state).isin(list(hit))), F.when(F.col("is_current"), "live").otherwise("closed")))
        still = flagged.where("_hit and is_current").select(*keys).distinct()
        added = self._write(state, merge.new_versions(merge.anti_join(merge.align(work, live), still, keys), run_ts))
        self._commit(state, [s for s in state["segments"] if s not in stale] + kept + added, token)
        fs.remove(self.spark, aside)
        return LoadCounts(rows_inserted=self._count(state, added),
                          rows_expired=self._count(state, [s for s in kept if s.kind == "closed"]))

    def load(self, work: DataFrame, load_type: str, scd_type: int, keys: list[str], run_ts,
             condition: str | None = None, allow_history_loss: bool = False, token=None) -> LoadCounts:
        """The load a job asks for."""
        kind = merge.load_kind(load_type, scd_type)
        if kind == "filter":
            return self.reload(work, condition, allow_history_loss, token, run_ts)
        if kind == "append":
            return self.append(work, allow_history_loss, token, run_ts)
        if kind == "scd1":
            return self.upsert(work, keys, allow_history_loss, token)
        if kind == "scd2":
            return self.track(work, run_ts, keys, token=token)
        return self.replace(work, allow_history_loss, token, run_ts)

    def _rewrite(self, rows_hit, change, token=None) -> None:
        """Rewrite the live slices that hold a row to change."""
        state = self._load()
        hit = self._touched(state, rows_hit(self._read(state, state["segments"])))
        stale = [s for s in state["segments"] if s.slice in hit]
        rest = [s for s in state["segments"] if s.slice not in hit]
        written: list[Segment] = []
        # a change may open or close a row, so rows are placed by what they have become
        for kind in sorted({s.kind for s in stale}):
            rows = self._read(state, [s for s in stale if s.kind == kind])
            written += self._write(state, change(rows), self._kind_of(state) if has_history(rows.columns) else kind)
        self._commit(state, rest + written, token)

    def _kind_of(self, state: dict) -> Column | str:
        return (F.when(F.coalesce("is_current", F.lit(False)), "live").otherwise("closed")
                if has_history(state["schema"].names) else "live")

    def update(self, condition: str | Column, values: dict[str, Column]) -> None:
        """Set columns on the rows where a condition is true."""
        hit = F.expr(condition) if isinstance(condition, str) else condition
        self._rewrite(lambda rows: rows.where(hit), lambda rows: rows.withColumns(
            {c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}))

    def delete(self, condition: str | Column) -> None:
        """Remove the rows where a condition is true; a row on which it is NULL stays."""
        hit = F.expr(condition) if isinstance(condition, str) else condition
        self._rewrite(lambda rows: rows.where(hit), lambda rows: rows.where(~F.coalesce(hit, F.lit(False))))

    def compact(self, most: int = MOST_FOLDERS) -> None:
        """Write slices that have come to lie in more than ``most`` folders as one folder again."""
        state = self._load()
        places: dict[tuple[str, int], list[Segment]] = {}
        for s in state["segments"]:
            places.setdefault((s.kind, s.slice), []).append(s)
        kept = [s for found in places.values() if len(found) <= most for s in found]
        many = [s for s in state["segments"] if s not in set(kept)]
        for kind in sorted({s.kind for s in many}):
            kept += self._write(state, self._read(state, [s for s in many if s.kind == kind]), kind)
        if many:
            self._commit(state, kept)

    def truncate(self) -> None:
        self._commit(self._load(), [])

    def drop(self) -> None:
        """Remove the table with all its versions, if it is there."""
        fs.remove(self.spark, self.root)

    def clean_up(self, keep: int = 2) -> list[int]:
        """Forget all but the last versions and remove the folders only they use."""
        versions = self.versions()
        old, live = versions[:-keep], versions[-keep:]
        used = {s.folder for v in live for s in self._load(v)["segments"]}
        dead = {s.folder for v in old for s in self._load(v)["segments"]} - used
        for v in old:
            fs.remove(self.spark, f"{self.root}/_manifest/v={v}")
        for folder in dead:
            fs.remove(self.spark, f"{self.root}/{folder}")
        return old
