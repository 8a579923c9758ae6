"""Source column types, target schemas and history columns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Source type name -> target type.
FIXED_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "float": T.DoubleType(),
    "real": T.DoubleType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "date": T.DateType(),
    "time": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "uniqueidentifier": T.StringType(),
    "text": T.StringType(),
    "ntext": T.StringType(),
    "image": T.BinaryType(),
    "xml": T.VariantType(),
}
# Names of the history columns.
HISTORY_COLUMNS = ["is_current", "eff_start_date", "eff_end_date"]

HISTORY_FIELDS = [
    T.StructField("is_current", T.BooleanType()),
    T.StructField("eff_start_date", T.TimestampNTZType()),
    T.StructField("eff_end_date", T.TimestampNTZType()),
]


class ColumnMeta(NamedTuple):
    """One source column as the source catalog describes it."""

    name: str
    data_type: str
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True


def target_field(meta: ColumnMeta) -> T.StructField:
    """The target column; a length limit travels in the field's metadata."""
    kind, limit = meta.data_type.lower(), None
    if kind in ("decimal", "numeric"):
        data_type: T.DataType = T.DecimalType(meta.precision or 38, meta.scale or 0)
    elif kind in ("binary", "varbinary"):
        data_type, limit = T.BinaryType(), meta.max_length
    elif kind in ("char", "nchar", "varchar", "nvarchar"):
        data_type, limit = T.StringType(), meta.max_length
    else:
        data_type = FIXED_TYPES.get(kind, T.StringType())
        limit = 36 if kind == "uniqueidentifier" else None
    notes = {"max_length": limit} if limit and limit > 0 else {}
    return T.StructField(meta.name, data_type, meta.nullable, notes)


def target_schema(columns: list[ColumnMeta], history: bool = False, upper: bool = False) -> T.StructType:
    """Schema of a target made from source metadata."""
    if not columns:
        raise ValueError("the source has no columns")
    named = [c._replace(name=c.name.upper()) for c in columns] if upper else columns
    return T.StructType([target_field(c) for c in named] + (HISTORY_FIELDS if history else []))


_NAMES = {
    T.IntegerType: "int", T.LongType: "bigint", T.ShortType: "smallint", T.ByteType: "smallint",
    T.BooleanType: "bit", T.DoubleType: "float", T.FloatType: "real", T.DateType: "date",
    T.TimestampNTZType: "datetime2", T.TimestampType: "datetimeoffset", T.BinaryType: "varbinary",
    T.VariantType: "xml",
}


def column_metadata(df: DataFrame) -> list[ColumnMeta]:
    """Names and source type names of a DataFrame's columns, in order."""
    found = []
    for field in df.schema:
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            found.append(ColumnMeta(field.name, "decimal", None, kind.precision, kind.scale, field.nullable))
        elif type(kind) in _NAMES:
            found.append(ColumnMeta(field.name, _NAMES[type(kind)], nullable=field.nullable))
        elif isinstance(kind, T.StringType):
            limit = field.metadata.get("max_length", -1)
            found.append(ColumnMeta(field.name, "varchar", limit, nullable=field.nullable))
        else:
            raise TypeError(f"column {field.name}: no source type for {kind.simpleString()}")
    return found


def to_text(col: Column, data_type: T.DataType) -> Column:
    """A value as staged text; binary is written as hex digits."""
    if isinstance(data_type, T.BinaryType):
        return F.hex(col)
    return col if isinstance(data_type, T.StringType) else col.cast("string")


def from_text(col: Column, data_type: T.DataType) -> Column:
    """Staged text as a typed value; NULL where the text does not fit the type."""
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(col, F.lit("hex"))
    if isinstance(data_type, T.VariantType):
        # XML from the source, or JSON as this library stages it. The variant parser ends the job on text that is not
        # well formed, so such text is found by the row parser first, which marks it.
        bad = F.from_xml(col, T.StructType([T.StructField("_corrupt_record", T.StringType())]))["_corrupt_record"]
        xml = F.when(bad.isNull(), F.from_xml(F.when(bad.isNull(), col), "variant"))
        return F.when(F.ltrim(col).startswith("<"), xml).otherwise(F.try_parse_json(col))
    return col if isinstance(data_type, T.StringType) else col.try_cast(data_type)


def has_history(columns: list[str]) -> bool:
    return set(HISTORY_COLUMNS) <= {c.lower() for c in columns}


def data_columns(columns: list[str]) -> list[str]:
    """The columns a staged file holds: all but the history columns."""
    return [c for c in columns if c.lower() not in HISTORY_COLUMNS]


def resolve(names: list[str], columns: list[str]) -> list[str]:
    """Match names to the columns of a table, whatever their case."""
    known = {c.lower(): c for c in columns}
    missing = [n for n in names if n.strip().lower() not in known]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    return [known[n.strip().lower()] for n in names]


def split_keys(columns: list[str], keys: list[str]) -> tuple[list[str], list[str]]:
    """(key columns, other data columns)."""
    key_columns = resolve(keys, columns)
    return key_columns, [c for c in data_columns(columns) if c not in key_columns]


def with_history(df: DataFrame, run_ts) -> DataFrame:
    """Add the history columns to a plain table, every row current since ``run_ts``."""
    return df.withColumns({
        "is_current": F.lit(True),
        "eff_start_date": F.lit(run_ts).cast("timestamp_ntz"),
        "eff_end_date": F.lit(None).cast("timestamp_ntz"),
    })


_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The narrower-to-wider join of two types that keeps every value of both as it is; None if there is none."""
    if old == new:
        return old
    kinds = type(old), type(new)
    if all(k in _WHOLE for k in kinds):
        return max(old, new, key=lambda t: _WHOLE.index(type(t)))
    if set(kinds) == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds == (T.DecimalType, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        # files keep a decimal's scale, so only the digits before the point may grow
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 and scale == old.scale else None
    return None


def evolved(target: T.StructType, source: T.StructType, keys: list[str]) -> T.StructType:
    """The target's schema after the source's columns have changed.

    Columns are matched by name without case. New columns are added behind the others and are NULL in old rows; a type may only
    grow; a column that the source lost stays and is NULL in new rows, unless it is a key or must not be NULL.
    """
    found = {f.name.lower(): f for f in source if f.name.lower() not in HISTORY_COLUMNS}
    fields, history = [], []
    for f in target:
        if f.name.lower() in HISTORY_COLUMNS:
            history.append(f)
            continue
        now = found.pop(f.name.lower(), None)
        if now is None:
            if f.name.lower() in [k.lower() for k in keys] or not f.nullable:
                raise ValueError(f"the source has lost the column {f.name}")
            fields.append(f)
            continue
        kind = widened(f.dataType, now.dataType)
        if kind is None:
            raise ValueError(f"column {f.name}: {now.dataType.simpleString()} does not fit {f.dataType.simpleString()}")
        limits = f.metadata.get("max_length"), now.metadata.get("max_length")
        notes = {"max_length": max(limits)} if all(limits) else dict(f.metadata)
        fields.append(T.StructField(f.name, kind, f.nullable, notes))
    new = [T.StructField(f.name, f.dataType, True, f.metadata) for f in found.values()]
    return T.StructType([*fields, *new, *history])
