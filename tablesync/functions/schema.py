"""Fitting a batch to the columns a target already has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.errors import ConfigError, LoadError
from tablesync.functions.audit import quoted


#: Names the file tables and joins use inside.
RESERVED = {"_v", "_bucket", "_salt", "__rank", "__hit", "__held", "__slot"}
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}  # digits each may need
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_EXACT_IN = {T.FloatType: 7, T.DoubleType: 15}  # digits each holds without loss


def require_free_names(names: list[str]) -> None:
    clash = sorted(n for n in names if n.lower() in RESERVED or n.lower().startswith("__new_"))
    if clash:
        raise ConfigError(f"reserved column names: {', '.join(clash)}")


def lossless(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is the same value in ``new``."""
    if old == new or isinstance(old, T.NullType):
        return True
    if type(old) in _WHOLE:
        digits = _WHOLE[type(old)]
        if type(new) in _WHOLE:
            return _WHOLE[type(new)] >= digits
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= digits
        return type(new) in _EXACT_IN and _EXACT_IN[type(new)] >= digits
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(old, (T.CharType, T.VarcharType)):
        return isinstance(new, T.StringType)
    if isinstance(old, T.DateType):
        return isinstance(new, T.TimestampNTZType)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return lossless(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return lossless(old.keyType, new.keyType) and lossless(old.valueType, new.valueType)
    if isinstance(old, T.StructType) and isinstance(new, T.StructType) and old.names == new.names:
        return all(lossless(a.dataType, b.dataType) for a, b in zip(old, new, strict=True))
    return False


#: Types that files written with the first can be read as; others would need the files rewritten.
_READABLE_WIDER = (
    (T.ByteType, (T.ShortType, T.IntegerType, T.LongType)), (T.ShortType, (T.IntegerType, T.LongType)),
    (T.IntegerType, (T.LongType,)), (T.FloatType, (T.DoubleType,)),
)


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale == old.scale and new.precision > old.precision
    return any(isinstance(old, a) and isinstance(new, b) for a, b in _READABLE_WIDER)


def _narrows(old: T.DataType, new: T.DataType) -> bool:
    """Whole numbers into a narrower type: exact, or refused value by value in ``fitted``."""
    return type(old) in _WHOLE and type(new) in _WHOLE


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds every value of both, or None: fields of structs by name in any case, the target's
    first; elements of arrays; values of maps, whose keys only widen."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        arriving = {f.name.lower(): f.dataType for f in new}
        if len(arriving) < len(new.fields):
            return None  # names that differ by case only
        known = {f.name.lower() for f in old}
        kinds = [(f.name, merged_type(f.dataType, arriving.get(f.name.lower(), f.dataType))) for f in old]
        kinds += [(f.name, f.dataType) for f in new if f.name.lower() not in known]
        if any(kind is None for _, kind in kinds):
            return None
        return T.StructType([T.StructField(name, kind, True) for name, kind in kinds])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        element = merged_type(old.elementType, new.elementType)
        return element and T.ArrayType(element, True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        key, value = merged_type(old.keyType, new.keyType), merged_type(old.valueType, new.valueType)
        same = not isinstance(old.keyType, T.StructType) or key == old.keyType
        return T.MapType(key, value, True) if key is not None and value is not None and same else None
    if lossless(new, old):
        return old
    return new if _widens(old, new) else None


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def as_type(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A nested value in a merged type, by name; fields it lacks are NULL, and NULL stays NULL."""
    if have == want or not isinstance(have, _NESTED):
        return value.cast(want)
    if isinstance(have, T.StructType):
        spelled = {f.name.lower(): f for f in have}
        fields = []
        for field in want:
            own = spelled.get(field.name.lower())
            inner = F.lit(None).cast(field.dataType) if own is None else as_type(value.getField(own.name), own.dataType, field.dataType)
            fields.append(inner.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: as_type(x, have.elementType, want.elementType))
    entries = F.transform(F.map_entries(value), lambda e: F.struct(
        as_type(e.key, have.keyType, want.keyType).alias("key"), as_type(e.value, have.valueType, want.valueType).alias("value")))
    return F.map_from_entries(entries)


def merged_schema(target: T.StructType, batch: T.StructType, evolution: str) -> T.StructType:
    """Target columns, then the batch's new ones. ``strict`` refuses new ones.

    Under ``merge`` a column whose batch type is wider (int to bigint, float to double, more decimal
    digits) takes that type, inside structs, arrays and maps as well, and structs gain fields. A type that
    the target's cannot hold without loss is refused.
    """
    require_free_names(batch.names)
    known = {field.name.lower() for field in target}
    extra = [field for field in batch if field.name.lower() not in known]
    if extra and evolution != "merge":
        raise LoadError(f"columns not in the target: {', '.join(f.name for f in extra)}")
    arriving = {field.name.lower(): field.dataType for field in batch}
    fields = []
    for field in target:
        new = arriving.get(field.name.lower(), field.dataType)
        if lossless(new, field.dataType) or (evolution != "merge" and _narrows(new, field.dataType)):
            new = field.dataType
        elif evolution == "merge" and isinstance(new, _NESTED) and merged_type(field.dataType, new) is not None:
            new = merged_type(field.dataType, new)
        elif evolution != "merge" or not _widens(field.dataType, new):
            raise LoadError(
                f"column {field.name}: {new.simpleString()} does not fit {field.dataType.simpleString()} without loss; cast it first")
        fields.append(T.StructField(field.name, new, True))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in extra]])


def shared_columns(target: T.StructType, batch: DataFrame) -> list[str]:
    """Names of ``target`` that the batch holds, in target order and spelling."""
    held = {c.lower() for c in batch.columns}
    return [field.name for field in target if field.name.lower() in held]


def fitted(batch: DataFrame, target: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """The batch with the target's names, order and types.

    Columns the batch lacks become NULL, or are left out when ``columns`` names
    the ones to keep. ``target`` is a merged schema, so a cast is lossless, or fails the job where a
    whole number does not fit.
    """
    spelled = {c.lower(): c for c in batch.columns}
    wanted = target.fields if columns is None else [target[c] for c in columns]
    values = []
    for field in wanted:
        name = spelled.get(field.name.lower())
        value = F.lit(None) if name is None else quoted(name)
        if name is None or batch.schema[name].dataType != field.dataType:
            if name is not None and _narrows(batch.schema[name].dataType, field.dataType):
                limit = 1 << (_BITS[type(field.dataType)] - 1)
                problem = F.concat(F.lit(f"{field.name}: "), value.cast("string"), F.lit(f" is no {field.dataType.simpleString()}"))
                value = F.when(value.isNull() | value.between(-limit, limit - 1), value).otherwise(F.raise_error(problem).cast(batch.schema[name].dataType))
            value = value.cast(field.dataType) if name is None else as_type(value, batch.schema[name].dataType, field.dataType)
        values.append(value.alias(field.name))
    return batch.select(*values)
