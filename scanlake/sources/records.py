"""JSON records: listing pages, strict decoding with a quarantine, encoding."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.functions.binding import bound
from scanlake.functions.jsontext import PLAIN_JSON, is_alone, is_single_object
from scanlake.functions.labels import rfc3339

_CORRUPT = "_corrupt"
# What a number, boolean, object or array leaves in a text field.
_OTHER_JSON = r"^(?:-?[0-9][0-9.eE+-]*$|true$|false$|[\[{])"
_TIME_TEXT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.,]\d+)?(Z|[+-]\d\d:\d\d)$"
# Fixed value: what an absent time decodes to.
ZERO_TIME = "0001-01-01T00:00:00Z"


def repo_inventory(pages: DataFrame, org, value: str = "value") -> DataFrame:
    """Rows (org, name) of saved listing pages, each a JSON array of repository objects.

    org is the configured one, never the payload's; nothing is de-duplicated. A page that is no
    array, or has bytes after it, is left out, see ``reject_pages``; an item that is no object or
    whose name is no text is left out alone, see ``reject_items``. An absent or null name is "".
    """
    org = org if isinstance(org, Column) else F.lit(org)
    items = F.filter(_page_items(F.col(value)), _is_repository)
    return pages.select(org.alias("org"), F.explode(items).alias("repo")).select(
        "org", F.coalesce(F.try_variant_get("repo", "$.name", "string"), F.lit("")).alias("name")
    )


def reject_pages(pages: DataFrame, value: str = "value") -> DataFrame:
    """The pages ``repo_inventory`` cannot read, unchanged."""
    return pages.filter(_page_items(F.col(value)).isNull())


def reject_items(pages: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The items ``repo_inventory`` leaves out of readable pages: (keep..., item_no from 0, item)."""
    items = pages.select(*keep, F.posexplode(_page_items(F.col(value))).alias("item_no", "_item"))
    refused = items.filter(~_is_repository(F.col("_item")))
    # A null item has no JSON text of its own.
    return refused.select(*keep, "item_no", F.coalesce(F.to_json("_item"), F.lit("null")).alias("item"))


def _page_items(text: Column) -> Column:
    """The items of a page as variants; null unless the whole text is one array."""
    whole = F.rlike(text, F.lit(r"^\s*\[")) & is_alone(text)
    return F.when(F.coalesce(whole, F.lit(False)), F.from_json(text, "array<variant>", PLAIN_JSON))


def _is_repository(item: Column) -> Column:
    name = F.schema_of_variant(F.try_variant_get(item, "$.name", "variant"))
    is_object = F.startswith(F.schema_of_variant(item), F.lit("OBJECT"))
    return F.coalesce(is_object, F.lit(False)) & F.coalesce(name.isin("STRING", "VOID"), F.lit(True))


def decode_records(
    df: DataFrame,
    schema: T.StructType,
    strict: bool = True,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns of ``schema`` from JSON text; malformed records are left out.

    An absent or null field becomes its zero value ("" / 0 / false / year 1); an absent
    array stays null. ``strict`` also rejects a number where text is expected, and times
    that are not RFC 3339. The text ``null`` is an empty record. Keys match by case.
    """
    records = df.select(*keep, F.inline(_valid_records(F.col(value), schema, strict)))
    # A projection above the generator: only fields that are used later are filled.
    return records.select(
        *keep, *[_filled(F.col(f.name), f.dataType).alias(f.name) for f in schema]
    )


def record_array(text: Column, schema: T.StructType, strict: bool = True) -> Column:
    """The decoded record of a text column as an array of one, or empty when malformed."""
    return F.transform(
        _valid_records(text, schema, strict),
        lambda record: F.struct(*[_filled(record[f.name], f.dataType).alias(f.name) for f in schema]),
    )


def reject_records(
    df: DataFrame, schema: T.StructType, strict: bool = True, value: str = "value"
) -> DataFrame:
    """The rows ``decode_records`` leaves out, unchanged: the quarantine."""
    return df.filter(F.coalesce(F.size(_valid_records(F.col(value), schema, strict)), F.lit(0)) == 0)


def _valid_records(raw: Column, schema: T.StructType, strict: bool) -> Column:
    """Array with the parsed record, or an empty one: each text is parsed once.

    Only where a text field holds what could also have been a number, a boolean or a
    nested value does the strict check parse again, now with JSON types.
    """
    text = F.when(F.rlike(raw, F.lit(r"^\s*null\s*$")), "{}").otherwise(raw)
    return bound(text, lambda bound_text: _valid_record(bound_text, schema, strict))


def _valid_record(text: Column, schema: T.StructType, strict: bool) -> Column:
    def valid(parsed: Column) -> Column:
        good = parsed.isNotNull() & parsed[_CORRUPT].isNull() & is_single_object(text)
        if not strict:
            return good
        good &= _every_leaf(parsed, schema, _is_time)
        typed = bound(
            _parse(text, _mapped(schema, _text_as_variant)),
            lambda again: _every_leaf(again, schema, _is_json_text),
        )
        return good & (_every_leaf(parsed, schema, _is_surely_text) | typed)

    record = _parse(text, _mapped(schema, _time_as_text) if strict else schema)
    return F.filter(F.array(record), valid)


def _parse(text: Column, schema: T.StructType) -> Column:
    wire = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {**PLAIN_JSON, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(text, wire, options)


def _mapped(kind: T.DataType, leaf: Callable[[T.DataType], T.DataType]) -> T.DataType:
    """The same nesting with other leaf types."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_mapped(kind.elementType, leaf))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _mapped(kind.valueType, leaf))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _mapped(f.dataType, leaf)) for f in kind])
    return leaf(kind)


def _time_as_text(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, T.TimestampType) else kind


def _text_as_variant(kind: T.DataType) -> T.DataType:
    return T.VariantType() if isinstance(kind, T.StringType) else _time_as_text(kind)


def _is_json_text(col: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        return col.isNull() | F.schema_of_variant(col).isin("STRING", "VOID")
    return None


def _is_time(col: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.TimestampType):
        return col.isNull() | (F.rlike(col, F.lit(_TIME_TEXT)) & col.try_cast("timestamp").isNotNull())
    return None


def _is_surely_text(col: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        return col.isNull() | ~F.rlike(col, F.lit(_OTHER_JSON))
    return None


def _every_leaf(
    col: Column, kind: T.DataType, test: Callable[[Column, T.DataType], Column | None]
) -> Column:
    """Whether the test holds for every leaf it applies to; absent parents pass."""
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.forall(col, lambda x: _every_leaf(x, kind.elementType, test)), F.lit(True))
    if isinstance(kind, T.MapType):
        values = F.map_values(col)
        return F.coalesce(F.forall(values, lambda x: _every_leaf(x, kind.valueType, test)), F.lit(True))
    if isinstance(kind, T.StructType):
        good = F.lit(True)
        for field in kind:
            good &= _every_leaf(col[field.name], field.dataType, test)
        return good
    tested = test(col, kind)
    return F.lit(True) if tested is None else tested


def _filled(col: Column, kind: T.DataType) -> Column:
    """The value with zero values for what is absent."""
    if isinstance(kind, T.StringType):
        return F.coalesce(col, F.lit(""))
    if isinstance(kind, T.TimestampType):
        return F.coalesce(col.cast(kind), F.lit(ZERO_TIME).cast(kind))
    if isinstance(kind, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    if isinstance(kind, T.NumericType):
        return F.coalesce(col, F.lit(0).cast(kind))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _filled(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, x: _filled(x, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.struct(*[_filled(col[f.name], f.dataType).alias(f.name) for f in kind])
    return col


def encode_records(
    df: DataFrame,
    omit_empty: Sequence[str] = (),
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One JSON text per row, of all columns that are not kept beside it.

    Fields named in ``omit_empty`` (dotted inside arrays of structs) are left out when
    empty; nulls are always left out. Times are RFC 3339 with microseconds.
    """
    record = json_text([f for f in df.schema if f.name not in keep], omit_empty)
    return df.select(*keep, record.alias(value))


def json_text(fields: Sequence[T.StructField], omit_empty: Sequence[str] = ()) -> Column:
    """JSON text of the named top-level columns."""
    return F.to_json(
        F.struct(*[_encoded(F.col(f.name), f.dataType, f.name, omit_empty).alias(f.name) for f in fields])
    )


def _encoded(col: Column, kind: T.DataType, path: str, omit: Sequence[str]) -> Column:
    if path in omit:
        col = F.when(F.size(col) > 0, col) if isinstance(kind, T.ArrayType) else F.nullif(col, F.lit(""))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return rfc3339(col)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        inner = [name for name in omit if name != path]
        return F.transform(col, lambda x: _encoded(x, kind.elementType, path, inner))
    if isinstance(kind, T.StructType):
        return F.struct(
            *[_encoded(col[f.name], f.dataType, f"{path}.{f.name}", omit).alias(f.name) for f in kind]
        )
    return col
