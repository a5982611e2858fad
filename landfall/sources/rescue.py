"""What a schema cannot take, kept as JSON text.

:func:`rescue_json` parses JSON text into a schema and, as a second column, what
that loses at any depth; :func:`rescue_columns` does the same for columns that
are typed already (parquet).  Both are expressions over built-in functions, made
once by walking the schema; no row leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)


def _quoted(k: Column) -> Column:
    return F.btrim(F.to_json(F.array(k)), F.lit("[]"))


# Inside these expressions "" stands for "nothing lost", and each step refers to the one before it once: an
# expression that is named twice is computed twice, and so four times two levels down.
def _object(entries: Column) -> Column:
    """JSON object of (k, t) entries, t being JSON text; "" without any."""
    kept = F.filter(entries, lambda e: e["t"] != "")
    body = F.array_join(F.transform(kept, lambda e: F.concat(_quoted(e["k"]), F.lit(":"), e["t"])), ",")
    return F.regexp_replace(F.concat(F.lit("{"), body, F.lit("}")), r"^\{\}$", "")


def _array(texts: Column) -> Column:
    """JSON array of texts, ``null`` for those that are ""; "" if all are."""
    body = F.array_join(F.transform(texts, lambda t: F.regexp_replace(t, "^$", "null")), ",")
    # no text is null, so letters and commas tell as much as the words, and a class of letters takes no stack
    return F.regexp_replace(F.concat(F.lit("["), body, F.lit("]")), r"^\[[nul,]*\]$", "")


def lost(value: Column, parsed: Column, dtype: T.DataType) -> Column:
    """The parts of a JSON ``value`` (VARIANT) that ``parsed``, the same value read
    as ``dtype``, does not hold, as JSON text: fields that a struct lacks, values
    that could not be converted.  In an array, elements that lost nothing are
    ``null``, so the others keep their places.  "" if nothing is lost."""
    if isinstance(dtype, T.VariantType):
        return F.lit("")
    absent = value.isNull() | F.is_variant_null(value)
    if isinstance(dtype, (T.StructType, T.MapType)):
        def entry(e: Column) -> Column:
            k, x = e["key"], e["value"]
            if isinstance(dtype, T.MapType):
                return F.struct(k.alias("k"), lost(x, F.try_element_at(parsed, k), dtype.valueType).alias("t"))
            part = F.when(~k.isin(dtype.names), F.when(F.is_variant_null(x), "").otherwise(F.to_json(x)))
            for f in dtype.fields:
                part = part.when(k == f.name, lost(x, parsed.getField(f.name), f.dataType))
            return F.struct(k.alias("k"), part.alias("t"))

        inner = _object(F.transform(F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")), entry))
    elif isinstance(dtype, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        inner = _array(F.transform(items, lambda x, i: lost(x, F.get(parsed, i), dtype.elementType)))
    else:
        return F.when(absent | parsed.isNotNull(), "").otherwise(F.to_json(value))
    return F.when(absent, "").when(parsed.isNull(), F.to_json(value)).otherwise(inner)


def _has_maps(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_maps(f.dataType) for f in dtype.fields)
    return _has_maps(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, (T.MapType, T.VariantType))


def _fits(text: Column, parsed: Column) -> Column:
    """Whether ``parsed``, written as JSON again, is the text but for blanks between its tokens: then nothing is
    lost, and no tree is needed to tell.  It need not be true where nothing is lost (fields in another order, say)."""
    one = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})
    again = F.to_json(parsed)
    return F.coalesce((text == again) | F.ltrim(text).startswith("{") & (one == F.array(again)), F.lit(False))


def rescue_json(raw: DataFrame, text_col: str, schema: T.StructType, rescue: str, options: dict | None = None) -> DataFrame:
    """Parse JSON text into ``schema`` plus a column holding what it loses: the
    whole text if it is no JSON object (or one whose nested values cannot be told
    apart, as with a key that is there twice), else a JSON object of texts: the
    top-level fields that the schema does not name or whose value it could not
    take, and of nested ones the parts that are not in the schema
    (:func:`lost`).  NULL when nothing is lost."""
    text = F.col(text_col)
    known = F.array(*[F.lit(f.name.lower()) for f in schema.fields])
    nested = [f for f in schema.fields if isinstance(f.dataType, NESTED)]
    # each step is a projection of its own, since what one expression names twice is computed twice
    df = raw.select(text.alias("_t"), F.from_json(text, schema, options or {}).alias("_r"))
    df = df.withColumn("_fits", _fits(F.col("_t"), F.col("_r")) if nested and not _has_maps(schema) else F.lit(False))
    # the top level: with nested fields a tree, which is stricter than the names alone
    top = F.try_variant_get(F.try_parse_json("_t"), "$", "map<string,variant>") if nested else F.json_object_keys("_t")
    df = df.withColumn("_v", F.when(~F.col("_fits"), top))
    gone = F.array_compact(F.array(*[F.when(F.col("_r").getField(f.name).isNull(), F.lit(f.name.lower())) for f in schema.fields]))
    odd = lambda k: ~F.array_contains(known, F.lower(k)) | F.array_contains(gone, F.lower(k))
    as_map = F.when(F.exists(F.map_keys("_v") if nested else F.col("_v"), odd), F.from_json("_t", "map<string,string>"))
    extra = F.map_filter(as_map, lambda k, v: ~F.array_contains(known, F.lower(k)) | (v.isNotNull() & F.array_contains(gone, F.lower(k))))
    if nested:
        parts = F.array(*[F.struct(F.lit(f.name).alias("k"), F.when(F.col("_r").getField(f.name).isNull(), "").otherwise(
            lost(F.col(f"_v{i}"), F.col("_r").getField(f.name), f.dataType)).alias("t")) for i, f in enumerate(nested)])
        extra = F.map_concat(F.coalesce(extra, F.from_json(F.lit("{}"), "map<string,string>")),
                             F.map_from_entries(F.filter(parts, lambda e: e["t"] != "")))
        df = df.withColumns({f"_v{i}": F.try_element_at("_v", F.lit(f.name)) for i, f in enumerate(nested)})
    df = df.withColumn("_extra", F.when(F.col("_v").isNotNull(), extra))
    bad = ~F.col("_fits") & F.col("_v").isNull() & (F.trim("_t") != "")
    return df.select("_r.*", F.when(bad, F.col("_t")).otherwise(F.when(F.size("_extra") > 0, F.to_json("_extra"))).alias(rescue))


def json_documents(raw: DataFrame, text_col: str) -> DataFrame:
    """Whole JSON files -> one row for each document: the elements of a file
    that is an array, else the file's text."""
    text = F.col(text_col)
    rows = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))
    return raw.select(F.explode(F.coalesce(rows, F.array(text))).alias(text_col))


# ---------------------------------------------------------------- typed columns
Part = tuple[Callable[[Column], Column], Callable[[Column], Column]]


def beyond(have: T.DataType, want: T.DataType) -> Part | None:
    """How to get what ``want`` cannot take out of a value of type ``have``, and
    whether there is any; ``None`` if the types alone tell that there is none."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        wanted = {f.name.lower(): f.dataType for f in want.fields}
        parts = {}
        for f in have.fields:
            part = beyond(f.dataType, wanted[f.name.lower()]) if f.name.lower() in wanted else (lambda c: c, lambda c: c.isNotNull())
            if part is not None:
                parts[f.name] = part
        if not parts:
            return None

        def some(c: Column) -> Column:
            out = F.lit(False)
            for name, (_, has) in parts.items():
                out = out | F.coalesce(has(c.getField(name)), F.lit(False))
            return out

        return lambda c: F.struct(*(F.when(has(c.getField(n)), get(c.getField(n))).alias(n) for n, (get, has) in parts.items())), some
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        part = beyond(have.elementType, want.elementType)
        return part and (lambda c: F.transform(c, lambda x: F.when(part[1](x), part[0](x))), lambda c: F.exists(c, lambda x: part[1](x)))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        part = beyond(have.valueType, want.valueType)
        return part and (lambda c: F.map_filter(F.transform_values(c, lambda k, x: F.when(part[1](x), part[0](x))), lambda k, x: x.isNotNull()),
                         lambda c: F.exists(F.map_values(c), lambda x: part[1](x)))
    if have == want or isinstance(want, T.StringType) and not isinstance(have, NESTED):
        return None
    return lambda c: c, lambda c: c.isNotNull() & fitted(c, have, want).isNull()


def fitted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value as ``want``, as far as it goes: missing fields and values that cannot be converted are NULL."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        there = {f.name.lower(): f for f in have.fields}
        fields = [fitted(c.getField(there[f.name.lower()].name), there[f.name.lower()].dataType, f.dataType).alias(f.name)
                  if f.name.lower() in there else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
        return F.transform_values(c, lambda k, x: fitted(x, have.valueType, want.valueType))
    if isinstance(have, NESTED) or isinstance(want, NESTED):
        return F.lit(None).cast(want)
    try:
        return c.try_cast(want)
    except Exception:       # no cast between the two types
        return F.lit(None).cast(want)


def rescue_columns(df: DataFrame, schema: T.StructType, rescue: str) -> DataFrame:
    """``df`` as ``schema`` plus a column with what that leaves out, as JSON (NULL when there is none)."""
    have = {f.name.lower(): f for f in df.schema.fields}
    whole = F.struct(*(F.col(f"`{f.name}`") for f in df.schema.fields))
    columns = [fitted(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType).alias(f.name)
               if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    part = beyond(df.schema, schema)
    text = F.when(part[1](whole), F.to_json(part[0](whole))) if part else F.lit(None).cast("string")
    return df.select(*columns, text.alias(rescue))
