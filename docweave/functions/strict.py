"""JSON answers held against a schema that allows nothing else.

A schema is DDL: every field is required, ``NOT NULL`` fields and items of arrays must not be null, and no other field may be there; a
number without a fraction is an integer, however it is written.  The
schema is walked when the expression is built; a value is walked as VARIANT, so fields that no schema names are seen
and no value is cast before its type is known.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _col

PROBLEMS = "array<struct<path:string,problem:string>>"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _one(path: Column, problem: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(problem).alias("problem"))).cast(PROBLEMS)


def _none() -> Column:
    return F.array().cast(PROBLEMS)


def _walk(v: Column, kind: T.DataType, path: Column, nullable: bool) -> Column:
    named = F.schema_of_variant(v)
    if isinstance(kind, T.StructType):
        fits, inner = named.startswith("OBJECT"), _object(v, kind, path)
    elif isinstance(kind, T.ArrayType):
        items = F.try_variant_get(v, "$", "array<variant>")
        each = lambda x, i: _walk(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), False)
        fits, inner = named.startswith("ARRAY"), F.flatten(F.transform(items, each))
    elif isinstance(kind, _INTEGERS):
        fits, inner = (named == "BIGINT") | named.endswith(",0)"), _none()
    elif isinstance(kind, T.BooleanType):
        fits, inner = named == "BOOLEAN", _none()
    elif isinstance(kind, T.StringType):
        fits, inner = named == "STRING", _none()
    else:
        fits, inner = (named == "BIGINT") | (named == "DOUBLE") | (named == "FLOAT") | named.startswith("DECIMAL"), _none()
    null = _none() if nullable else _one(path, "null")
    return F.when(F.is_variant_null(v), null).when(~fits, _one(path, "mistyped")).otherwise(inner)


def _object(v: Column, kind: T.StructType, path: Column) -> Column:
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    at = lambda name: F.concat(path, F.lit("."), name if isinstance(name, Column) else F.lit(name))
    own = [F.when(F.map_contains_key(fields, f.name), _walk(F.try_element_at(fields, F.lit(f.name)), f.dataType, at(f.name), f.nullable)).otherwise(_one(at(f.name), "missing")) for f in kind.fields]
    others = F.array_sort(F.filter(F.map_keys(fields), lambda k: ~k.isin(*[f.name for f in kind.fields])))
    return F.concat(*own, F.transform(others, lambda k: F.struct(at(k).alias("path"), F.lit("unknown").alias("problem"))).cast(PROBLEMS))


def strict_json(raw) -> Column:
    """The VARIANT of a text that is one JSON value and nothing else, or NULL.

    The parser stops after the first value, so the text is parsed inside brackets and inside braces: what follows a
    value breaks one of the two.
    """
    raw = _col(raw)
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))), "$", "array<variant>")
    braced = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    return F.when(braced.isNotNull() & (F.size(listed) == 1), F.get(listed, F.lit(0)))


def schema_problems(raw, ddl: str) -> Column:
    """array of (path, problem) of a JSON text: ``invalid``, ``missing``, ``unknown``, ``null`` or ``mistyped``; empty where
    the value fits. A NULL text is invalid."""
    schema = T.StructType.fromDDL(ddl)
    walked = F.transform(F.array(strict_json(raw)), lambda v: F.when(v.isNull(), _one(F.lit("$"), "invalid")).otherwise(_walk(v, schema, F.lit("$"), False)))
    return F.element_at(walked, 1)
