"""Reading JSON payloads: parsed once per row with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARSED = "__parsed"


def _as_struct(fields: dict) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, _as_struct(inner) if isinstance(inner, dict) else T.StringType())
            for name, inner in fields.items()
        ]
    )


def _fields(names) -> dict:
    """Turn 'a', 'b.c', 'b.d' into {'a': None, 'b': {'c': None, 'd': None}}."""
    tree: dict = {}
    for name in names:
        node = tree
        *parents, leaf = name.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = None
    return tree


def _quoted(path: str) -> str:
    return ".".join(f"`{step}`" for step in path.split("."))


def _scalar(path: str, payload: str) -> str:
    """SQL for one scalar as text; NULL if the value is an object or array.

    A string field of ``from_json`` holds the JSON text of an object or array. Only
    when the text starts like one is the payload looked at again, as a variant.
    """
    value = f"{_PARSED}.{_quoted(path)}"
    kind = f"schema_of_variant(try_variant_get(try_parse_json(`{payload}`), '$.{path}', 'variant'))"
    return (
        f"CASE WHEN left({value}, 1) IN ('{{', '[') "
        f"THEN CASE WHEN NOT {kind} RLIKE '^(OBJECT|ARRAY)' THEN {value} END ELSE {value} END"
    )


def parse_payload(
    df: DataFrame, payload: str, scalars: dict[str, str], keep: list[str], lists: tuple[str, ...] = ()
) -> DataFrame:
    """Select ``keep``, one text column per scalar and one array of JSON texts per list.

    ``scalars`` maps column to path; a list is a field of the top level. The payload is parsed once per row. SQL texts instead of Column calls: with some
    thirty fields those would take longer than the parsing of a small table.
    """
    schema = _as_struct(_fields(scalars.values()))
    for name in lists:
        schema = schema.add(name, T.ArrayType(T.StringType()))
    parsed = df.withColumn(_PARSED, F.from_json(F.col(payload), schema))
    return parsed.selectExpr(
        *keep,
        *[f"{_scalar(path, payload)} AS {name}" for name, path in scalars.items()],
        *[f"{_PARSED}.{name} AS {name}" for name in lists],
    )


def json_list(payload: Column, field: str) -> Column:
    """Array field as JSON texts, one per element; NULL if it is not an array."""
    schema = T.StructType([T.StructField(field, T.ArrayType(T.StringType()))])
    return F.from_json(payload, schema)[field]
