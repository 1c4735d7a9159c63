"""The raw row format: who sent what, when, and the payload as JSON text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.functions.casts import safe_ts
from stockflow.functions.dates import instant
from stockflow.schemas import CURSOR_FIELD


def to_envelope(
    items: DataFrame,
    source: str,
    entity: str,
    id_paths: tuple[str, ...],
    extracted_at: Column,
) -> DataFrame:
    """Wrap each JSON ``item``; items without a complete id are dropped."""
    parts = [F.get_json_object("item", f"$.{path}") for path in id_paths]
    with_dashes = [part for one in parts for part in (F.lit("-"), one)][1:]
    return items.select(
        F.lit(source).alias("source"),
        F.lit(entity).alias("entity"),
        F.concat(*with_dashes).alias("record_id"),
        extracted_at.alias("extracted_at"),
        F.col("item").alias("payload"),
    ).where(F.col("record_id").isNotNull())


def phones_as_text(item: Column) -> Column:
    """Numbers under a key "phone", at any depth, become strings.

    Inside a JSON string quotes are escaped, so only real keys can match. Texts without such a
    key skip the pattern.
    """
    changed = F.regexp_replace(item, r'"phone"\s*:\s*(-?\d[\d.eE+-]*)', r'"phone":"$1"')
    return F.when(F.contains(item, F.lit('"phone"')), changed).otherwise(item)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_phone(item: Column) -> Column:
    """An object's text, with a null "phone" if it has no such key; other values as they are."""

    def by_keys(item: Column, keys: Column) -> Column:
        opened = F.when(F.size(keys) == 0, F.lit('{"phone":null')).otherwise(F.lit('{"phone":null,'))
        with_key = F.concat(opened, F.regexp_replace(item, r"^\s*\{", ""))
        return F.when(F.array_contains(keys, "phone") | keys.isNull(), item).otherwise(with_key)

    return _let(item, lambda item: _let(F.json_object_keys(item), lambda keys: by_keys(item, keys)))


def _replaced_field(item: Column, field: str, parsed: Column, old: Column, change: Callable[[Column], Column]) -> Column:
    """Put the changed value in the place of the value ``old`` of a field, both as compact JSON."""
    key = F.lit(f'"{field}":')

    def replaced(old: Column, new: Column) -> Column:
        found = F.replace(F.to_json(parsed), F.concat(key, old), F.concat(key, new))
        return F.when(old.isNull() | (old == new), item).otherwise(F.coalesce(found, item))

    return _let(old, lambda old: _let(change(old), lambda new: replaced(old, new)))


def customer_phones(item: Column) -> Column:
    """A customer, its default address and its addresses have a "phone", null if unknown."""

    def with_default(item: Column, parsed: Column) -> Column:
        address = F.to_json(F.try_variant_get(parsed, "$.default_address", "variant"))
        return _replaced_field(item, "default_address", parsed, address, _with_phone)

    def with_addresses(item: Column, parsed: Column) -> Column:
        several = F.try_variant_get(parsed, "$.addresses", "array<variant>")
        texts = F.transform(several, lambda one: F.to_json(one))
        return _let(texts, lambda texts: _replaced_field(
            item, "addresses", parsed, joined(texts), lambda _: joined(F.transform(texts, _with_phone))
        ))

    def joined(parts: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(parts, ",", "null"), F.lit("]"))

    def parsed_once(item: Column, change: Callable[[Column, Column], Column]) -> Column:
        return _let(item, lambda item: _let(F.try_parse_json(item), lambda parsed: change(item, parsed)))

    return _with_phone(parsed_once(parsed_once(item, with_default), with_addresses))


def normalise_phones(item: Column, entity: str = "customer") -> Column:
    """Phones as text for every entity; a customer also gets the phones it lacks as null."""
    as_text = phones_as_text(item)
    return customer_phones(as_text) if entity == "customer" else as_text


def payload_cursor(payload: Column) -> Column:
    # the text is read once, not as often as its cast looks at it
    return _let(F.get_json_object(payload, f"$.{CURSOR_FIELD}"), safe_ts)


def updated_since(items: DataFrame, cursor: datetime | None) -> DataFrame:
    """Items changed at or after the cursor, and those that do not say when; staging keeps
    one of a record that comes again. All items without a cursor."""
    if cursor is None:
        return items
    # one comparison: a filter works out an expression as often as it is named
    return items.where(F.coalesce(payload_cursor(F.col("item")) >= instant(cursor), F.lit(True)))


def latest_cursor(rows: DataFrame) -> DataFrame:
    """One row: the latest ``updated_at`` of a batch of envelopes, or NULL."""
    return rows.agg(F.max(payload_cursor(F.col("payload"))).alias("latest_cursor"))
