"""Accessors for the multi-valued metadata map. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.schemas import META, PERSISTED_KEYS


def empty_meta() -> Column:
    return F.create_map().cast(META)


def meta_of(**values: str | Column) -> Column:
    """A literal map with one value per key."""
    cells: list[Column] = []
    for key, value in values.items():
        cells += [F.lit(key), F.array(value if isinstance(value, Column) else F.lit(value))]
    return F.create_map(*cells).cast(META) if cells else empty_meta()


def _or_empty(meta: Column) -> Column:
    return F.coalesce(meta, empty_meta())


def meta_values(meta: Column, key: str) -> Column:
    return F.try_element_at(meta, F.lit(key))


def meta_first(meta: Column, key: str) -> Column:
    """First value, NULL when the key is missing or its array is empty."""
    return F.get(meta_values(meta, key), F.lit(0))


def meta_true(meta: Column, key: str) -> Column:
    """First value equals "true" whatever the case; missing counts as false."""
    return F.coalesce(F.lower(meta_first(meta, key)) == "true", F.lit(False))


def meta_is_true_text(meta: Column, key: str) -> Column:
    """The store's query form: any value of the key is exactly "true"."""
    return F.coalesce(F.array_contains(meta_values(meta, key), "true"), F.lit(False))


def meta_remove(meta: Column, *keys: str) -> Column:
    return F.map_filter(_or_empty(meta), lambda k, _v: ~k.isin(*keys))


def meta_set(meta: Column, key: str, value: str | Column) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.map_concat(meta_remove(meta, key), F.create_map(F.lit(key), F.array(value.cast("string"))))


def meta_set_values(meta: Column, key: str, values: Column) -> Column:
    return F.map_concat(meta_remove(meta, key), F.create_map(F.lit(key), values.cast("array<string>")))


def meta_add(meta: Column, key: str, value: str | Column) -> Column:
    """Append to the values of a key, keeping those already there."""
    value = value if isinstance(value, Column) else F.lit(value)
    have = F.coalesce(meta_values(meta, key), F.array().cast("array<string>"))
    return meta_set_values(meta, key, F.concat(have, F.array(value.cast("string"))))


def meta_update(meta: Column, changes: Mapping[str, Column], remove: Mapping[str, Column] | None = None) -> Column:
    """Set several single values in one go; a NULL value leaves its key as it is.

    ``remove`` maps keys to the condition under which they go.
    """
    entries = F.filter(
        F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in changes.items()]),
        lambda e: e["value"].isNotNull(),
    )
    keys = F.transform(entries, lambda e: e["key"])

    def stays(key: Column, _value: Column) -> Column:
        drop = F.lit(False)
        for name, cond in (remove or {}).items():
            drop = drop | ((key == name) & cond)
        return ~F.array_contains(keys, key) & ~drop

    new = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["key"].alias("key"), F.array(e["value"]).alias("value")))
    )
    return F.map_concat(F.map_filter(_or_empty(meta), stays), new)


def persist_metadata(meta: Column, keys: Sequence[str] = PERSISTED_KEYS) -> Column:
    return F.map_filter(_or_empty(meta), lambda k, _v: k.isin(*keys))


def outlink_metadata(
    parent_url: Column,
    parent_meta: Column,
    track_path: bool = True,
    track_depth: bool = False,
    transfer: Sequence[str] = (),
) -> Column:
    """Metadata of a child link: transferred keys, the chain of contributing documents, the depth."""
    out = F.map_filter(_or_empty(parent_meta), lambda k, _v: k.isin(*transfer)) if transfer else empty_meta()
    if track_path:
        path = F.coalesce(meta_values(parent_meta, "url.path"), F.array().cast("array<string>"))
        out = meta_set_values(out, "url.path", F.concat(path, F.array(parent_url)))
    if track_depth:
        depth = F.coalesce(F.expr("0") + F.try_to_number(meta_first(parent_meta, "depth"), F.lit("999999")), F.lit(0))
        out = meta_set(out, "depth", (depth + 1).cast("int").cast("string"))
    return out
