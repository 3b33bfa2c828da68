"""Typed fields out of JSON payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions.numeric import rounded_int


def _is_variant(docs: DataFrame, payload: str) -> bool:
    return docs.schema[payload].dataType.typeName() == "variant"


def with_fields(docs: DataFrame, fields: Mapping[str, str], payload: str = "payload") -> DataFrame:
    """Add typed columns read from a payload column: a variant, parsed when it was landed, or JSON text, parsed here once.

    ``fields`` maps a column name to ``int``, ``double``, ``date`` or ``string``; all values are read as text, then cast.
    Empty text is NULL; integers are rounded, as numeric text such as ``2021.0`` is common.
    """
    known = _is_variant(docs, payload)
    parsed = docs if known else docs.withColumn("_doc", F.try_parse_json(payload))

    def typed(name: str, kind: str) -> Column:
        text = F.nullif(F.try_variant_get(payload if known else "_doc", _path(name), "string"), F.lit(""))
        if kind == "int":
            return rounded_int(text)
        return text if kind == "string" else text.try_cast(kind)

    found = parsed.withColumns({n: typed(n, k) for n, k in fields.items()})
    return found if known else found.drop("_doc")


def _path(name: str) -> str:
    return f"$['{name}']"


def has_keys(payload: Column, keys: Sequence[str]) -> Column:
    """True when the JSON text is an object with all the keys, also with a null value."""
    present = F.json_object_keys(payload)
    test = F.array_contains(present, keys[0])
    for key in keys[1:]:
        test = test & F.array_contains(present, key)
    return F.coalesce(test, F.lit(False))


def variant_has_keys(payload: Column | str, keys: Sequence[str]) -> Column:
    """The same for a variant: a key with a null value gives a variant, a missing key gives none."""
    test = F.lit(True)
    for key in keys:
        test = test & F.try_variant_get(payload, _path(key), "variant").isNotNull()
    return test


def holding(docs: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """Documents that have all the keys."""
    return docs.filter(variant_has_keys(payload, keys) if _is_variant(docs, payload) else has_keys(F.col(payload), keys))


def first_field(*cols: Column) -> Column:
    """First non-NULL among alternative field names."""
    return F.coalesce(*cols)
