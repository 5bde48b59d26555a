"""Shared pieces of the feed conformers.

Bronze table ``raw_board_payloads``: company_slug, ats_source, run_id,
profile, fetched_at, http_status, error_kind, page_kind (list|detail), term,
page_no, item_key, body. ``body`` is parsed once to VARIANT; polymorphic
fields are read with ``try_variant_get`` (NULL on a wrong shape).

Every conformer returns the conformed-job shape plus lineage columns:
canonical_url, raw_url, title, description, posted_at, employment_type,
location, country, company, pay, company_slug, ats_source, run_id,
fetched_at, page_no, item_pos.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ...functions.text import nonblank_once, py_strip

BRONZE_SCHEMA = (
    "company_slug string, ats_source string, run_id string, profile string, fetched_at timestamp, "
    "http_status int, error_kind string, page_kind string, term string, page_no int, item_key string, body string"
)
CONFORMED = ["canonical_url", "raw_url", "title", "description", "posted_at", "employment_type", "location", "country", "company", "pay"]
LINEAGE = ["company_slug", "ats_source", "run_id", "fetched_at", "page_no", "item_pos"]


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_array(v: Column) -> Column:
    """By a cast that looks at one level; the type's text names all levels."""
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def is_object(v: Column, path: str = "$") -> Column:
    """By a cast to a struct, which takes no field of the object out."""
    return F.try_variant_get(v, path, "struct<_:variant>").isNotNull()


def truthy_object(v: Column) -> Column:
    """A non-empty JSON object (Python truthiness of a dict)."""
    return F.coalesce(F.cardinality(F.try_variant_get(v, "$", "map<string,variant>")) > 0, F.lit(False))


def vget(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def vs(v: Column, path: str = "$") -> Column:
    """Field as text (numbers and booleans cast; JSON null -> NULL)."""
    return F.try_variant_get(v, path, "string")


def vstr(v: Column, path: str = "$") -> Column:
    """Field only when it is a JSON string (``isinstance(x, str)``). The field is
    taken out of the payload once."""
    found = F.filter(F.array(vget(v, path)), lambda x: vtype(x) == F.lit("STRING"))
    return F.try_variant_get(F.get(found, F.lit(0)), "$", "string")


def label(v: Column, path: str = "$") -> Column:
    """``label`` else ``name`` for an object; NULL if they are empty, or otherwise."""
    return F.coalesce(*[nonblank_once(vs(v, f"{path}.{k}")) for k in ("label", "name")])


def join_str_parts(*parts: Column) -> Column:
    """E13 over variant string parts: only JSON strings that are not blank."""
    return F.array_join(F.filter(F.array(*parts), lambda p: py_strip(p) != F.lit("")), ", ")
