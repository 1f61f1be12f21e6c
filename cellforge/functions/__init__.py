"""Column functions: tab split, key building, JSON, flat dates, prefixes, value codecs."""

from cellforge.functions.split import field, java_split
from cellforge.functions.scalars import (
    flat_from_millis,
    flat_from_ntz,
    flat_to_millis,
    join_key,
    key_prefix,
    mention_json,
    ntz_to_millis,
    numeric_prefix,
    relation_family,
    row_json,
)

__all__ = [
    "field",
    "java_split",
    "flat_from_millis",
    "flat_from_ntz",
    "flat_to_millis",
    "join_key",
    "key_prefix",
    "mention_json",
    "ntz_to_millis",
    "numeric_prefix",
    "relation_family",
    "row_json",
]
