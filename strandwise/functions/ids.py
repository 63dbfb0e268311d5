"""Deterministic content-hash identities as column expressions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Joins the parts of a hashed payload; the ASCII unit separator occurs in no identifier.
UNIT = "\x1f"


def hyphenated(digest: Column) -> Column:
    """The first 32 hex digits of a digest in groups of 8, 4, 4, 4 and 12."""
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def content_uuid(payload: Column) -> Column:
    """Identity of a text by MD5; null stays null."""
    return F.when(payload.isNotNull(), hyphenated(F.md5(payload)))


def json_uuid(*parts: Column) -> Column:
    """Identity of a list of texts: SHA-256 of its compact JSON, as `python_json_uuid` computes it."""
    return hyphenated(F.sha2(F.to_json(F.array(*parts)), 256))


def python_json_uuid(parts: list) -> str:
    """The same in plain Python, for code that makes rows outside Spark; non-ASCII text stays as it is."""
    h = hashlib.sha256(json.dumps(parts, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"


def entity_key(entity_type: Column, taxonomy: Column, id_type: Column, identifier: Column) -> Column:
    """The natural key of an entity as a JSON list; an absent taxonomy counts as the empty text."""
    return F.to_json(F.array(entity_type.cast("string"), F.coalesce(taxonomy.cast("string"), F.lit("")), id_type.cast("string"), identifier))


def relation_key(subject: Column, predicate: Column, obj: Column) -> Column:
    return F.concat(subject, F.lit("|"), predicate.cast("string"), F.lit("|"), obj)


def unit_joined(*parts: Column) -> Column:
    """Parts with separators between them; a null part counts as the empty text."""
    return F.concat_ws(UNIT, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def sorted_text(values: Column, separator: str = "|") -> Column:
    """Distinct values in bytewise order in one text; nothing gives null. The caller bounds their number."""
    out = F.array_join(F.sort_array(F.collect_set(values)), separator)
    return F.when(F.count(values) > 0, out)
