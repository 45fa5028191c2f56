"""Deterministic name-based identifiers (RFC 4122 version 5)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of index point ids.
POINT_NAMESPACE = "6f9619ff-8b86-d011-b42d-00cf4fc964ff"


def uuid5(name: Column, namespace: str = POINT_NAMESPACE) -> Column:
    """Version-5 UUID of ``name`` as text, the same as Python's ``uuid.uuid5``."""
    prefix = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.substring(F.lit("89ab"), nibble % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
