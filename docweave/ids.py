"""Identity: content hashes that every engine in the pipeline agrees on."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"


def canonical_json(value: object) -> str:
    """Sorted keys, no blanks, non-ASCII kept; anything unknown as its string."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def sha_text(*parts: object) -> str:
    """The hash of parts on the driver: strings as they are, all else as canonical JSON, each closed by a unit separator."""
    joined = "".join((p if isinstance(p, str) else canonical_json(p)) + UNIT for p in parts)
    return hashlib.sha256(joined.encode()).hexdigest()


def sha_id(*parts: Column | str) -> Column:
    """The same hash of string columns; give arrays and structs (fields in name order) through F.to_json, nulls count as JSON null."""
    closed = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("null")) for p in parts]
    return F.sha2(F.concat(*[F.concat(p.cast("string"), F.lit(UNIT)) for p in closed]), 256)


def short_key(sha: Column) -> Column:
    return F.concat(F.lit("k"), F.substring(sha, 1, 12))


def unit_fraction(sha: Column) -> Column:
    """A hash as a number from 0 to 1, by its first 52 bits; order by the hash itself where order is all that counts."""
    return F.conv(F.substring(sha, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
