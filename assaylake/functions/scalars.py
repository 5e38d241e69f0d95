"""References, keys, hashes and small conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaylake.config import EngineConfig
from assaylake.functions.fingerprint import fingerprint64

REFERENCE_PATTERN = r"(?:^|/)([^/]+)$"

# Comparator symbols and their short codes; any other symbol has no code.
COMPARATOR_CODES = {"<": "lt", "<=": "lte", ">": "gt", ">=": "gte", "=": "eq"}


def reference_id(reference: Column) -> Column:
    """Last path segment of ``Type/id``, a URL or a bare id; NULL when it is empty."""
    return F.nullif(F.regexp_extract(reference, REFERENCE_PATTERN, 1), F.lit(""))


def md5_key(value: Column) -> Column:
    """The leading half of the MD5 digest."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 16), 16, -10).cast("bigint")


KEY_HASHES = {"md5": md5_key, "farm": fingerprint64}


def surrogate_key(value: Column, config: EngineConfig | None = None) -> Column:
    """Signed 64-bit key by the hash that ``config`` names, MD5 by default. NULL stays NULL."""
    name = config.key_hash if config else "md5"
    if name not in KEY_HASHES:
        raise ValueError(f"key_hash is {name!r}, not one of {sorted(KEY_HASHES)}")
    return KEY_HASHES[name](value)


def person_source(value: Column, config: EngineConfig) -> Column:
    """The identifier as text, or its peppered SHA-256 when hashing is on."""
    plain = value.cast("string")
    if not config.hash_person_source_value:
        return plain
    return F.sha2(F.concat(F.coalesce(plain, F.lit("")), F.lit(config.require_pepper())), 256)


def joined_key(*parts: Column) -> Column:
    """Parts separated by ``|``, with NULL as the empty string."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("|"), F.coalesce(part, F.lit(""))]
    return F.concat(*pieces[1:])


def decimal_text(value: Column) -> Column:
    """A decimal of nine places as plain digits without trailing zeros, alike under all session settings."""
    size = F.abs(value)
    whole = F.floor(size)
    rest = size % F.lit(1).cast("decimal(1,0)")  # keeps all nine places, which a difference would not
    parts = (rest * F.lit(1_000_000_000).cast("decimal(10,0)")).cast("bigint").cast("string")
    fraction = F.rtrim(F.lpad(parts, 9, "0"), F.lit("0"))
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, whole.cast("decimal(38,0)").cast("string"), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)))


def required_cast(value: Column, kind: str, what: str) -> Column:
    """The cast value; text that cannot be cast fails the job under all session settings, NULL stays NULL."""
    failure = F.raise_error(F.concat(F.lit(f"bad {what}: "), value)).cast(kind)
    return F.when(value.isNotNull(), F.coalesce(value.try_cast(kind), failure))


def comparator_code(symbol: Column) -> Column:
    pairs = [F.lit(item) for pair in COMPARATOR_CODES.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), symbol)


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def concept(value: int) -> Column:
    return F.lit(value).cast("bigint")
