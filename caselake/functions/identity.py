"""Hashes, surrogate keys, checked personal numbers and keyed pseudonyms."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UNKNOWN_KEY = -1

# Text that stands for NULL inside hashed text, and the separator.
NULL_IN_CONTENT = "<null>"
NULL_IN_KEY = "<unknown>"
SEPARATOR = "||"

BLOCK_BYTES = 64  # SHA-256 block, RFC 2104


def _joined(columns, null_text: str) -> Column:
    return F.concat_ws(SEPARATOR, *(F.coalesce(c.cast("string"), F.lit(null_text)) for c in columns))


def _framed(columns, null_text: str) -> Column:
    """Each value with its length in front, so no value can imitate the separator."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit(null_text)))
    return F.concat_ws(SEPARATOR, *parts)


def content_hash(names, framed: bool = False) -> Column:
    """SHA-256 over the named columns in name order.

    The default text format gives the ids existing data already carries. ``framed`` adds
    lengths, for new data whose values may contain the separator.
    """
    columns = [F.col(name) for name in sorted(names)]
    return F.sha2((_framed if framed else _joined)(columns, NULL_IN_CONTENT), 256)


def record_identity(system: Column, year: Column, content: Column) -> Column:
    """Equal content in two reference years is two records."""
    return F.sha2(_joined([system, year, content], NULL_IN_CONTENT), 256)


def surrogate_key(names) -> Column:
    """64-bit hash of attributes; -1 only when every attribute is NULL.

    A hash that happens to equal the unknown member moves to -2, so its rows keep a
    dimension member of their own.
    """
    columns = [F.col(name) for name in names]
    hashed = F.xxhash64(_joined(columns, NULL_IN_KEY))
    unknown = F.lit(UNKNOWN_KEY).cast("long")
    kept = F.when(hashed == unknown, F.lit(-2).cast("long")).otherwise(hashed)
    return F.when(F.coalesce(*(c.cast("string") for c in columns)).isNull(), unknown).otherwise(kept)


def natural_key(code: Column) -> Column:
    return F.coalesce(code.try_cast("long"), F.lit(UNKNOWN_KEY).cast("long"))


def hash_shard(identifier: Column, shards: int) -> Column:
    """Stable shard number from the first 32 bits of SHA-256."""
    head = F.substring(F.sha2(identifier.cast("string"), 256), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % shards).cast("int")


def _with_value(value: Column, use) -> Column:
    """Evaluate ``value`` once and use it many times inside one expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _check_digit(digits, weights) -> Column:
    total = sum((d * w for d, w in zip(digits, weights)), F.lit(0))
    return (11 - total % 11) % 11 % 10


def _digits_of(text: Column, count: int):
    return [F.substring(text, i + 1, 1).try_cast("int") for i in range(count)]


def person_number(raw: Column) -> Column:
    """Eleven digits with both mod-11 check digits right, or NULL."""
    def checked(number: Column) -> Column:
        d = _digits_of(number, 11)
        sound = (
            number.rlike("^[0-9]{11}$")
            & ~number.rlike(r"^([0-9])\1{10}$")
            & (d[9] == _check_digit(d[:9], range(10, 1, -1)))
            & (d[10] == _check_digit(d[:10], range(11, 1, -1)))
        )
        return F.when(sound, number)

    return _with_value(F.regexp_replace(raw, "[^0-9]", ""), checked)


def with_check_digits(nine_digits: Column) -> Column:
    """Complete nine base digits to a person number."""
    def next_digit(text: Column, count: int) -> Column:
        digit = _check_digit(_digits_of(text, count), range(count + 1, 1, -1))
        return F.concat(text, digit.cast("string"))

    ten = _with_value(nine_digits, lambda text: next_digit(text, 9))
    return _with_value(ten, lambda text: next_digit(text, 10))


def key_pads(key: bytes) -> tuple[bytes, bytes]:
    """Inner and outer padded keys of RFC 2104."""
    block = (hashlib.sha256(key).digest() if len(key) > BLOCK_BYTES else key).ljust(BLOCK_BYTES, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def keyring(spark: SparkSession, keys: dict[str, bytes]) -> DataFrame:
    """One row per key version. Keys travel as data, so no plan or log prints them."""
    rows = [(version, *map(bytearray, key_pads(key))) for version, key in sorted(keys.items())]
    return spark.createDataFrame(rows, "key_version string, inner_pad binary, outer_pad binary")


def hmac_sha256(message: Column, inner_pad: Column, outer_pad: Column) -> Column:
    """HMAC-SHA-256 as hex, composed from ``sha2``."""
    inner = F.sha2(F.concat(inner_pad, F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(outer_pad, F.unhex(inner)), 256)


def with_fingerprint(df: DataFrame, number: str, ring: DataFrame, version: str,
                     name: str = "fingerprint") -> DataFrame:
    """Replace a person number by its keyed fingerprint under one key version.

    The two pads come from the keyring by scalar subquery: read once, used on every row. A version that
    the ring lacks fails the query, as a null fingerprint would read as an unknown person.
    """
    key = ring.filter(F.col("key_version") == version)
    unknown = F.raise_error(F.lit(f"The keyring has no version {version}.")).cast("binary")
    inner, outer = (F.coalesce(key.select(pad).scalar(), unknown) for pad in ("inner_pad", "outer_pad"))
    return df.withColumns({
        "key_version": F.lit(version), name: hmac_sha256(F.col(number), inner, outer),
    }).drop(number)


def person_token(fingerprint: Column) -> Column:
    """Token derived from the fingerprint: a retried task or a second writer gets the same one."""
    return F.concat(F.lit("pt_"), F.substring(F.sha2(F.concat(F.lit("token:"), fingerprint), 256), 1, 32))
