"""Stable key hash (CRC-64/ISO) and partition choice as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: the reflected generator polynomial of CRC-64/ISO.
_POLYNOMIAL = 0xD800000000000000


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _byte_table() -> list[int]:
    table = []
    for byte in range(256):
        crc = byte
        for _ in range(8):
            crc = (crc >> 1) ^ (_POLYNOMIAL if crc & 1 else 0)
        table.append(_signed(crc))
    return table


def _long_array(values: list[int]) -> Column:
    """A literal array in one call; a literal per value takes a second for a table."""
    return F.from_json(F.lit(str(values)), "array<bigint>")


def _after_length(table: list[int]) -> list[int]:
    """The state after the length prefix, for keys of up to 255 bytes."""
    states = []
    for n_bytes in range(256):
        crc = (1 << 64) - 1
        for byte in n_bytes.to_bytes(8, "little"):
            crc = (table[(crc ^ byte) & 255] % (1 << 64)) ^ (crc >> 8)
        states.append(_signed(crc))
    return states


def key_hash(key: Column) -> Column:
    """64-bit hash of a string key, as a BIGINT holding the unsigned value.

    The hashed bytes are the key's length as eight little-endian bytes and then its
    UTF-8 bytes. NULL gives NULL. The state after the length is looked up for keys of
    up to 255 bytes; the bytes are read as Latin-1 characters, which is the cheapest
    way to byte values inside an expression.
    """
    values = _byte_table()
    table = _long_array(values)
    n_bytes = F.octet_length(key)

    def absorb(crc: Column, byte: Column) -> Column:
        index = crc.bitwiseXOR(byte).bitwiseAND(F.lit(255)).cast("int")
        return F.get(table, index).bitwiseXOR(F.shiftrightunsigned(crc, 8))

    length_bytes = F.array(
        *[F.shiftrightunsigned(n_bytes.cast("long"), 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    )
    start = F.when(
        n_bytes < 256, F.get(_long_array(_after_length(values)), n_bytes)
    ).otherwise(F.aggregate(length_bytes, F.lit(-1).cast("long"), absorb))
    chars = F.split(F.decode(F.encode(key, "UTF-8"), "ISO-8859-1"), "")
    body = F.when(n_bytes > 0, chars).otherwise(F.array().cast("array<string>"))
    crc = F.aggregate(body, start, lambda crc, char: absorb(crc, F.ascii(char).cast("long")))
    return F.bitwise_not(crc)


def unsigned_mod(value: Column, n: Column) -> Column:
    """``value mod n`` with the BIGINT read as unsigned; ``n`` is below 2**31."""
    half = F.shiftrightunsigned(value, 1)
    return ((half % n) * 2 + value.bitwiseAND(F.lit(1))) % n


def unsigned_text(value: Column) -> Column:
    """The unsigned decimal form of a BIGINT hash."""
    return F.conv(F.hex(value), 16, 10)


def partition_of_hash(value: Column, partitions: Sequence[str] | Column) -> Column:
    """``partitions[hash mod n]``; the list is given, or an array column."""
    ids = partitions if isinstance(partitions, Column) else F.array(*[F.lit(p) for p in partitions])
    return F.get(ids, unsigned_mod(value, F.size(ids).cast("long")).cast("int"))


def compound_key(*fields: Column) -> Column:
    """One key from several fields.

    Each field is written as its length and its text, so different field values never
    give the same key; NULL is told from the empty string. A single field is the key.
    """
    if len(fields) == 1:
        return fields[0].cast("string")
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.concat(*parts)
