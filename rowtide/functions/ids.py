"""Log positions and deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of the event ids. Another one gives other ids for the same changes.
EVENT_ID_NAMESPACE = "8a1f4e5c-c0de-4cdc-a000-000000000001"


def lsn_text(lsn: Column) -> Column:
    """``HI/LO`` in upper-case hexadecimal without padding; null stays null."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(4294967295))))


def name_digest(name: Column, namespace: str = EVENT_ID_NAMESPACE) -> Column:
    """Hex SHA-1 of the namespace followed by the name."""
    return F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))


def digest_uuid(digest: Column) -> Column:
    """A version 5 UUID from the first 16 bytes of a hex digest.

    Take the digest from a column of an earlier ``select``: it is used several times here.
    """
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def name_uuid(name: Column, namespace: str = EVENT_ID_NAMESPACE) -> Column:
    return digest_uuid(name_digest(name, namespace))
