"""Words of texts as bytes: runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _folded(byte: int) -> int:
    if 0x41 <= byte <= 0x5A:
        return byte + 0x20
    return byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20


#: Every byte of a separator becomes a blank; bytes of longer characters stay, so runs of bytes are runs of characters.
FOLDED = bytes(map(_folded, range(256)))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(FOLDED).split() if text else []


def utf8(df: DataFrame, text: str) -> Column:
    """A text column as UTF-8 bytes."""
    return df[text].cast("string").cast("binary")
