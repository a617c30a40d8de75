"""Message body codecs. Spark SQL has no inflate function, so the bytes go through
Arrow batches; everything after the bytes is a Column expression again."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

XML_START = (b"<?xml", b"<P")
AUTO, GZIP, RAW, WRAPPED = 32 + 15, 16 + 15, -15, 15
# One-byte masks some senders apply to the deflated part.
XOR_KEYS = (0xFD, 0x8B, 0x1F, 0x00)
HEADER_BYTES = 10


def _inflate(body: bytes | None, wbits: int) -> bytes | None:
    try:
        return zlib.decompress(body, wbits)
    except (zlib.error, TypeError):
        return None


@F.pandas_udf(T.BinaryType())
def inflate(bodies: pd.Series) -> pd.Series:
    """zlib or gzip body, detected by its header; NULL when it does not inflate."""
    return bodies.map(lambda body: _inflate(body, AUTO))


def _attempts(body: bytes):
    """(strategy, candidate text) in the order in which they are to be tried."""
    head, rest = body[:HEADER_BYTES], body[HEADER_BYTES:]
    if head[:2] == b"\x1f\xfd":
        yield "gzip_header", _inflate(b"\x1f\x8b" + head[2:] + rest, GZIP)
        yield "header_zlib", _inflate(rest, WRAPPED)
        yield "header_deflate", _inflate(rest, RAW)
        for key in XOR_KEYS:
            unmasked = rest.translate(bytes(byte ^ key for byte in range(256)))
            yield f"xor_{key:02x}", _inflate(unmasked, RAW)
    yield "deflate", _inflate(body, RAW)
    yield "zlib", _inflate(body, WRAPPED)
    yield "gzip", _inflate(body, GZIP)


def _decode(body: bytes | None) -> tuple[str | None, bytes | None]:
    if body is None:
        return None, None
    if body.strip().startswith(XML_START):
        return "plain", body
    return next(
        ((name, text) for name, text in _attempts(body) if text and text.startswith(XML_START)),
        (None, None),
    )


@F.pandas_udf(T.StructType([T.StructField("strategy", T.StringType()), T.StructField("body", T.BinaryType())]))
def inflate_any(bodies: pd.Series) -> pd.DataFrame:
    """First strategy whose result looks like feed XML, with that result."""
    return pd.DataFrame(list(map(_decode, bodies)), columns=["strategy", "body"])


def as_text(body: Column) -> Column:
    """UTF-8 text, or ISO-8859-1 for bytes that are not valid UTF-8."""
    return F.coalesce(F.try_validate_utf8(body.cast("string")), F.decode(body, "ISO-8859-1"))


def latin1_bytes(text: Column) -> Column:
    """Bytes of a string in which every character stands for one byte."""
    return F.encode(text, "ISO-8859-1")


def preview(message: Column, limit: int = 200) -> Column:
    """One-line preview of a message given as a string.

    NULL and over-long messages are labelled; a string holding gzip bytes one per
    character is inflated first and falls back to the raw string if that fails.
    """
    gzipped = message.startswith("\x1f\u008b")
    inflated = F.when(gzipped, inflate(F.when(gzipped, latin1_bytes(message))))
    # undecodable bytes are dropped, not replaced
    decoded = F.regexp_replace(F.make_valid_utf8(inflated.cast("string")), "\ufffd", "")

    def shorten(text: Column, label: str) -> Column:
        head = F.concat(F.lit(label), F.substring(text, 1, limit), F.lit("..."))
        return F.when(F.length(text) > limit, head).otherwise(text)

    return (
        F.when(message.isNull(), F.lit("Received null message"))
        .when(inflated.isNotNull(), shorten(decoded, "Decoded (decompressed): "))
        .otherwise(shorten(message, "Received message: "))
    )
