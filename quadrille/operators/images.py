"""Width and height of encoded images, from their headers."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Signatures, and the JPEG markers that carry the frame size.
_PNG = b"\x89PNG\r\n\x1a\n"
_JPEG = b"\xff\xd8"
_GIF = (b"GIF87a", b"GIF89a")
_FRAME_MARKERS = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
_BARE_MARKERS = frozenset(range(0xD0, 0xDA)) | {0x01}


def header_size(data: bytes | None) -> tuple[int, int] | None:
    """``(width, height)`` of a PNG, JPEG or GIF; None for anything else."""
    if not data:
        return None
    if data.startswith(_PNG) and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data.startswith(_GIF) and len(data) >= 10:
        return struct.unpack("<HH", data[6:10])
    if not data.startswith(_JPEG):
        return None
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in _BARE_MARKERS:
            at += 2
        elif marker in _FRAME_MARKERS:
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


_SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


@F.pandas_udf(_SIZE)
def _sizes(images: pd.Series) -> pd.DataFrame:
    found = [header_size(image) or (None, None) for image in images]
    return pd.DataFrame(found, columns=["width", "height"]).astype("Int32")


def image_size(image: str = "image") -> Column:
    """STRUCT<width, height>."""
    return _sizes(F.col(image))


def with_image_size(images: DataFrame, image: str = "image") -> DataFrame:
    return images.withColumn("_size", image_size(image)).select(*images.columns, "_size.width", "_size.height")
