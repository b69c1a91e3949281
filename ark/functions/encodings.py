"""Encodings of single blocks: the shortest of four, or a difference to a similar block."""

from __future__ import annotations

import lzma
import zlib

FILTERS = [{"id": lzma.FILTER_LZMA2, "preset": 9}]
#: A difference must save this many bytes over the block's own encoding.
SAVES, DEEPEST = 16, 2


def _lzma(data: bytes) -> bytes:
    """With a dictionary no larger than the data: the same bytes as one of 64 MiB gives, which costs far more to set up."""
    size = min(64 << 20, max(4096, 1 << max(0, len(data) - 1).bit_length()))
    return lzma.compress(data, lzma.FORMAT_RAW, filters=[FILTERS[0] | {"dict_size": size}])


def plain(data: bytes) -> tuple[str, bytes]:
    """(codec, bytes): fill for one repeated byte, else the shortest of raw, zlib and lzma; ties in this order."""
    if data and data == data[:1] * len(data):
        return "fill", data[:1]
    tries = [("raw", data), ("zlib", zlib.compress(data, 9)), ("lzma", _lzma(data))]
    return min(tries, key=lambda t: len(t[1]))


def difference(data: bytes, base: bytes) -> tuple[str, bytes]:
    """The shorter of zlib and lzma over the bytewise difference; both blocks are of one size."""
    if len(data) != len(base):
        raise ValueError("a difference needs two blocks of one size")
    x = (int.from_bytes(data, "big") ^ int.from_bytes(base, "big")).to_bytes(len(data), "big")
    return min([("xor-zlib", zlib.compress(x, 9)), ("xor-lzma", _lzma(x))], key=lambda t: len(t[1]))


def decode(codec: str, data: bytes, size: int, base: bytes | None = None) -> bytes:
    kind = codec.removeprefix("xor-")
    if kind == "fill":
        out = data * size
    elif kind == "raw":
        out = data
    elif kind == "zlib":
        out = zlib.decompress(data)
    elif kind == "lzma":
        out = lzma.decompress(data, lzma.FORMAT_RAW, filters=FILTERS)
    else:
        raise ValueError(f"unknown codec {codec}")
    if len(out) != size:
        raise ValueError("a block is not of its size")
    if codec != kind:
        if base is None or len(base) != size:
            raise ValueError("a difference without its base")
        out = (int.from_bytes(out, "big") ^ int.from_bytes(base, "big")).to_bytes(size, "big")
    return out
