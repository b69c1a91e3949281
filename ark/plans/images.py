"""Small binary images that carry a number in their headers, for queries that read it back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

SYSTEMS: dict[str, Callable[[int], bytes]] = {}


def system(f: Callable[[int], bytes]) -> Callable[[int], bytes]:
    SYSTEMS[f.__name__] = f
    return f


def noise(k: int, size: int) -> bytearray:
    """Bytes that depend on the number."""
    return bytearray((b"%09d;" % k * (size // 10 + 1))[:size])


def put(image: bytearray, at: int, data: bytes) -> None:
    image[at : at + len(data)] = data


@system
def nes(k: int) -> bytes:
    banks, tiles = 1 + k % 3, k % 2
    return b"NES\x1a" + bytes([banks, tiles, k % 16 << 4 | tiles << 1, 0]) + bytes(8) + bytes(noise(k, banks * 16384 + tiles * 8192))


@system
def snes(k: int) -> bytes:
    image = noise(k, 0x8000)
    put(image, 0x7FB0, b"ZZ" + b"%04d" % (k % 10000) + bytes(10) + b"TITLE %05d" % (k % 100000) + b" " * 10 + bytes([0x20, 2, 5, 1, 1, 0x33, k % 4]) + b"\xff\xff\0\0")
    put(image, 0x7FFC, b"\0\x80")
    total = sum(image) & 0xFFFF
    put(image, 0x7FDC, (total ^ 0xFFFF).to_bytes(2, "little") + total.to_bytes(2, "little"))
    return bytes(image)


@system
def megadrive(k: int) -> bytes:
    image = noise(k, 0x1000)
    put(image, 0x100, b"SEGA MEGA DRIVE (C)TEST".ljust(0x100))
    put(image, 0x120, b"HOME %05d" % (k % 100000))
    put(image, 0x150, b"AWAY %05d" % (k % 100000))
    put(image, 0x1A0, bytes(4) + (0xFFF).to_bytes(4, "big") + bytes(8))
    put(image, 0x18E, (sum(image[0x200::2]) * 256 + sum(image[0x201::2]) & 0xFFFF).to_bytes(2, "big"))
    return bytes(image)


@system
def sega32x(k: int) -> bytes:
    image = bytearray(megadrive(k))
    put(image, 0x3C0, b"MARS CHECK MODE ")
    put(image, 0x18E, (sum(image[0x200::2]) * 256 + sum(image[0x201::2]) & 0xFFFF).to_bytes(2, "big"))
    return bytes(image)


@system
def gb(k: int) -> bytes:
    image = noise(k, 0x8000)
    put(image, 0x134, b"N%06d" % (k % 1000000) + bytes(8) + bytes([0x80 * (k % 2)]) + b"01" + bytes([0, 0x13, 0, 2, 1, 0x33, k % 8]))
    image[0x14D] = -(sum(image[0x134:0x14D]) + 25) & 0xFF
    put(image, 0x14E, (sum(image) - image[0x14E] - image[0x14F] & 0xFFFF).to_bytes(2, "big"))
    return bytes(image)


@system
def gba(k: int) -> bytes:
    image = noise(k, 0x2000)
    put(image, 0xA0, b"GAME%06d\0\0" % (k % 1000000) + b"A%03d" % (k % 1000) + b"01" + b"\x96" + bytes(9) + bytes([k % 4]) + bytes(3))
    put(image, 0x1000, b"FLASH1M_V103" if k % 2 else b"EEPROM_V124\0")
    image[0xBD] = -(sum(image[0xA0:0xBD]) + 0x19) & 0xFF
    return bytes(image)


@system
def fds(k: int) -> bytes:
    def side(number: int) -> bytes:
        return (b"\1*NINTENDO-HVC*" + b"\x01%03d " % (k % 1000) + bytes([k % 5, number, 0, 0, 0, 0x0F]) + bytes(5) + bytes.fromhex("610501") + b"\x49").ljust(56, b"\0") + b"\2\7" + bytes(65442)

    return b"".join(map(side, range(1 + k % 2)))


@system
def satellaview(k: int) -> bytes:
    image = noise(k, 0x8000)
    put(image, 0x7FB0, b"ZZ" + bytes(14) + b"BS %06d" % (k % 1000000) + b" " * 7 + bytes(4) + b"\0\x80" + bytes([(1 + k % 12) << 4, 0x08, 0x20, 0, 0x33, 0]) + b"\xff\xff\0\0")
    return bytes(image)


@system
def mastersystem(k: int) -> bytes:
    image = noise(k, 0x8000)
    image[0x7FE0:0x7FF0] = bytes(16)
    put(image, 0x7FF0, b"TMR SEGA\0\0\0\0" + bytes([k % 10 << 4 | k // 10 % 10, 0x12, 0x50 | k % 16, 0x4C]))
    put(image, 0x7FFA, (sum(image[:0x7FF0]) & 0xFFFF).to_bytes(2, "little"))
    return bytes(image)


@system
def wswan(k: int) -> bytes:
    image = noise(k, 0x10000)
    put(image, 0xFFF0, bytes([0xEA, 0, 0, 0, 0, 0, k % 200, k % 2, k % 256, 3, 0, 0x10, 4, 1]))
    put(image, 0xFFFE, (sum(image[:-2]) & 0xFFFF).to_bytes(2, "little"))
    return bytes(image)


@system
def ngp(k: int) -> bytes:
    return b"COPYRIGHT BY SNK CORPORATION" + (0x200040).to_bytes(4, "little") + (k % 65536).to_bytes(2, "little") + bytes([k % 7, 0x10 * (k % 2)]) + b"NG%06d" % (k % 1000000) + bytes(4 + 92)


@system
def pokemini(k: int) -> bytes:
    image = noise(k, 0x3000)
    put(image, 0x2100, b"MN")
    put(image, 0x21A4, b"NINTENDO" + b"M%02d" % (k % 100) + b"EJP"[k % 3 : k % 3 + 1] + b"MINI%06d" % (k % 1000000) + bytes(6))
    return bytes(image)


@system
def pcengine(k: int) -> bytes:
    return bytes(512 * (k % 2)) + bytes(noise(k, 8192 * (1 + k % 3)))


@system
def msx1(k: int) -> bytes:
    return b"AB" + (0x4010 + k % 1000).to_bytes(2, "little") + bytes(12) + bytes(noise(k, 16368))


@system
def virtualboy(k: int) -> bytes:
    image = noise(k, 1 << 15)
    put(image, (1 << 15) - 0x220, b"VB %06d" % (k % 1000000) + b" " * 11 + bytes(5) + b"01" + b"V%03d" % (k % 1000) + bytes([k % 3]))
    return bytes(image)


@system
def supracan(k: int) -> bytes:
    return bytes(noise(k, 100 + k % 50))


def images(rows: DataFrame, key: str, platform: str) -> DataFrame:
    """(path, platform, content) of an image for each number; made on the executors."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                part = batch[key].iloc[at : at + 100]
                yield pd.DataFrame({"path": part, "platform": platform, "content": [SYSTEMS[platform](int(k)) for k in part]})

    return rows.select(key).mapInPandas(make, "path long, platform string, content binary")
