"""The platforms: how their files are named, read, cut and grouped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB = 1 << 20


@dataclass(frozen=True)
class Platform:
    code: str
    name: str
    hardware: str | None  # table of its header fields
    extensions: tuple[str, ...]
    block: int  # bytes of a deduplicated block
    cap: int  # bytes of a solid group
    console: int | None  # of the achievement service; some platforms share one
    strangers: tuple[str, ...] = ()  # extensions of another platform's files in shared folders


# Names, extensions, storage settings and console numbers.
PLATFORMS = {p.code: p for p in (
    Platform("nes", "Nintendo Entertainment System / Famicom", "nes", (".nes", ".unf", ".unif", ".bin"), 8192, 256 * MIB, 7, (".fds", ".qd")),
    Platform("snes", "Super Nintendo Entertainment System / Super Famicom", "snes", (".sfc", ".smc", ".swc", ".fig", ".bin", ".rom"), 65536, 128 * MIB, 3, (".bs",)),
    Platform("megadrive", "Sega Mega Drive / Genesis", "md", (".md", ".gen", ".smd", ".bin", ".rom"), 65536, 256 * MIB, 1),
    Platform("gb", "Nintendo Game Boy", "gb", (".gb", ".gbc", ".sgb", ".bin", ".rom"), 65536, 256 * MIB, 4),
    Platform("gbc", "Nintendo Game Boy Color", "gb", (".gbc", ".gb", ".cgb", ".bin", ".rom"), 65536, 256 * MIB, 6),
    Platform("gba", "Nintendo Game Boy Advance", "gba", (".gba", ".agb", ".gbc", ".gb", ".bin", ".srl", ".mb"), 1048576, 256 * MIB, 5),
    Platform("fds", "Nintendo Family Computer Disk System", "fds", (".fds", ".qd", ".bin"), 65536, 128 * MIB, 81, (".nes", ".unf", ".unif", ".nsf")),
    Platform("satellaview", "Nintendo Satellaview", "bsx", (".bs", ".sfc", ".bin"), 32768, 256 * MIB, 3, (".sfc", ".smc", ".swc", ".fig")),
    Platform("mastersystem", "Sega Master System / Mark III", "sms", (".sms", ".bin"), 131072, 256 * MIB, 11),
    Platform("sega32x", "Sega 32X", "md", (".32x", ".bin"), 32768, 256 * MIB, 10),
    Platform("wswan", "Bandai WonderSwan", "ws", (".ws", ".bin"), 65536, 256 * MIB, 53, (".wsc",)),
    Platform("wswanc", "Bandai WonderSwan Color", "ws", (".wsc", ".ws", ".bin"), 65536, 128 * MIB, 53, (".ws",)),
    Platform("ngp", "SNK NeoGeo Pocket", "ngp", (".ngp", ".bin"), 131072, 32 * MIB, 14, (".ngc",)),
    Platform("ngpc", "SNK NeoGeo Pocket Color", "ngp", (".ngc", ".ngp", ".bin"), 131072, 256 * MIB, 14, (".ngp",)),
    Platform("pokemini", "Nintendo Pokemon Mini", "pokemini", (".min",), 262144, 32 * MIB, 24),
    Platform("gamegear", "Sega Game Gear", "sms", (".gg", ".sms", ".bin"), 32768, 256 * MIB, 15),
    Platform("pcengine", "NEC PC Engine / TurboGrafx-16", "pce", (".pce", ".bin"), 131072, 256 * MIB, 8, (".sgx",)),
    Platform("supergrafx", "NEC PC Engine SuperGrafx", "pce", (".sgx", ".pce", ".bin"), 131072, 32 * MIB, 8, (".pce",)),
    Platform("msx1", "Microsoft MSX", "msx", (".rom", ".mx1", ".mx2", ".dsk", ".cas", ".bin"), 65536, 64 * MIB, 29),
    Platform("msx2", "Microsoft MSX2", "msx", (".rom", ".mx2", ".mx1", ".dsk", ".cas", ".bin"), 131072, 128 * MIB, 29),
    Platform("virtualboy", "Nintendo Virtual Boy", "vb", (".vb", ".vboy", ".bin"), 262144, 128 * MIB, 28),
    Platform("gameandwatch", "Nintendo Game & Watch", None, (".bin",), 4096, 32 * MIB, None),
    Platform("supracan", "Funtech Super A'Can", None, (".bin",), 65536, 32 * MIB, None),
)}


def header_size(platform: str, content: Column) -> Column:
    """Bytes before the body: 16 of a NES or disk header, 512 of a copier; 0 without one."""
    n = F.octet_length(content)
    starts = lambda magic: F.substr(content, F.lit(1), F.lit(len(magic))) == magic
    rules = {
        "nes": (starts(b"NES\x1a"), 16), "fds": (starts(b"FDS\x1a"), 16), "snes": (n % 1024 == 512, 512), "pcengine": (n % 8192 == 512, 512), "supergrafx": (n % 8192 == 512, 512),
        "megadrive": ((n % 16384 == 512) & (F.substr(content, F.lit(9), F.lit(2)) == b"\xaa\xbb"), 512),
    }
    rules["sega32x"] = rules["megadrive"]
    if platform not in rules:
        return F.lit(0)
    condition, size = rules[platform]
    return F.when(condition, size).otherwise(0)


def cuts(platform: str, content: Column) -> Column:
    """Offsets at which blocks restart, so bodies with and without a header, and shared disk sides, share blocks."""
    head = header_size(platform, content)
    if platform != "fds":
        return F.array(head.cast("int"))
    body = F.octet_length(content) - head
    side = F.when(body % 65536 == 0, 65536).otherwise(65500)
    return F.transform(F.sequence(F.lit(0), F.greatest((F.ceil(body / side) - 1).cast("int"), F.lit(0))), lambda k: (head + k * side).cast("int"))


def belongs(platform: str, name: Column) -> Column:
    """Is a file named like the platform's own, and not like another's?"""
    p, low = PLATFORMS[platform], F.lower(name)
    ends = lambda extensions: F.coalesce(*[F.when(F.endswith(low, F.lit(e)), True) for e in extensions], F.lit(False)) if extensions else F.lit(False)
    return ends(p.extensions) & ~ends(p.strangers)
