"""What the header readers share: fields of a byte image, and the collected result."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

Fields = Iterable[tuple[str, int, str]]


class Image:
    """Numbers and texts at places of a byte string. A place may be negative: from the end."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def bytes(self, at: int, n: int) -> bytes:
        at = at if at >= 0 else self.size + at
        return self.data[at : at + n]

    def le(self, at: int, n: int = 2) -> int:
        return int.from_bytes(self.bytes(at, n), "little")

    def be(self, at: int, n: int = 2) -> int:
        return int.from_bytes(self.bytes(at, n), "big")

    def byte(self, at: int) -> int:
        return self.bytes(at, 1)[0]

    def text(self, at: int, n: int) -> str | None:
        """ASCII, else Shift-JIS, without padding; neither is null."""
        raw = self.bytes(at, n).rstrip(b"\0 ")
        for name in ("ascii", "shift_jis"):
            try:
                return raw.decode(name).strip()
            except UnicodeDecodeError:
                continue
        return None

    def read(self, base: int, fields: Fields) -> dict:
        """Fields as name, offset, kind: ``text:n``, ``hex:n``, ``le:n``, ``be:n`` or ``u8``."""
        out = {}
        for name, offset, kind in fields:
            what, _, n = kind.partition(":")
            at = base + offset
            out[name] = self.byte(at) if what == "u8" else self.bytes(at, int(n)).hex() if what == "hex" else getattr(self, what)(at, int(n))
        return out


@dataclass
class Reading:
    """A reader's result. Status: valid, warning (valid with warnings), invalid or unclassified."""

    format: str
    status: str = "unclassified"
    components: list[tuple[str, int, int]] = field(default_factory=list)  # kind, offset, size
    hardware: dict | None = None
    warnings: list[str] = field(default_factory=list)

    def part(self, kind: str, offset: int, size: int) -> None:
        if size > 0:
            self.components.append((kind, offset, size))

    def warn(self, condition: object, code: str) -> None:
        if condition:
            self.warnings.append(code)

    def closed(self) -> Reading:
        """A header was found: valid, or warning."""
        self.status = "warning" if self.warnings else "valid"
        return self

    def row(self) -> dict:
        return {
            "format": self.format, "parse_status": self.status, "warnings": self.warnings,
            "components": [{"kind": k, "offset": o, "size": n} for k, o, n in self.components],
            "hardware": None if self.hardware is None else json.dumps(self.hardware, ensure_ascii=False, sort_keys=True),
        }


def unknown(format: str, image: Image, code: str) -> Reading:
    out = Reading(format, warnings=[code])
    out.part("file", 0, image.size)
    return out
