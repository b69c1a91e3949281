"""Column expressions that the operators are built from; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hash names from the strongest to the weakest.
STRENGTHS = ("sha256", "sha1", "md5", "crc32")


def crc32_hex(content: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.crc32(content.cast("binary"))), 8, "0"))


def hashes(content: Column) -> list[Column]:
    """size, sha256, sha1, md5 and crc32 of a text's or binary's bytes."""
    b = content.cast("binary")
    return [F.octet_length(b).cast("long").alias("size"), F.sha2(b, 256).alias("sha256"), F.sha1(b).alias("sha1"), F.md5(b).alias("md5"), crc32_hex(b).alias("crc32")]


def body_hash(platform: Column, content: Column) -> Column:
    """MD5 of what an achievement service hashes: the content without an optional header of 16 or 512 bytes."""
    b, size = content.cast("binary"), F.octet_length(content.cast("binary"))
    behind = lambda n: F.md5(F.substr(b, F.lit(n + 1)))
    head = F.hex(F.substr(b, F.lit(1), F.lit(4)))
    return (
        F.when((platform == "nes") & (head == "4E45531A"), behind(16))
        .when((platform == "fds") & (head == "4644531A"), behind(16))
        .when(platform.isin("snes", "satellaview") & (size % 8192 == 512), behind(512))
        .when(platform.isin("pcengine", "supergrafx") & (size % 131072 == 512), behind(512))
        .otherwise(F.md5(b))
    )


def hex_or_zero(value: Column, digits: int) -> Column:
    """printf-like upper-case hex; null prints as zeros."""
    return F.format_string(f"%0{digits}X", F.coalesce(value.cast("long"), F.lit(0)))


def agrees(expected: dict[str, Column], actual: dict[str, Column]) -> Column:
    """Every field that is expected (not null) is equal, letters of either case."""
    out = F.lit(True)
    for name, value in expected.items():
        out = out & F.coalesce(F.lower(value.cast("string")) == F.lower(actual[name].cast("string")), value.isNull())
    return out


def strongest(expected: dict[str, Column]) -> Column:
    """Name of the strongest hash that is expected, or null."""
    return F.coalesce(*[F.when(expected[n].isNotNull(), F.lit(n)) for n in STRENGTHS if n in expected], F.lit(None).cast("string"))


def base_title(name: Column) -> Column:
    """The title before its first parenthesis."""
    return F.trim(F.regexp_replace(name, r"\s*\(.*$", ""))


def title_tags(name: Column) -> Column:
    return F.transform(F.regexp_extract_all(name, F.lit(r"\(([^()]*)\)"), 1), lambda x: F.trim(x))


def revision(name: Column) -> Column:
    """The X of (Rev X) or (vX); empty without one."""
    return F.regexp_extract(name, r"\((?:Rev |v)([0-9A-Za-z.]+)\)", 1)


def category(name: Column) -> Column:
    """``~tag~`` marks joined by a slash, or Official."""
    marks = F.regexp_extract_all(name, F.lit(r"~([^~]+)~"), 1)
    return F.when(F.size(marks) > 0, F.array_join(marks, "/")).otherwise(F.lit("Official"))


def safe_name(name: Column) -> Column:
    """Is a member name safe to write: relative, without colon, control characters, empty or dot parts?"""
    parts = F.split(F.replace(name, F.lit("\\"), F.lit("/")), "/")
    return name.isNotNull() & ~name.rlike(r"[\p{Cc}\p{Cf}:]") & ~F.exists(parts, lambda p: p.isin("", ".", ".."))


def under_root(path: Column, root: Column) -> Column:
    """Path lies under a folder; ASCII letters of either case are equal."""
    low = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.startswith(low(path), F.concat(low(root), F.lit("/")))


def valid_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()
