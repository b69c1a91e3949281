"""Published lists: XML reference lists and exports, dump-log and names CSV, achievement JSON.

Schemas are explicit: inference would turn hex digests into numbers. Rows that break a rule are kept with their
fault, so one bad row does not end a load; ``strict`` raises on the first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.expressions import category
from ..shared import stored

DIGESTS = {"crc32": 8, "md5": 32, "sha1": 40, "sha256": 64}
GAME = """_name string, _cloneof string, _romof string, description string, release array<struct<_name string, _region string>>,
rom array<struct<_name string, _size string, _crc string, _md5 string, _sha1 string, _sha256 string, _status string, _merge string>>"""
HEADER = "name string, version string, author string, description string, clrmamepro array<struct<_header string, _VALUE string>>"
LARGEST = str(2**63 - 1)


def faults(size: Column, digests: dict[str, Column]) -> Column:
    """Names of the fields that break their form; nulls are fine."""
    whole = size.rlike("^[0-9]+$") & ((F.length(F.ltrim(size, F.lit("0"))) < 19) | ((F.length(F.ltrim(size, F.lit("0"))) == 19) & (F.ltrim(size, F.lit("0")) <= LARGEST)))
    checks = [F.when(size.isNotNull() & ~whole, F.lit("size"))]
    checks += [F.when(v.isNotNull() & ~v.rlike(f"^[0-9a-fA-F]{{{DIGESTS[n]}}}$"), F.lit(n)) for n, v in digests.items()]
    return F.array_compact(F.array(*checks))


def checked(df: DataFrame, strict: bool) -> DataFrame:
    if not strict:
        return df
    return df.where(F.when(F.size("faults") == 0, True).otherwise(F.raise_error(F.concat(F.lit("invalid fields: "), F.array_join("faults", ", ")))))


def reference_list(spark: SparkSession, path: str, mode: str = "auto") -> dict[str, DataFrame]:
    """sets, games and roms of XML reference lists (one row of sets per file).

    The mode comes from ``(Headered)`` or ``(Headerless)`` in the list's name; the scope of its digests from the mode
    and the header-skip rule. Entity declarations and unknown rules are faults of the set.
    """
    read = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).option("inferSchema", "false").schema(schema).load(path).withColumn("file", F.input_file_name())
    rules = F.array_compact(F.coalesce(F.transform("clrmamepro", lambda c: c["_header"]), F.array()))
    auto = F.when(F.contains("name", F.lit("(Headerless)")), "headerless").when(F.contains("name", F.lit("(Headered)")), "headered").otherwise("unspecified")
    disk = F.array_contains(rules, "No-Intro_FDS.xml")
    listed_mode = F.when(disk, "headerless").otherwise(auto) if mode == "auto" else F.lit(mode)
    sets = read("header", HEADER).withColumn("rules", rules).withColumn("mode", listed_mode)
    scope = F.when(disk, "fds_after_header").when(F.col("mode") == "headerless", "nes_after_header").otherwise("full")
    odd = F.exists("rules", lambda r: ~r.isin("No-Intro_FDS.xml", "No-Intro_NES.xml")) | (F.array_contains("rules", "No-Intro_NES.xml") & (F.col("mode") != "headerless"))
    entities = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.contains(F.upper("value"), F.lit("<!ENTITY")).alias("entities"))
    sets = sets.withColumn("scope", scope).join(entities, "file", "left").withColumn("faults", F.array_compact(F.array(F.when(odd, F.lit("rule")), F.when(F.col("entities"), F.lit("entities")))))
    games = read("game", GAME).unionByName(read("machine", GAME)).select("file", F.col("_name").alias("name"), F.col("_cloneof").alias("cloneof"), F.col("_romof").alias("romof"), "description", "release", "rom")
    r = games.select("file", F.col("name").alias("game"), F.posexplode("rom").alias("ordinal", "r"))
    names = {"crc32": "crc", "md5": "md5", "sha1": "sha1", "sha256": "sha256"}
    raw = {n: F.col(f"r._{x}") for n, x in names.items()}
    roms = r.select("file", "game", F.col("ordinal").cast("long"), F.col("r._name").alias("name"), F.expr("try_cast(r._size as bigint)").alias("size"), *[F.lower(v).alias(n) for n, v in raw.items()], F.col("r._status").alias("status"), F.col("r._merge").alias("merge"), faults(F.col("r._size"), raw).alias("faults"))
    return {"sets": sets.drop("clrmamepro", "entities"), "games": games.drop("rom"), "roms": roms}


EXPORT = "file string, kind string, archive_id string, title string, attrs map<string,string>, source_id string, details map<string,string>, serials map<string,string>, files array<map<string,string>>, fault string"
#: Characters of export files whose records are handed over at once.
EXPORT_CHARS = 4 << 20


def export_records(texts: DataFrame) -> DataFrame:
    """Archives with their sources and releases, from export files given as (file, value): headers and data in one file
    without a common root. Broken files give one row with a fault. Files are dealt over the tasks by name."""

    def attributes(node: ElementTree.Element | None) -> dict:
        return {} if node is None else dict(node.attrib)

    def rows(name: str, text: str) -> Iterator[dict]:
        if re.search(r"<!(ENTITY|DOCTYPE)", text, re.IGNORECASE):
            raise ValueError("entity or document type declared")
        root = ElementTree.fromstring("<all>" + re.sub(r"^\s*<\?xml[^>]*\?>", "", text) + "</all>")
        data = root.find("datafile")
        if data is None:
            raise ValueError("no data")
        for game in data.iterfind("game"):
            archive = attributes(game.find("archive"))
            parts = [n for n in game if n.tag in ("source", "release")] or [None]
            for part in parts:
                details = attributes(part.find("details")) if part is not None else {}
                yield {"file": name, "kind": part.tag if part is not None else "archive", "archive_id": archive["number"], "title": game.get("name"), "attrs": archive, "source_id": details.get("id"), "details": details,
                       "serials": attributes(part.find("serials")) if part is not None else {}, "files": [dict(f.attrib) for f in part.iterfind("file")] if part is not None else [], "fault": None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = pa.map_(pa.string(), pa.string())
        kinds = {"string": pa.string(), "map<string,string>": pairs, "array<map<string,string>>": pa.list_(pairs)}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ", 1) for c in EXPORT.split(", "))])
        for batch in batches:
            found, held = [], 0
            for name, text in zip(batch["file"].to_pylist(), batch["value"].to_pylist(), strict=True):
                try:
                    found += list(rows(name, text))
                except (ValueError, KeyError, ElementTree.ParseError) as error:
                    found.append(dict.fromkeys(schema.names) | {"file": name, "fault": str(error)})
                held += len(text)
                if held > EXPORT_CHARS:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found, held = [], 0
            if found:
                yield pa.RecordBatch.from_pylist(found, schema)

    return texts.select("file", "value").repartition("file").mapInArrow(run, EXPORT)


def export_files(records: DataFrame) -> DataFrame:
    """(archive_id, source_id, file_id, size, digests, bad, faults) of the files; a file id with two contents is a fault."""
    f = records.where("fault is null").select("archive_id", "source_id", F.explode("files").alias("f"))
    raw = {n: F.col("f")[n] for n in DIGESTS}
    out = f.select("archive_id", "source_id", F.col("f")["id"].alias("file_id"), F.expr("try_cast(f['size'] as bigint)").alias("size"), *[F.lower(v).alias(n) for n, v in raw.items()], F.coalesce(F.col("f")["bad"] == "1", F.lit(False)).alias("bad"), faults(F.col("f")["size"], raw).alias("faults"))
    out = stored(out, "files")  # read twice below
    clash = out.groupBy("file_id").agg(F.count_distinct(F.struct("size", *DIGESTS)).alias("n")).where("n > 1").select("file_id", F.lit(True).alias("clash"))
    return out.join(clash, "file_id", "left").withColumn("faults", F.when(F.col("clash"), F.array_append("faults", F.lit("conflict"))).otherwise(F.col("faults"))).drop("clash")


def dump_state(status: Column) -> Column:
    trusted = r"^Trusted \((\d+)\) \((Verified|Not Verified)\)$"
    plain = F.create_map(*map(F.lit, ("Not verified", "unverified", "Bad", "bad", "No dump", "no_dump", "Missing", "missing")))
    return F.when(F.regexp_extract(status, trusted, 2) == "Verified", "verified").when(status.rlike(trusted), "trusted_unverified").otherwise(F.coalesce(plain[status], F.lit("unknown")))


def dump_log(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(ID, Name, state, trusted, parts, serials, faults): multi-file sizes and digests are paired by position."""
    raw = spark.read.csv(path, sep=";", header=True, quote='"', escape="\\", enforceSchema=False)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    sizes, md5s = F.split("Size", "-"), F.split("MD5", "-")
    pairs = F.when(F.col("Size") == "!no_file", F.array().cast("array<struct<size:bigint,md5:string>>")).otherwise(
        F.zip_with(sizes, md5s, lambda s, m: F.struct(s.try_cast("bigint").alias("size"), F.lower(m).alias("md5"))))
    broken = F.exists(pairs, lambda p: p["size"].isNull() | ~F.coalesce(p["md5"].rlike("^[0-9a-f]{32}$"), F.lit(False)))
    again = raw.groupBy("ID").agg(F.count("*").alias("__n"))
    fault = F.array_compact(F.array(F.when((F.col("Size") != "!no_file") & (F.size(sizes) != F.size(md5s)), F.lit("unbalanced")), F.when(broken, F.lit("identity")), F.when(F.col("__n") > 1, F.lit("repeated"))))
    serials = [c for c in raw.columns if c not in ("ID", "Name", "Size", "MD5", "Status")]
    trusted = F.regexp_extract("Status", r"^Trusted \((\d+)\) \((?:Verified|Not Verified)\)$", 1)
    out = raw.join(again, "ID").select("ID", "Name", dump_state(F.col("Status")).alias("state"), F.when(trusted != "", trusted.cast("int")).alias("trusted"), pairs.alias("parts"),
                                       (F.to_json(F.struct(*serials)) if serials else F.lit("{}")).alias("serials"), fault.alias("faults"))
    return checked(out, strict)


def names_list(spark: SparkSession, path: str) -> DataFrame:
    """(row, name_en, name_cn) of a two-column CSV with one of two header spellings; rows are numbered from 2 by place in the file."""
    raw = spark.read.csv(path, header=True, enforceSchema=False, mode="FAILFAST", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    head = [c.lstrip("﻿").strip() for c in raw.columns]
    if head not in (["Name EN", "Name CN"], ["EN Name", "CN Name"]):
        raise ValueError(f"unexpected columns {head}")
    rows = raw.toDF("name_en", "name_cn").withColumn("__at", F.monotonically_increasing_id())
    parts = rows.withColumn("__part", F.shiftright("__at", 33))
    sizes = parts.groupBy("__part").agg(F.count("*").alias("n"))  # one row per split of the file
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("start"))
    return parts.join(F.broadcast(starts), "__part").select((F.col("start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 2).alias("row"), "name_en", "name_cn")


ACHIEVEMENT = "ID bigint, Title string, ConsoleID int, NumAchievements int, NumLeaderboards int, Points int, DateModified string, Hashes array<string>"


def achievement_games(spark: SparkSession, path: str, console: int) -> tuple[DataFrame, DataFrame]:
    """(games, hashes) of saved responses; a game of another console is an error. Hashes are lower-case and distinct."""
    # the digest stands in a step of its own, or it would be taken again for each game
    text = spark.read.text(path, wholetext=True).select(F.sha2("value", 256).alias("snapshot"), "value")
    text = text.select("snapshot", F.explode(F.from_json("value", f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in ACHIEVEMENT.split(', '))}>>")).alias("g"))
    games = text.select("snapshot", "g.*")
    games = games.where(F.when(F.col("ConsoleID") == console, True).otherwise(F.raise_error(F.lit("the response has games of another console"))))
    hashes = games.select("snapshot", F.col("ID").alias("game_id"), F.explode("Hashes").alias("hash")).select("snapshot", F.lower("hash").alias("hash"), "game_id").dropDuplicates(["snapshot", "hash"])
    listed = games.select("snapshot", F.col("ID").alias("game_id"), F.col("Title").alias("title"), category(F.col("Title")).alias("category"), F.coalesce("NumAchievements", F.lit(0)).alias("achievements"), F.col("NumLeaderboards").alias("leaderboards"), F.col("Points").alias("points"), F.col("DateModified").alias("modified"))
    return listed, hashes
