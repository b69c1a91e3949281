"""Header readers on images that carry a number: what is read back equals what SQL says of the number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import body_hash
from ..headers import components, read_headers
from ..platforms import PLATFORMS, belongs, cuts
from .images import images
from .registry import ORACLES, QUERIES, Tables, query

K = "s_suppkey"
MD = {"title_domestic": "printf('HOME %05d', {k} % 100000)", "title_overseas": "printf('AWAY %05d', {k} % 100000)", "copyright": "'(C)TEST'", "rom_end": "4095", "checksum_valid": "1"}

#: Of each system: format, status, parts as kind:offset:size, and fields of the header, as SQL of the number k.
READ: dict[str, tuple[str, str, str, dict[str, str]]] = {
    "nes": ("'ines'", "'valid'", "'header:0:16,prg:16:' || 16384 * (1 + {k} % 3) || CASE WHEN {k} % 2 = 1 THEN ',chr:' || 16 + 16384 * (1 + {k} % 3) || ':8192' ELSE '' END", {"mapper": "{k} % 16", "battery": "{k} % 2", "prg_rom_size": "16384 * (1 + {k} % 3)", "chr_rom_size": "8192 * ({k} % 2)"}),
    "snes": ("'snes'", "'valid'", "'rom:0:32768'", {"title": "printf('TITLE %05d', {k} % 100000)", "game_code": "printf('%04d', {k} % 10000)", "maker_code": "'ZZ'", "layout": "'lorom'", "version": "{k} % 4", "ram_size_declared": "2048", "checksum_valid": "1"}),
    "megadrive": ("'md'", "'valid'", "'vectors:0:256,header:256:256,program:512:3584'", MD),
    "sega32x": ("'32x'", "'valid'", "'vectors:0:256,header:256:256,program:512:3584'", MD),
    "gb": ("CASE WHEN {k} % 2 = 1 THEN 'gbc' ELSE 'gb' END", "'valid'", "'vectors:0:256,header:256:80,program:336:32432'", {"title": "printf('N%06d', {k} % 1000000)", "version": "{k} % 8", "cgb_flag": "128 * ({k} % 2)", "cartridge_type_name": "'MBC3+RAM+BATTERY'", "ram_size_declared": "8192", "header_checksum_valid": "1", "global_checksum_valid": "1"}),
    "gba": ("'gba'", "'valid'", "'header:0:192,program:192:8000'", {"title": "printf('GAME%06d', {k} % 1000000)", "game_code": "printf('A%03d', {k} % 1000)", "version": "{k} % 4", "save_types": "CASE WHEN {k} % 2 = 1 THEN 'FLASH1M_V103' ELSE 'EEPROM_V124' END", "complement_valid": "1"}),
    "fds": ("'fds'", "'valid'", "'side:0:65500' || CASE WHEN {k} % 2 = 1 THEN ',side:65500:65500' ELSE '' END", {"game_code": "printf('%03d', {k} % 1000)", "revision": "{k} % 5", "sides": "1 + {k} % 2", "manufacturing_date": "'1986-05-01'", "country_code": "73"}),
    "satellaview": ("'bs'", "'valid'", "'file:0:32768'", {"title": "printf('BS %06d', {k} % 1000000)", "broadcast_month": "1 + {k} % 12", "broadcast_day": "1", "mapping": "'lorom'", "checksum_pair_valid": "1"}),
    "mastersystem": ("'sms'", "'valid'", "'file:0:32768'", {"product_code": "'512' || ({k} % 10) || ({k} // 10 % 10)", "version": "{k} % 16", "region": "'SMS Export'", "checksum_valid": "1"}),
    "wswan": ("CASE WHEN {k} % 2 = 1 THEN 'wsc' ELSE 'ws' END", "'warning'", "'program:0:65520,footer:65520:16'", {"publisher_id": "{k} % 200", "color": "{k} % 2", "game_id": "{k} % 256", "save_type": "'EEPROM'", "checksum_valid": "1"}),
    "ngp": ("CASE WHEN {k} % 2 = 1 THEN 'ngpc' ELSE 'ngp' END", "'valid'", "'header:0:64,program:64:76'", {"title": "printf('NG%06d', {k} % 1000000)", "software_id": "{k} % 65536", "sub_code": "{k} % 7", "color": "{k} % 2", "start_address": "2097216"}),
    "pokemini": ("'min'", "'valid'", "'reserved:0:8448,header:8448:208,program:8656:3632'", {"title": "printf('MINI%06d', {k} % 1000000)", "region_code": "substr('EJP', 1 + {k} % 3, 1)", "game_code": "printf('M%02d', {k} % 100) || substr('EJP', 1 + {k} % 3, 1)", "nintendo": "1"}),
    "pcengine": ("'pce'", "CASE WHEN {k} % 2 = 1 THEN 'warning' ELSE 'valid' END", "CASE WHEN {k} % 2 = 1 THEN 'copier_header:0:512,program:512:' ELSE 'program:0:' END || 8192 * (1 + {k} % 3)", {"banks": "1 + {k} % 3", "rom_size": "8192 * (1 + {k} % 3)", "copier_header": "{k} % 2"}),
    "msx1": ("'msx_cart'", "'valid'", "'file:0:16384'", {"init": "16400 + {k} % 1000", "media": "'cartridge'", "statement": "0"}),
    "virtualboy": ("'vb'", "'valid'", "'program:0:32224,header:32224:32,vectors:32256:512'", {"title": "printf('VB %06d', {k} % 1000000)", "game_code": "printf('V%03d', {k} % 1000)", "maker_code": "'01'", "version": "{k} % 3"}),
    "supracan": ("'bin'", "'unclassified'", "'file:0:' || 100 + {k} % 50", {}),
}


def shown(read: DataFrame, fields: list[str]) -> DataFrame:
    parts = F.array_join(F.transform("components", lambda c: F.concat_ws(":", c["kind"], c["offset"].cast("string"), c["size"].cast("string"))), ",")
    return read.select("path", "platform", "format", "parse_status", parts.alias("parts"), *[F.get_json_object("hardware", f"$.{f}").alias(f) for f in fields])


def _said(system: str, key: str = K) -> str:
    form, status, parts, fields = READ[system]
    cells = [f"{form} AS format", f"{status} AS parse_status", f"{parts} AS parts", *[f"({sql})::VARCHAR AS {f}" for f, sql in fields.items()]]
    return f"SELECT {key} AS path, '{system}' AS platform, {', '.join(cells).replace('{k}', key)} FROM supplier"


def _reader(system: str):
    return lambda spark, folder: shown(read_headers(images(Tables(spark, folder).supplier, K, system)), list(READ[system][3]))


for _system in READ:
    QUERIES[f"read_{_system}"] = _reader(_system)
    ORACLES[f"read_{_system}"] = _said(_system)


@query("""SELECT s_suppkey AS path, CASE s_suppkey % 3 WHEN 0 THEN 'nes' WHEN 1 THEN 'ngp' ELSE 'no such platform' END AS platform, CASE WHEN s_suppkey % 3 = 0 THEN 'ines' WHEN s_suppkey % 3 = 2 THEN 'bin' WHEN s_suppkey % 2 = 1 THEN 'ngpc' ELSE 'ngp' END AS format,
CASE WHEN s_suppkey % 3 = 2 THEN 'unclassified' ELSE 'valid' END AS parse_status FROM supplier""")
def read_dispatch(t: Tables) -> DataFrame:
    """Files of several platforms in one scan; an unknown platform is a plain file."""
    nes, ngp = (images(t.supplier.where(F.col(K) % 3 == n), K, p) for n, p in ((0, "nes"), (1, "ngp")))
    plain = images(t.supplier.where(F.col(K) % 3 == 2), K, "supracan").withColumn("platform", F.lit("no such platform"))
    return read_headers(nes.union(ngp).union(plain)).select("path", "platform", "format", "parse_status")


@query("""SELECT s_suppkey AS path, unnest(range(3)) AS ordinal, unnest(['vectors', 'header', 'program']) AS kind, unnest([256, 256, 3584])::BIGINT AS size FROM supplier""")
def read_components(t: Tables) -> DataFrame:
    files = images(t.supplier, K, "megadrive")
    return components(files, read_headers(files)).where("length(sha256) = 64").select("path", F.col("ordinal").cast("long").alias("ordinal"), "kind", "size")


@query("""SELECT doc_id, md5(CASE doc_id % 3 WHEN 0 THEN text ELSE CASE WHEN doc_id % 3 = 1 THEN 'no header here: ' ELSE '' END || text END) AS body_md5 FROM documents""")
def body_hashes(t: Tables) -> DataFrame:
    """The hash behind a known header: 16 bytes of a headed file of one system, nothing of others."""
    head = F.when(F.col("doc_id") % 3 == 0, F.lit(b"NES\x1a............")).when(F.col("doc_id") % 3 == 1, F.lit(b"no header here: ")).otherwise(F.lit(b""))
    rows = t.documents.select("doc_id", F.concat(head, F.col("text").cast("binary")).alias("c"))
    return rows.select("doc_id", body_hash(F.lit("nes"), F.col("c")).alias("body_md5"))


@query("""SELECT s_suppkey, CASE s_suppkey % 2 WHEN 1 THEN '0,65500' ELSE '0' END AS disk_cuts, CASE s_suppkey % 2 WHEN 1 THEN '512' ELSE '0' END AS card_cuts FROM supplier""")
def block_cuts(t: Tables) -> DataFrame:
    """Where blocks restart: disk sides, and the end of a copier's header."""
    listed = lambda c: F.array_join(c.cast("array<string>"), ",")
    disks = images(t.supplier, K, "fds").select(F.col("path").alias(K), listed(cuts("fds", F.col("content"))).alias("disk_cuts"))
    cards = images(t.supplier, K, "pcengine").select(F.col("path").alias(K), listed(cuts("pcengine", F.col("content"))).alias("card_cuts"))
    return disks.join(cards, K)


@query("""SELECT p_partkey, p_partkey % 4 < 2 AS of_snes, p_partkey % 4 = 2 AS of_satellaview FROM part""")
def platform_filter(t: Tables) -> DataFrame:
    """Whose file is it, by its extension? A neighbour's are left out."""
    ends = F.element_at(F.array(F.lit(".SFC"), F.lit(".smc"), F.lit(".bs"), F.lit(".txt")), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = t.part.select("p_partkey", F.concat("p_name", ends).alias("n"))
    return rows.select("p_partkey", belongs("snes", F.col("n")).alias("of_snes"), belongs("satellaview", F.col("n")).alias("of_satellaview"))


@query("""SELECT unnest(['nes', 'snes', 'megadrive', 'gb', 'gbc', 'gba', 'fds', 'satellaview', 'mastersystem', 'sega32x', 'wswan', 'wswanc', 'ngp', 'ngpc', 'pokemini', 'gamegear', 'pcengine', 'supergrafx', 'msx1', 'msx2', 'virtualboy', 'gameandwatch', 'supracan']) AS code,
unnest([7, 3, 1, 4, 6, 5, 81, 3, 11, 10, 53, 53, 14, 14, 24, 15, 8, 8, 29, 29, 28, NULL, NULL])::BIGINT AS console, unnest([8, 64, 64, 64, 64, 1024, 64, 32, 128, 32, 64, 64, 128, 128, 256, 32, 128, 128, 64, 128, 256, 4, 64])::BIGINT AS block_kib""")
def platform_registry(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(p.code, p.console, p.block >> 10) for p in PLATFORMS.values()], "code string, console long, block_kib long")
