"""Sequential diffs and the recovery of edited headers."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.archives import crc_shift, header_edits

FIELDS = ("size", "crc32", "md5", "sha1", "sha256")


def sequential_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(pair, old_id, new_id, change) of lists that are compared by ``pair``; ids, name and the five fields in each.

    New rows in order of their ids take the old row of their name (the last of equal names), or else, if they have a
    strong digest, an unused one of equal fields; each old row is taken once.
    """

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("id"), b.sort_values("id")
        clean = lambda v: None if pd.isna(v) else v
        sign = lambda r: tuple(clean(getattr(r, f)) for f in FIELDS)
        olds = {r.id: r for r in a.itertuples()}
        by_name = {r.name.casefold(): r.id for r in olds.values()}
        by_sign: dict[tuple, list] = {}
        for r in olds.values():
            by_sign.setdefault(sign(r), []).append(r.id)
        used, out = set(), []
        for r in b.itertuples():
            found = by_name.get(r.name.casefold())
            if found is None or found in used:
                strong = clean(r.sha1) is not None or clean(r.sha256) is not None
                found = next((k for k in by_sign.get(sign(r), ()) if k not in used), None) if strong else None
            if found is None:
                out.append((None, r.id, "added"))
                continue
            used.add(found)
            o = olds[found]
            change = "checksum_changed" if sign(o) != sign(r) else "unchanged" if o.name == r.name else "case_changed" if o.name.casefold() == r.name.casefold() else "renamed"
            out.append((o.id, r.id, change))
        out += [(k, None, "removed") for k in olds if k not in used]
        return pd.DataFrame([(key[0], *x) for x in out], columns=["pair", "old_id", "new_id", "change"]).astype({"old_id": "Int64", "new_id": "Int64"})

    columns = ("pair", "id", "name", *FIELDS)
    return old.select(*columns).groupBy("pair").cogroup(new.select(*columns).groupBy("pair")).applyInPandas(run, "pair string, old_id long, new_id long, change string")


def recovered_headers(candidates: DataFrame, changed: int = 2, four: bool = False) -> DataFrame:
    """(target_id, header, method): headers that give a target's full digest with a known body.

    ``candidates``: target_id, header (a known one of 16 bytes), body, crc32 and sha1 of the target. The CRC's
    linearity finds the few edits worth hashing; only an equal SHA-1 counts. The first candidate that fits wins.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for target, header, body, crc, sha1 in zip(batch["target_id"], batch["header"], batch["body"], batch["crc32"], batch["sha1"], strict=True):
                header, body, want = bytes(header), bytes(body), int(crc, 16)
                body_crc = zlib.crc32(body)
                good = lambda h: hashlib.sha1(h + body).hexdigest() == sha1  # noqa: B023, E731
                if crc_shift(zlib.crc32(header), len(body)) ^ body_crc == want and good(header):
                    out.append((target, header, "reused"))
                    continue
                found = next(filter(good, header_edits(header, body_crc, len(body), want, changed)), None)
                method = "few_bytes"
                if found is None and four:
                    found, method = next(filter(good, header_edits(header, body_crc, len(body), want, 4, least=4)), None), "four_bytes"
                if found is not None:
                    out.append((target, found, method))
            yield pd.DataFrame(out, columns=["target_id", "header", "method"])

    found = candidates.select("target_id", "header", "body", "crc32", "sha1").mapInPandas(run, "target_id long, header binary, method string")
    return found.groupBy("target_id").agg(F.min(F.struct("method", "header")).alias("m")).select("target_id", "m.header", "m.method")


def pair_checks(pairs: DataFrame) -> DataFrame:
    """(headered_id, headerless_id, status) of published pairs: does a known header before the body give the headered file's CRC?

    ``pairs``: headered_id, headerless_id, header, body_crc32, body_size (null where no body is stored), crc32. By the
    algebra of CRC-32 no body is read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, b, header, body_crc, size, want in zip(*(batch[c] for c in ("headered_id", "headerless_id", "header", "body_crc32", "body_size", "crc32")), strict=True):
                if header is None:
                    status = "no_header"
                elif pd.isna(size) or body_crc is None:
                    status = "body_unavailable"
                else:
                    whole = crc_shift(zlib.crc32(bytes(header)), int(size)) ^ int(body_crc, 16)
                    status = "verified" if whole == int(want, 16) else "mismatch"
                out.append((a, b, status))
            yield pd.DataFrame(out, columns=["headered_id", "headerless_id", "status"])

    kinds = dict(pairs.dtypes)
    return pairs.mapInPandas(run, f"headered_id {kinds['headered_id']}, headerless_id {kinds['headerless_id']}, status string")
