"""Operator 8, suffix-array dedup: bytes covered by a string of ``length`` that starts anywhere else too.

Candidates. Each window of ``length`` bytes is anchored at the smallest hash of its grams (the leftmost of equal
ones), so equal windows have equal anchors at equal offsets. Only anchors whose gram stands twice or more can belong
to a repeat; the rest, most of a corpus, goes after one count of hashes. A run of windows with one anchor is one
entry: its suffix from the anchor on, and the bytes before the anchor.

Sorting. Tasks sort their entries and exchange them as front-coded runs, dealt by gram. A loser tree merges the runs
of a bucket, comparing two suffixes only behind the prefix that both are known to share with the last output, so the
merged order comes with its common prefix lengths. The bytes before the anchors are ranked likewise. Windows at one
offset are equal where both common prefixes are long enough; each offset is settled for all entries of a bucket at
once, never by pairs. All repeats are found here, byte by byte; hashes only deal and never decide.

Hot grams. A gram with over ``bucket`` entries is dealt over as many buckets as it needs, merged in each, and of equal
entries one goes on to meet those of the other buckets. Where over ``bucket`` different entries are left, each is cut in
two by the offsets of its windows and dealt by the gram and all bytes that such windows have in common, so entries of
different surroundings part and those within one passage become equal. That ends at single windows at the latest.

Defined cases: null and empty texts, and texts shorter than ``length``, lose nothing; very long texts are taken in
passes that overlap, so they lose what shorter ones would; repeated rows are copies of each other, so both lose all;
of equal hashes the leftmost gram is the anchor; matches never cross documents; other columns pass unchanged through
``drop_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, forget, lean, sheltered, stored, text_bytes, with_counts

LENGTH, GRAM = 400, 64
#: Bytes of one numpy pass; anchors hold their place in it in 20 bits.
PASS = 1 << 20
#: Entries of one bucket on average, and of one gram above which it is dealt over several buckets.
BUCKET = 5_000
RUN_BYTES = 16 << 20
NO_ID = 2**63 - 1
_ODD = 0x5851F42D4C957F2D  # an odd multiplier; its powers are invertible modulo 2**64


class Hasher:
    """Hashes of substrings from prefix sums of byte values times powers, modulo 2**64."""

    def __init__(self, salt: int = 1):
        self.values = np.random.default_rng(salt).integers(1, 1 << 63, 256, np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                row = np.full(n, base, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]

    def prefixes(self, s: np.ndarray) -> np.ndarray:
        up, _ = self.powers(len(s) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(self.values[s] * up[: len(s)])])

    def between(self, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the bytes a to b - 1."""
        _, down = self.powers(len(sums))
        return mix((sums[b] - sums[a]) * down[a])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` neighbours: minima from block starts and to block ends, put together."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors_of(text: bytes, hasher: Hasher, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """Columns h (gram), at (anchor), first and last window start."""
    out = []
    whole = np.frombuffer(text, np.uint8)
    for start in range(0, max(0, len(whole) - length + 1), PASS - length + 1):
        s = whole[start : start + PASS]
        if len(s) < length:
            break
        sums, place = hasher.prefixes(s), np.arange(len(s) - gram + 1)
        grams = hasher.between(sums, place, place + gram)
        low = np.uint64(PASS - 1)
        least = sliding_minimum((grams & ~low) | place.astype(np.uint64), length - gram + 1)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [len(least) - 1]])
        at = (least[first] & low).astype(np.int64)
        out.append([grams[at].view(np.int64), at + start, first + start, last + start])
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4


def keyed(docs: DataFrame) -> DataFrame:
    """__id and __mark name a row up to equal rows; text is never null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("__mark", F.xxhash64(text))


def all_anchors(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            parts, sizes = [], []
            for text in batch["text"]:
                parts.append(anchors_of(text_bytes(text), hasher, length, gram))
                sizes.append(len(parts[-1][0]))
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else []
            if columns and len(columns[0]):
                head = {n: np.repeat(batch[n].to_numpy(), sizes) for n in ("__id", "__mark")}
                yield pd.DataFrame(head | dict(zip(("h", "at", "first", "last"), columns, strict=True)))

    return rows.mapInPandas(lean(run), "__id long, __mark long, h long, at int, first int, last int")


# Front-coded runs ------------------------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    step = 64
    while known < n:
        end = min(known + step, n)
        if a[known:end] == b[known:end]:
            known = end
        elif step == 1:
            return known
        else:
            step = max(1, step // 4)
    return n


def write_run(items: list[tuple]) -> bytes:
    """Sorted (suffix, back, numbers) as bytes: each string without the prefix that it shares with the one before.

    ``back`` is what stands before the anchor, nearest byte first.
    """
    if not items:
        return bytes(16)
    items = sorted(items)
    head, heap, before, behind = [], [], b"", b""
    for suffix, back, numbers in items:
        known, left = common_prefix(before, suffix), common_prefix(behind, back)
        head.append([known, len(suffix) - known, left, len(back) - left, *numbers])
        heap += [suffix[known:], back[left:]]
        before, behind = suffix, back
    table = np.array(head, np.int64)
    return np.array(table.shape, np.int64).tobytes() + table.tobytes() + b"".join(heap)


def read_run(run: bytes) -> Iterator[tuple[int, bytes, bytes, np.ndarray]]:
    """(shared with the suffix before, suffix, back, numbers)."""
    n, width = np.frombuffer(run, np.int64, 2)
    head = np.frombuffer(run, np.int64, n * width, 16).reshape(n, width)
    at, suffix, back = 16 + head.nbytes, b"", b""
    for row, (known, more, left, further) in zip(head, head[:, :4].tolist(), strict=True):
        suffix = suffix[:known] + run[at : at + more]
        back = back[:left] + run[at + more : at + more + further]
        yield known, suffix, back, row[4:]
        at += more + further


class LoserTree:
    """Merges sorted runs. ``known[k]`` is what run k's present suffix shares with the last output: the longer one
    is the smaller suffix without any look; only equal ones are compared, behind that prefix."""

    def __init__(self, runs: Iterable[Iterator[tuple[int, bytes, bytes, np.ndarray]]]):
        self.runs = list(runs)
        self.width = 1 << max(0, len(self.runs) - 1).bit_length()
        self.now = [next(r, None) for r in self.runs] + [None] * (self.width - len(self.runs))
        self.known = [0] * self.width
        self.losers = [0] * self.width

    def better(self, i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        a, b, known = self.now[i], self.now[j], self.known
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        k = common_prefix(a[1], b[1], known[i])
        if a[1][k : k + 1] <= b[1][k : k + 1]:
            known[j] = k
            return i, j
        known[i] = k
        return j, i

    def __iter__(self) -> Iterator[tuple[int, tuple[int, bytes, bytes, np.ndarray]]]:
        best = list(range(self.width)) * 2  # of each node, while the tree is built
        for node in range(self.width - 1, 0, -1):
            left, right = (best[c] if c < self.width else c - self.width for c in (2 * node, 2 * node + 1))
            best[node], self.losers[node] = self.better(left, right)
        top = best[1] if self.width > 1 else 0
        while self.now[top] is not None:
            yield self.known[top], self.now[top]
            self.now[top] = next(self.runs[top], None)
            self.known[top] = self.now[top][0] if self.now[top] else 0
            node = (top + self.width) // 2
            while node:
                top, self.losers[node] = self.better(top, self.losers[node])
                node //= 2


def ranks(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings, and what each shares with the one before it in that order."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    shared, before = np.zeros(len(strings), np.int64), b""
    for k, i in enumerate(order):
        shared[k] = common_prefix(before, strings[i])
        before = strings[i]
    return np.array(order, np.int64), shared


def repeated_windows(shared: np.ndarray, backs: list[bytes], numbers: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, int]]:
    """(entries, offset): windows that start ``offset`` before the anchor and stand in another entry too.

    ``shared`` are the common prefixes of the sorted suffixes with the one before; ``numbers`` are (least offset,
    largest offset) of each entry's windows.
    """
    n = len(backs)
    order, before = ranks(backs)
    block = np.empty(n, np.int64)
    for offset in range(int(numbers[:, 0].min(initial=0)), int(numbers[:, 1].max(initial=-1)) + 1):
        has = np.flatnonzero((numbers[:, 0] <= offset) & (offset <= numbers[:, 1]))
        if len(has) < 2:
            continue
        block[order] = np.cumsum(before < offset)  # equal bytes before the anchor are one block
        key = block[has] * (n + 1) + np.cumsum(shared < length - offset)[has]  # so are equal suffixes
        sorting = np.argsort(key, kind="stable")
        same = key[sorting][1:] == key[sorting][:-1]
        twice = np.zeros(len(has), bool)
        twice[sorting[1:]] |= same
        twice[sorting[:-1]] |= same
        if twice.any():
            yield has[twice], offset


# The operator ----------------------------------------------------------------------------------------------

SPAN = "__id long, __mark long, start int, end int"
#: An entry: the bytes from its anchor on and before it, its place, the least and largest offset of its windows.
ENTRY = "key long, suffix binary, back binary, __id long, __mark long, at int, low int, high int"
PLACE = ("key", "__id", "__mark", "at", "low", "high")


def _cut(batch: pd.DataFrame, length: int) -> Iterator[tuple]:
    """(suffix, back, numbers, n) of each entry wanted from a batch of texts; n entries have its gram."""
    for i, mark, text, wanted in zip(batch["__id"], batch["__mark"], batch["text"], batch["wanted"], strict=True):
        s = text_bytes(text)
        for w in wanted:
            at, first, last = w["at"], w["first"], w["last"]
            yield s[at : last + length], s[first:at][::-1], (w["h"], i, mark, at, at - last, at - first), w["n"]


def _given(batch: pd.DataFrame) -> Iterator[tuple]:
    """The same of a batch of written entries."""
    yield from zip(batch["suffix"], batch["back"], zip(*(batch[c] for c in PLACE), strict=True), batch["n"], strict=True)


def _halves(suffix: bytes, back: bytes, numbers: tuple, width: int, length: int) -> Iterator[tuple]:
    """An entry's windows by cells of ``width`` offsets, each dealt by the bytes that all windows of its cell hold."""
    key, i, mark, at, low, high = numbers
    for cell in range(low // width, high // width + 1):
        least, most = max(low, cell * width), min(high, (cell + 1) * width - 1)
        core = b"%d %d %d " % (key, cell, width) + back[: cell * width] + b" " + suffix[: length - (cell + 1) * width + 1]
        dealt = int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "little", signed=True)
        yield suffix[: length - least], back[:most], (dealt, i, mark, at, least, most)


def _spans(numbers: np.ndarray, found: Iterator[tuple[np.ndarray, int]], length: int = LENGTH) -> pd.DataFrame:
    """Runs of the windows found. ``numbers``: a row (key, id, mark, anchor, least, largest offset) for each entry."""
    which, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows, offset in found:
        which.append(rows)
        starts.append(numbers[rows, 3] - offset)
    k, start = np.concatenate(which), np.concatenate(starts)
    order = np.lexsort((start, k))
    k, start = k[order], start[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(k)) - 1 if len(k) else heads
    return pd.DataFrame({"__id": numbers[k[heads], 1], "__mark": numbers[k[heads], 2], "start": start[heads].astype(np.int32), "end": (start[ends] + length).astype(np.int32)})


def _merged(entries: DataFrame, read: Callable[[pd.DataFrame], Iterator[tuple]], n: int, length: int, bucket: int) -> DataFrame:
    """Exchange of front-coded runs, and their merge by bucket: rows of SPAN, and of ENTRY (start -1) for keys dealt over several."""
    buckets = max(1, -(-n // bucket))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}
        size = 0
        for batch in batches:
            for suffix, back, numbers, many in read(batch):
                key, i, mark, at = numbers[:4]
                salts = -(-int(many) // bucket)
                salt = hash((int(i), int(mark), int(at))) % salts
                waiting.setdefault(hash((int(key), salt)) % buckets, []).append((suffix, back, (*numbers, int(salts > 1))))
                size += len(suffix) + len(back) + 300
                if size > RUN_BYTES:
                    yield pd.DataFrame({"bucket": list(waiting), "run": [write_run(x) for x in waiting.values()]})
                    waiting, size = {}, 0
        if waiting:
            yield pd.DataFrame({"bucket": list(waiting), "run": [write_run(x) for x in waiting.values()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        shared, backs, numbers, onward = [], [], [], []
        seen, before = set(), None
        for known, (_, suffix, back, row) in LoserTree(read_run(r) for r in group["run"]):
            shared.append(known)
            backs.append(back)
            numbers.append(row)
            if row[6]:
                if suffix != before:
                    seen, before = set(), suffix
                kind = (back, int(row[0]), int(row[4]), int(row[5]))
                if kind not in seen:
                    seen.add(kind)
                    onward.append((suffix, back, *row[:6].tolist()))
        table = np.array(numbers, np.int64).reshape(len(backs), 7)
        spans = _spans(table, repeated_windows(np.array(shared, np.int64), backs, table[:, 4:6], length), length)
        none = np.zeros(len(spans), np.int64)
        spans = spans.assign(key=none, suffix=[b""] * len(spans), back=[b""] * len(spans), at=none, low=none, high=none)
        rest = pd.DataFrame(onward, columns=["suffix", "back", *PLACE]).assign(start=-1, end=-1)
        return pd.concat([spans, rest[spans.columns]]) if len(rest) else spans

    schema = f"{SPAN}, key long, suffix binary, back binary, at int, low int, high int"
    return entries.mapInPandas(lean(runs), "bucket long, run binary").groupBy("bucket").applyInPandas(merge, schema)


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(__id, __mark, start, end) of all repeated windows, in runs that may overlap. ``rows``: __id, __mark, text."""
    if bucket < 2:
        raise ValueError("a bucket of one entry cannot tell a repeat")
    spark = rows.sparkSession
    bounded_batches(spark)
    every = stored(all_anchors(rows, length, gram), "anchors")
    twice = stored(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    shared = stored(with_counts(every, twice, "h", every.count()), "shared_anchors")
    forget(every, twice)
    total, most = shared.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).head()
    if not total:
        return spark.createDataFrame([], SPAN)
    wanted = shared.groupBy("__id", "__mark").agg(F.collect_set(F.struct("h", "at", "first", "last", "n")).alias("wanted"))
    met = _merged(rows.join(wanted, ["__id", "__mark"]), lambda batch: _cut(batch, length), total, length, bucket)
    columns = ["__id", "__mark", "start", "end"]
    if most <= bucket:
        return met.select(columns)
    spans, width = [], length - gram + 1
    while True:
        met = stored(met, "merged")
        spans.append(met.where("start >= 0").select(columns))
        rest = met.where("start < 0").select([c.split()[0] for c in ENTRY.split(", ")])
        left = rest.count()
        if not left:
            return reduce(DataFrame.union, spans)
        width = -(-width // 2)
        counted = rest.groupBy("key").agg(F.count("*").alias("n"))
        rest = with_counts(rest, counted, "key", left)
        many = rest.where(F.col("n") > bucket).mapInPandas(lambda batches, w=width: (
            pd.DataFrame([(s, b, *p) for suffix, back, place, _ in _given(batch) for s, b, p in _halves(suffix, back, place, w, length)], columns=["suffix", "back", *PLACE])[[c.split()[0] for c in ENTRY.split(", ")]]
            for batch in batches), ENTRY)
        entries = stored(rest.where(F.col("n") <= bucket).drop("n").union(many), "entries")
        left = entries.count()
        counted = entries.groupBy("key").agg(F.count("*").alias("n"))
        met = _merged(with_counts(entries, counted, "key", left), _given, left, length, bucket)


def kept_pieces(text: bytes, spans: Iterable) -> tuple[list[bytes], int, int]:
    """What stays of a text, the bytes removed and the number of maximal removed runs."""
    pieces, at, removed, runs = [], 0, 0, 0
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if start > at or not runs:
            pieces.append(text[at:start])
            runs += 1
        removed += end - max(start, at) if end > at else 0
        at = max(at, end)
    return [*pieces, text[at:]], removed, runs


def _with_spans(docs: DataFrame, length: int, gram: int, bucket: int = BUCKET) -> DataFrame:
    rows = keyed(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    spans = repeated_spans(rows.select("__id", "__mark", text), length, gram, bucket)
    each = spans.groupBy("__id", "__mark").agg(F.collect_set(F.struct("start", "end")).alias("__spans"))
    return rows.join(each, ["__id", "__mark"], "left")


def removed_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(map(text_bytes, batch["text"]), batch["__spans"], strict=True):
                pieces, removed, n = kept_pieces(text, spans if spans is not None else ())
                out.append((len(text), removed, n, hashlib.sha256(b"".join(pieces)).hexdigest()))
            found = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield found

    rows = _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), length, gram, bucket)
    return rows.select("doc_id", "text", "__spans").mapInPandas(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, least: int = 1) -> DataFrame:
    """The rows with the bytes of strings of ``length`` that repeat cut out of their texts; texts of which under ``least`` bytes stay go.

    A cut inside a character drops the rest of that character too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for text, spans in zip(batch["text"], batch["__spans"], strict=True):
                if spans is not None and len(spans):
                    text = b"".join(kept_pieces(text_bytes(text), spans)[0]).decode("utf-8", "ignore")
                kept.append(text)
            out = batch.drop(columns="__spans").assign(text=kept)
            out = out[[t is None or len(text_bytes(t)) >= least or s is None for t, s in zip(kept, batch["__spans"], strict=True)]]
            if len(out):
                yield out

    rows = sheltered(docs)
    return _with_spans(rows, length, gram).select(*rows.columns, "__spans").mapInPandas(lean(run), rows.schema).toDF(*docs.columns)
