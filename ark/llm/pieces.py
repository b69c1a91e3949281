"""Operator 3, SentencePiece encoding and decoding by a max-plus parallel scan.

The public model is of the byte-pair kind, so a path's weight is not a sum of piece scores: a step from one piece
to the next weighs its number of ids if the two may be neighbours (see ``lattice``) and minus infinity if not. One
path from the start is finite; its weight is the number of ids.

Giant documents are cut into chunks at fixed places, wherever those fall. A state at a cut is the last piece that
ends at or before it, and how far before. Each chunk gives, by itself, a matrix of the weights from every state at
its left cut to every state at its right cut; matrices combine associatively under (max, +); a document's finite
path fixes the state at each cut, and each chunk then traces its own pieces back. Other documents are one chunk.

No piece of the model reaches from a word into the next word's mark, or joins two characters of different groups
(letters of one script, punctuation), so a text falls into units that are encoded once and remembered.

Defined cases: null and empty texts have no pieces; a text is never cut short; "▁" (U+2581) in a text reads back
as a space, as in the library; repeated rows are returned each; other columns are carried by ``encode_rows`` or
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, sheltered, stored, Memo
from .lattice import Lattice

MARK = "▁"
#: Characters of a chunk, and of a document from which it is cut into chunks.
CHUNK, GIANT = 16_384, 49_152
#: Characters of texts whose units are worked out together.
GROUP = 1 << 20
NONE = -(1 << 40)
#: Chunks whose matrices are multiplied in one task; a document's products are as few as its chunks by this.
FAN = 64


def neighbours_in(pieces: Iterable[str]) -> list[list[str]]:
    """Characters in groups: two that stand together in a piece are of one group. The word mark is left out."""
    group: dict[str, str] = {}

    def head(c: str) -> str:
        while group.setdefault(c, c) != c:
            c = group[c]
        return c

    for piece in pieces:
        chars = piece.lstrip(MARK)
        for a, b in zip(chars[:1] + chars, chars):
            group[head(a)] = head(b)
    found: dict[str, list[str]] = {}
    for c in group:
        found.setdefault(head(c), []).append(c)
    return sorted(found.values(), key=lambda g: (-len(g), g))


class Pieces:
    """A byte-pair SentencePiece model, from the bytes of its file."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp, n = self.library, self.library.get_piece_size()
        names = [sp.id_to_piece(k) for k in range(n)]
        plain = [k for k in range(n) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))]
        self.ids = {names[k]: k for k in plain}
        self.byte_ids = {int(names[k][3:5], 16): k for k in range(n) if sp.is_byte(k)}
        if len(self.byte_ids) != 256 or any(MARK in names[k].lstrip(MARK) for k in plain) or sp.encode("ab  c") == sp.encode(" ab c"):
            raise ValueError("a model with byte pieces, words marked in front and spaces kept is needed")
        scores = {names[k]: sp.get_score(k) for k in plain}
        self.lattice = Lattice({p for p in self.ids if len(p) > 1}, lambda a, b: None if (s := scores.get(a + b)) is None else -s)
        self._unit = re.compile("|".join([f"{MARK}*[{''.join(map(re.escape, sorted(g)))}]+" for g in neighbours_in(self.lattice.tokens)] + [f"{MARK}+", "."]), re.DOTALL)
        self.bytes_of = [b""] * n
        for p, k in self.ids.items():
            self.bytes_of[k] = p.replace(MARK, " ").encode()
        for b, k in self.byte_ids.items():
            self.bytes_of[k] = bytes([b])
        self.units = Memo()  # ids of each unit met so far, as 32-bit numbers

    def marked(self, text: str) -> str:
        """The text as the model reads it: a mark in front and for each space."""
        return MARK + text.replace(" ", MARK) if text else ""

    def parts(self, marked: str) -> list[str]:
        return self._unit.findall(marked)

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        found = self.ids.get(piece)
        return (found,) if found is not None else tuple(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))

    def learn(self, units: Iterable[str]) -> None:
        """Encode the units not met before, in sorted order: each starts from the prefix it shares with the one before."""
        known, id_of = self.units, self.ids.get
        new = {u for u in units if u not in known}
        if known.room(sum(160 + 6 * len(u) for u in new)):
            new = set(units)
        order = sorted(new)
        for unit, (last, _) in zip(order, self.lattice.forward_each(order), strict=True):
            out, i = [], len(unit)
            while i:
                piece = last[i]
                found = id_of(piece)
                if found is None:
                    out.extend(reversed(self.piece_ids(piece)))
                else:
                    out.append(found)
                i -= len(piece)
            out.reverse()
            known[unit] = array("i", out).tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; texts are taken in groups of some ``GROUP`` characters."""
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and (not group or size + len(texts[at]) <= GROUP):
                group.append(self.parts(self.marked(texts[at])))
                size += len(texts[at])
                at += 1
            self.learn(set(chain.from_iterable(group)))
            for units in group:
                yield np.frombuffer(b"".join(map(self.units.__getitem__, units)), np.int32)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def unit_ids(self, marked: str) -> list[int]:
        units = self.parts(marked)
        self.learn(units)
        return np.frombuffer(b"".join(map(self.units.__getitem__, units)), np.int32).tolist()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")[1:]

    # Chunks ------------------------------------------------------------------------------------------------

    @property
    def reach(self) -> int:
        """Characters before a cut that its states depend on."""
        return 2 * self.lattice.longest

    def states(self, before: str) -> list[tuple[int, str]]:
        """(distance, piece) of all that may be the last piece at the cut behind ``before``."""
        out, longest = [], self.lattice.longest
        for distance in range(min(longest, len(before) + 1)):
            end = len(before) - distance
            if end == 0:
                out.append((distance, ""))  # the start of the text
            for k in range(1, min(longest, end) + 1):
                piece = before[end - k : end]
                if k == 1 or piece in self.lattice.tokens:
                    out.append((distance, piece))
        return out

    def breaks(self, before: str, chunk: str) -> tuple[int, int]:
        """Offsets in the chunk of its first and last place between units; (-1, -1) without one."""
        at, places = -len(before), []
        for unit in self.parts(before + chunk):
            if 0 <= at <= len(chunk):
                places.append(at)
            at += len(unit)
        return (places[0], places[-1]) if places else (-1, -1)

    def walk(self, before: str, chunk: str, state: tuple[int, str], upto: int) -> list[tuple[str, int] | None]:
        """From a state at the left cut: of each place behind the cut, up to ``upto``, the last piece and the weight."""
        distance, last = state
        origin, lattice = len(before) - distance, self.lattice
        text = before[origin:] + chunk[:upto]
        found: list[tuple[str, int] | None] = [None] * (len(text) + 1)
        found[0] = (last, 0)
        for i in range(distance + 1, len(text) + 1):
            for start in range(max(0, i - lattice.longest), i):
                known, piece = found[start], text[start:i]
                if known is None or (i - start > 1 and piece not in lattice.tokens) or 0 < start <= distance:
                    continue
                if not known[0] or lattice.joins(known[0], piece):
                    found[i] = (piece, known[1] + len(self.piece_ids(piece)))
                    break
        return found[distance:] if distance else found

    def matrix(self, before: str, chunk: str, final: bool) -> np.ndarray:
        """Weights from the states at the left cut to those at the right cut (at the text's end: states of distance 0)."""
        rows, columns = self.states(before), self.exits(before, chunk, final)
        out = np.full((len(rows), len(columns)), NONE, np.int64)
        first, last = self.breaks(before, chunk)
        if first < 0:
            for r, state in enumerate(rows):
                found = self.walk(before, chunk, state, len(chunk))
                for c, (distance, piece) in enumerate(columns):
                    place = len(chunk) - distance
                    if place > 0 and found[place] is not None and found[place][0] == piece:
                        out[r, c] = found[place][1]
                    elif place <= 0 and state == (-place, piece):
                        out[r, c] = 0
            return out
        middle = len(self.unit_ids(chunk[first:last]))
        tail = chunk[last:]
        ends = self.lattice.forward(tail)[0] if tail else [""]
        counts = [0]
        for k, piece in enumerate(ends[1:], 1):
            counts.append(counts[k - len(piece)] + len(self.piece_ids(piece)))
        if last > first:
            closing = self.lattice.encode(self.parts(chunk[first:last])[-1])[-1]
        for r, state in enumerate(rows):
            found = self.walk(before, chunk, state, first)[first] if first else ((state[1], 0) if state[0] == 0 else None)
            if found is None:
                continue
            for c, (distance, piece) in enumerate(columns):
                place = len(tail) - distance
                ending = ends[place] if place > 0 else (closing if last > first else found[0]) if place == 0 else None
                if ending == piece:
                    out[r, c] = found[1] + middle + (counts[place] if place > 0 else 0)
        return out

    def exits(self, before: str, chunk: str, final: bool) -> list[tuple[int, str]]:
        after = (before + chunk)[-self.reach :]
        return [s for s in self.states(after) if not final or s[0] == 0]

    def trace(self, before: str, chunk: str, entry: tuple[int, str], leave: tuple[int, str]) -> np.ndarray:
        """Ids of the pieces that end in the chunk, on the path from one state to the other."""
        first, last = self.breaks(before, chunk)
        upto = len(chunk) - leave[0]
        out: list[int] = []

        def back(found: list, base: int, place: int) -> list[int]:
            pieces = []
            while place > base and place > 0:
                pieces.append(found[place][0])
                place -= len(pieces[-1])
            return list(chain.from_iterable(map(self.piece_ids, reversed(pieces))))

        if first < 0:
            return np.array(back(self.walk(before, chunk, entry, len(chunk)), 0, upto), np.int32)
        if first:
            out += back(self.walk(before, chunk, entry, first), 0, first)
        out += self.unit_ids(chunk[first:last])
        if upto > last:
            out += chain.from_iterable(map(self.piece_ids, self.lattice.encode(chunk[last:upto])))
        return np.array(out, np.int32)


@lru_cache(maxsize=1)
def pieces_of(model: bytes) -> Pieces:
    """One for each Python worker: what a task has learnt the next one knows."""
    return Pieces(model)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NONE)


def chunks_of(marked: str, size: int, reach: int) -> Iterator[tuple[int, str, str, bool]]:
    """(number, characters before, chunk, final)."""
    n = max(1, -(-len(marked) // size))
    for k in range(n):
        yield k, marked[max(0, k * size - reach) : k * size], marked[k * size : (k + 1) * size], k == n - 1


def product(matrices: list[np.ndarray]) -> np.ndarray:
    return reduce(combine, matrices)


def states_at_cuts(matrices: list[np.ndarray], entry: int = 0, leave: int = 0) -> list[int]:
    """The state at each cut, first to last, on the finite path from a state at the first to one at the last.

    From the weights up to a cut and from it on. A whole document starts in its only state; at its end the path's
    state is the one with a finite weight: ``leave`` below 0.
    """

    def one(n: int, k: int) -> np.ndarray:
        out = np.full((1, n), NONE, np.int64)
        out[0, k] = 0
        return out

    last = matrices[-1].shape[1]
    ahead, back = [one(matrices[0].shape[0], entry)], [one(last, leave) if leave >= 0 else np.zeros((1, last), np.int64)]
    for m in matrices:
        ahead.append(combine(ahead[-1], m))
    for m in reversed(matrices):
        back.append(combine(back[-1], m.T))
    return [int((a + b).argmax()) for a, b in zip(ahead, reversed(back), strict=True)]


# The operator ----------------------------------------------------------------------------------------------

RESULT = "ids array<int>, n_pieces long, round_trip boolean"


def digest(ids: np.ndarray) -> str:
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()


def _result(pieces: Pieces, text: str, ids: np.ndarray) -> tuple:
    return ids, len(ids), pieces.decode(ids) == text.replace(MARK, " ")


def _giant(rows: DataFrame, model: bytes, size: int) -> DataFrame:
    """(__mark, text, ids, n_pieces, round_trip) of different giant texts."""
    rows = stored(rows, "giants")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(model)
        for batch in batches:
            for mark, text in zip(batch["__mark"], batch["text"], strict=True):
                for part in chunks_of(pieces.marked(text), size, pieces.reach):
                    yield pd.DataFrame([(mark, *part)], columns=["__mark", "part", "before", "chunk", "final"])

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(model)
        for batch in batches:
            found = [pieces.matrix(*x) for x in zip(batch["before"], batch["chunk"], batch["final"], strict=True)]
            yield pd.DataFrame({"__mark": batch["__mark"], "part": batch["part"], "width": [m.shape[1] for m in found], "weights": [m.ravel() for m in found]})

    def unpacked(group: pd.DataFrame) -> list[np.ndarray]:
        return [np.asarray(w, np.int64).reshape(-1, n) for w, n in zip(group["weights"], group["width"], strict=True)]

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        whole = product(unpacked(group.sort_values("part")))
        return pd.DataFrame([(group["__mark"].iloc[0], group["block"].iloc[0], whole.shape[1], whole.ravel())], columns=["__mark", "block", "width", "weights"])

    def over_blocks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        cuts = states_at_cuts(unpacked(group), leave=-1)
        return pd.DataFrame({"__mark": group["__mark"], "block": group["block"], "first": cuts[:-1], "last": cuts[1:]})

    def over_chunks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        cuts = states_at_cuts(unpacked(group), int(group["first"].iloc[0]), int(group["last"].iloc[0]))
        return pd.DataFrame({"__mark": group["__mark"], "part": group["part"], "entry": cuts[:-1], "leave": cuts[1:]})

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(model)
        for batch in batches:
            ids = [pieces.trace(b, c, pieces.states(b)[i], pieces.exits(b, c, f)[o]) for b, c, f, i, o in zip(batch["before"], batch["chunk"], batch["final"], batch["entry"], batch["leave"], strict=True)]
            yield pd.DataFrame({"__mark": batch["__mark"], "part": batch["part"], "ids": ids})

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(model)
        for batch in batches:
            for mark, text, ids in zip(batch["__mark"], batch["text"], batch["ids"], strict=True):
                ids = np.asarray(ids, np.int32)
                yield pd.DataFrame([(mark, text, *_result(pieces, text, ids))], columns=["__mark", "text", "ids", "n_pieces", "round_trip"])

    # chunks are dealt anew: one document's are worked on by many tasks
    parts = stored(rows.mapInPandas(lean(cut), "__mark long, part long, before string, chunk string, final boolean"), "chunks").repartition("__mark", "part")
    weights = stored(parts.mapInPandas(lean(matrices), "__mark long, part long, width long, weights array<long>"), "matrices").withColumn("block", F.expr(f"part div {FAN}"))
    # up: products of neighbours; across: a document's few products; down: the chunks of each block
    products = weights.groupBy("__mark", "block").applyInPandas(multiply, "__mark long, block long, width long, weights array<long>")
    ends = products.groupBy("__mark").applyInPandas(over_blocks, "__mark long, block long, first long, last long")
    cuts = weights.join(ends, ["__mark", "block"]).groupBy("__mark", "block").applyInPandas(over_chunks, "__mark long, part long, entry long, leave long")
    traced = parts.join(cuts, ["__mark", "part"]).mapInPandas(lean(trace), "__mark long, part long, ids array<int>")
    whole = traced.groupBy("__mark").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "ids"))), lambda x: x["ids"])).alias("ids"))
    return rows.join(whole, "__mark").mapInPandas(lean(close), f"__mark long, text string, {RESULT}")


def encode_rows(docs: DataFrame, model_path: str, giant: int = GIANT, size: int = CHUNK, ids: bool = True) -> DataFrame:
    """The rows with ids, n_pieces, round_trip (the ids read back as the text) and ids_sha256 (of little-endian int32).

    Columns of these names are replaced. Without ``ids`` the digest alone is returned.
    """
    with open(model_path, "rb") as file:
        model = file.read()  # executors get the model with the task
    bounded_batches(docs.sparkSession)
    docs = docs.drop("ids", "n_pieces", "round_trip", "ids_sha256")
    given, docs = docs.columns, sheltered(docs)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = list(kinds)
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + f", {RESULT if ids else RESULT.replace('ids array<int>, ', '')}, ids_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(model)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            found = [_result(pieces, t, i) for t, i in zip(texts, pieces.encode_all(texts), strict=True)]
            out = batch.assign(n_pieces=[f[1] for f in found], round_trip=[f[2] for f in found], ids_sha256=[digest(f[0]) for f in found])
            if ids:
                out["ids"] = [f[0] for f in found]
            yield out

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(ids_sha256=[digest(np.asarray(x, np.int32)) for x in batch["ids"]]).drop(columns=[] if ids else ["ids"])

    long = F.coalesce(F.length("text"), F.lit(0)) > giant
    small = docs.where(~long).mapInPandas(lean(run), schema)
    giants = docs.where(long).withColumn("__mark", F.xxhash64("text"))
    texts = giants.select("__mark", "text").dropDuplicates(["__mark"])
    solved = _giant(texts, model, size).drop("text")
    joined = giants.join(solved, "__mark").select(*names, *[c for c in ("ids", "n_pieces", "round_trip")])
    out = small.unionByName(joined.mapInPandas(lean(digests), schema))
    return out.toDF(*given, *out.columns[len(given) :])
