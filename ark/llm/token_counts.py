"""Operator 5, token counts: prefix dynamic programming over a byte-level BPE vocabulary.

Every prefix of a text has an exact token count, built from the counts of shorter prefixes, so budget and
truncation questions are answered without encoding anything again.

Of each piece of text met, the counts of all its prefixes are kept (in bounded memory), so a cut reads them; of a
very long piece no more is held than a token can reach back to.

Defined cases: null and empty texts have 0 tokens; texts are never cut; repeated rows are counted each;
other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from array import array
from collections import deque
from functools import lru_cache
from itertools import accumulate, islice

import pandas as pd
import regex
from pyspark.sql import DataFrame

from .common import LONG_KEY, Memo, documents_only, map_batches, text_bytes
from .lattice import Lattice

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


#: Characters of texts whose pieces are worked out together.
GROUP = 1 << 20


class PrefixCounter:
    """Token counts of all prefixes under one tokenizer file (JSON text)."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        kept = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if spec.get("normalizer") or model.get("type") != "BPE" or any(model.get(k) for k in kept) or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("a byte-level BPE tokenizer without normalizer or prefix space is needed")
        as_byte = byte_characters()
        raw = lambda token: bytes(as_byte[c] for c in token)
        ranks = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[raw(left), raw(right)] = k
        tokens = {a + b for a, b in ranks}
        self.lattice = Lattice(tokens, lambda a, b: ranks.get((a, b)))
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._split = regex.compile(SPLIT)
        self._space = regex.compile(r"\s+")
        self._counts = Memo()  # of each piece met so far: the token counts of all its prefixes, by bytes

    def _learn(self, pieces: list[str]) -> None:
        """Prefix counts of pieces; those not met before are worked out in sorted order, each from the prefix it shares."""
        known = self._counts
        new = {p for p in pieces if p not in known and len(p) < LONG_KEY}
        if new:
            if known.room(sum(240 + 3 * len(p) for p in new)):
                new = {p for p in pieces if len(p) < LONG_KEY}
            order = sorted(p.encode() for p in new)
            known.update((p.decode(), bytes(c) if c[-1] < 256 else array("H", c)) for p, (_, c) in zip(order, self.lattice.forward_each(order), strict=True))

    def _each(self, pieces: list[str]) -> list[int]:
        """Token counts of pieces; of a very long one nothing is kept."""
        self._learn(pieces)
        known = self._counts
        try:
            return [known[p][-1] for p in pieces]
        except KeyError:  # a very long one
            return [known[p][-1] if p in known else deque(self.lattice.places(p.encode()), 1)[0] for p in pieces]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text: the last of its prefix counts. Texts are taken in groups of some ``GROUP`` characters."""
        out, at = [], 0
        while at < len(texts):
            group, size, pieces, shares = at, 0, [], []
            while at < len(texts) and (size == 0 or size + len(texts[at]) <= GROUP):
                parts = self._special.split(texts[at]) if any(s in texts[at] for s in self.special) else texts[at : at + 1]
                own = [p for part in parts for p in self._split.findall(part)]
                shares.append((len(own), len(parts) - 1))
                pieces += own
                size += len(texts[at])
                at += 1
            each, k = self._each(pieces), 0
            for n, special in shares:
                out.append(sum(each[k : k + n]) + special)
                k += n
            assert len(out) == at > group
        return out

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def _within(self, piece: str) -> array:
        """Counts of the piece's own prefixes, by characters, from those that are stored."""
        self._learn([piece])
        counts, out = self._counts.get(piece) or self.lattice.places(piece.encode()), array("I")
        ends = accumulate(len(c.encode()) for c in piece)
        end = next(ends, None)
        for at, n in enumerate(counts):
            if at == end:
                out.append(n)
                end = next(ends, None)
        return out

    def _plain(self, text: str) -> array:
        """Counts of the prefixes of a text without special strings; packed, as a giant word has as many as characters."""
        out, base, before, last = array("I", [0]), 0, 0, ""
        for piece in self._split.findall(text):
            counts = self._within(piece)
            row = array("I", (base + c for c in counts))
            if last and self._space.fullmatch(last) and self._space.match(piece):
                row[0] = before + self._within(last + piece[0])[-1]  # a prefix that ends in white space has it in one piece
            if len(piece) == 3 and piece in ("'re", "'ve", "'ll"):
                row[1] = base + self._within("'")[-1] + self._within(piece[1])[-1]
            out += row
            before, base, last = base, base + counts[-1], piece
        return out

    def prefixes(self, text: str) -> list[int]:
        """``prefixes(t)[k]`` is the number of tokens of ``t[:k]``."""
        out, base, at = [0], 0, 0
        for mark in self._special.finditer(text):
            rows = self._plain(text[at : mark.end() - 1])
            out += [base + c for c in rows[1:]]
            base += rows[mark.start() - at] + 1
            out.append(base)
            at = mark.end()
        return out + [base + c for c in self._plain(text[at:])[1:]]

    def longest_prefix(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens."""
        base, at = 0, 0
        marks = [*self._special.finditer(text), None]
        for mark in marks:
            end = mark.start() if mark else len(text)
            pieces, sums = [], [base]
            found = self._split.finditer(text[at:end])
            while sums[max(0, len(sums) - 4)] <= limit and (some := [m[0] for m in islice(found, 512)]):  # some pieces past the limit, or all
                pieces += some
                sums += [*accumulate(self._each(some), initial=sums[-1])][1:]
            if sums[-1] + (mark is not None) > limit:
                k = max(0, next(i for i, s in enumerate([*sums, limit + 1]) if s > limit) - 2)  # a piece earlier, for split white space
                start = at + sum(map(len, pieces[:k]))
                upto = at + sum(map(len, pieces[: k + 3]))
                upto = max(upto, min(mark.end() - 1, len(text)) if mark and k + 3 >= len(pieces) else upto)
                rows = self._plain(text[start : min(upto, start + (limit - sums[k] + 4) * self.lattice.longest)])  # no token is longer
                return start + max(j for j, c in enumerate(rows) if sums[k] + c <= limit)
            base, at = sums[-1] + (mark is not None), mark.end() if mark else end
        return len(text)


@lru_cache(maxsize=1)
def counter_of(spec: str) -> PrefixCounter:
    """One for each Python worker: what a task has learnt the next one knows."""
    return PrefixCounter(spec)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Per document: n_bytes, n_tokens, over_limit, and cut_chars, the characters of the longest prefix within the limit."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()  # executors get the vocabulary with the task; they need no file of their own

    def make():
        counter = counter_of(spec)

        def step(batch: pd.DataFrame) -> pd.DataFrame:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            counts = counter.counts(texts)
            return pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_bytes": [len(text_bytes(t)) for t in texts],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
                "cut_chars": [counter.longest_prefix(t, limit) if n > limit else len(t) for t, n in zip(texts, counts, strict=True)],
            }).astype({"doc_id": "Int64"})

        return step

    return map_batches(documents_only(docs), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")
