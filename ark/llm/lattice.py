"""Exact byte-pair segmentation as a path search.

A sequence of vocabulary tokens is the byte-pair encoding of its text exactly when every two neighbours
are: merging the two neighbours' text alone gives them back. So each prefix of a text has one last token,
found from the last tokens of shorter prefixes, and a text's encoding is the one path from its start.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import chain

import ahocorasick

from .common import Memo



class Lattice:
    """Over ``str`` or ``bytes``. ``tokens`` has every multi-unit token; single units always are tokens.

    ``rank(left, right)`` is the priority of merging two neighbours, lower first and leftmost on ties, or None.
    """

    def __init__(self, tokens: set, rank: Callable[[Hashable, Hashable], float | None]):
        self.tokens, self.rank = tokens, rank
        self.longest = max(map(len, tokens), default=1)
        self._joins = Memo(48 << 20)
        self._automaton = ahocorasick.Automaton()
        for t in tokens:
            self._automaton.add_word(t if isinstance(t, str) else t.decode("latin-1"), t)
        self._automaton.make_automaton()

    def merge(self, text) -> list:
        """The encoding by repeated merging; used for neighbours only, so on short texts."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def joins(self, left, right) -> bool:
        """May ``right`` follow ``left``?"""
        key = (left, right)
        if (known := self._joins.get(key)) is None:
            self._joins.room(240 + 2 * (len(left) + len(right)))
            known = self._joins[key] = self.merge(left + right) == [left, right]
        return known

    def forward(self, text) -> tuple[list, list[int]]:
        """Of every prefix of ``text``: its last token, and its number of tokens."""
        return next(self.forward_each([text]))

    def forward_each(self, texts: Iterable) -> Iterator[tuple[list, list[int]]]:
        """The same for many texts. A prefix that a text shares with the one before is not worked out again, so
        sorted texts are cheap. The lists are good until the next step.

        An automaton names the tokens that end at each place; the one that may follow the last token before it is
        the place's last token. Where none may, it is the single unit.
        """
        matches, known = self._automaton.iter, self._joins
        last, count, old = [], [0], None
        for text in texts:
            shared = 0
            if old is None:
                last = [text[:0]]
            else:
                for x, y in zip(old, text):  # noqa: B905
                    if x != y:
                        break
                    shared += 1
                del last[shared + 1 :], count[shared + 1 :]
            old, due = text, shared + 1  # due: the next place without a last token
            for at, token in matches(text if isinstance(text, str) else text.decode("latin-1")):
                if at + 1 < due:
                    continue
                while due <= at:
                    last.append(text[due - 1 : due])
                    count.append(count[due - 1] + 1)
                    due += 1
                before = due - len(token)
                if before:
                    follows = known.get((last[before], token))
                    if follows is None:
                        follows = self.joins(last[before], token)
                    if not follows:
                        continue
                last.append(token)
                count.append(count[before] + 1)
                due += 1
            while due <= len(text):
                last.append(text[due - 1 : due])
                count.append(count[due - 1] + 1)
                due += 1
            yield last, count

    def places(self, text) -> Iterator[int]:
        """The number of tokens of every prefix, from the empty one on. Of a very long text no more places are held
        than a token can reach back to."""
        last, count, base, due = [text[:0]], [0], 0, 1  # of the places from base on
        yield 0
        for at, token in chain(self._automaton.iter(text if isinstance(text, str) else text.decode("latin-1")), [(len(text), None)]):
            if at + 1 < due:
                continue
            while due <= at:
                last.append(text[due - 1 : due])
                count.append(count[due - 1 - base] + 1)
                yield count[-1]
                due += 1
            if token is None:
                return
            before = due - len(token)
            if before and not self.joins(last[before - base], token):
                continue
            last.append(token)
            count.append(count[before - base] + 1)
            yield count[-1]
            due += 1
            if len(last) > 2 * self.longest + 4_096:
                gone = len(last) - self.longest - 1
                del last[:gone], count[:gone]
                base += gone

    def encode(self, text) -> list:
        return self.back(self.forward(text)[0])

    def back(self, last: list) -> list:
        """The tokens of the whole text, from its prefixes' last tokens."""
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(last[i])
        return out[::-1]
