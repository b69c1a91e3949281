"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

LOWER = {65 + k: 97 + k for k in range(26)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def decontaminate(docs, items, size=10):
    """docs and items: (id, text). Rows (doc_id, n_words, n_hit, n_items, items_sha256)."""
    windows = defaultdict(set)
    for i, text in items:
        w = terms(text)
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[k : k + m])].add(i)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = terms(text), set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if (got := windows.get(tuple(w[k : k + m]))) is not None:
                    hit.update(range(k, k + m))
                    found |= got
        names = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest()))
    return out


def repeats(docs, length=400):
    """docs: (id, text). Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, s in texts:
        seen.update(s[k : k + length] for k in range(len(s) - length + 1))
    out = []
    for i, s in texts:
        gone = bytearray(len(s))
        for k in range(len(s) - length + 1):
            if seen[s[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(s, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(s), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    fps = [(i, fingerprint(t)) for i, t in docs]
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(fps):
        least[find(k)] = min(i, least.get(find(k), i))
    return [(i, f"{fp:016x}", least[find(k)]) for k, (i, fp) in enumerate(fps)]


def base_rules(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(k, k + 3)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n)


def chat(turns, tokens, budget=1024, history=256):
    """Characters of all windows of one conversation, by plain sums. turns: (role, text); the system turns that open it fit one window."""
    size = lambda k: len(f"### {turns[k][0]}:\n\n</turn>\n") + sum(1 + (c in "\\#:<" if part == 0 else c in "\\#<") for part in (0, 1) for c in turns[k][part]) - len(turns[k][0])
    system = next((k for k, t in enumerate(turns) if t[0] != "system"), len(turns))
    at, total = 0, 0
    while at < len(turns):
        lead = range(system) if at else range(0)
        used, end = sum(tokens[k] for k in lead), at
        while end < len(turns) and (end == at or used + tokens[end] <= budget):
            used += tokens[end]
            end += 1
        room, back = min(history, max(0, budget - used)), at
        while back and sum(tokens[back - 1 : at]) <= room:
            back -= 1
        total += sum(map(size, [*lead, *range(back, end)]))
        at = end
    return total
