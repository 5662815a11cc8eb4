"""Plain Python versions of the operators, small inputs only."""

from __future__ import annotations

import hashlib
import math
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def secrets(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text: str) -> list[tuple[str, int, int]]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def rules(text: str) -> dict:
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times: dict = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 50 or 100 * len(covered) > 50 * n}


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def grams(text: str, buckets: int) -> list[int]:
    words = [w.encode() for w in WORD.findall(text)]
    one = [xxhash.xxh64_intdigest(w, 42) for w in words]
    two = [xxhash.xxh64_intdigest(b, a) for a, b in zip(one, words[1:])]
    return [_signed(h) % buckets for h in one + two]


def scores(texts: dict, trusted: set, buckets: int, smoothing: float) -> dict:
    raw, target = [0] * buckets, [0] * buckets
    found = {i: grams(t or "", buckets) for i, t in texts.items()}
    for i, g in found.items():
        for b in g:
            raw[b] += 1
            target[b] += i in trusted
    if not sum(target):
        return dict.fromkeys(texts, 0.0)
    size = [sum(x) + smoothing * buckets for x in (raw, target)]
    ratio = [math.log((t + smoothing) / size[1]) - math.log((r + smoothing) / size[0])
             for r, t in zip(raw, target)]
    return {i: sum(ratio[b] for b in g) / len(g) if g else 0.0 for i, g in found.items()}


def shingle_set(text: str, n: int = 4) -> set:
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else (
        {tuple(w)} if w else set())


def near_components(texts: dict, percent: int = 85, words: int = 4) -> dict:
    """id -> (set size, smallest id reachable)."""
    sets = {i: shingle_set(t or "", words) for i, t in texts.items()}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y:
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def removed(texts: dict, length: int = 100) -> dict:
    """id -> (bytes, removed, spans, hash of the rest)."""
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(raw)))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def tokens(text: str) -> list[str]:
    return re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", lower(text))


def leaked(text: str, items: dict, window: int, similarity: float) -> list[int]:
    """Items with some aligned run of tokens that agrees well enough (every diagonal tried)."""
    doc, out = tokens(text), []
    for item, passage in sorted(items.items()):
        q = tokens(passage)
        size = min(window, len(q))
        if size and any(
                sum(x == y for x, y in zip(doc[d + k:d + k + size], q[k:k + size]))
                >= math.ceil(similarity * size - 1e-9)
                for d in range(-len(q) + size, len(doc) - size + 1)
                for k in range(max(0, -d), len(q) - size + 1) if d + k + size <= len(doc)):
            out.append(item)
    return out


def viterbi(text: str, scores_by_piece: dict, ids: dict, byte_ids, unknown: float) -> list[int]:
    """Best segmentation of the whole normalised text at once (equal totals: longer last piece)."""
    text = "▁" + text.replace(" ", "▁") if text else ""
    best, last = [0] + [-math.inf] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for size in range(1, min(16, end) + 1):
            piece = text[end - size:end]
            options = [scores_by_piece[piece]] if piece in scores_by_piece else []
            if size == 1:
                options.append(unknown)
            for s in options:
                if best[end - size] + s >= best[end]:
                    best[end], last[end] = best[end - size] + s, size if s != unknown or (
                        piece in scores_by_piece and scores_by_piece[piece] >= s) else -1
    out, at = [], len(text)
    while at:
        size = last[at]
        if size > 0:
            out.append(ids[text[at - size:at]])
        else:
            out.extend(byte_ids[b] for b in reversed(text[at - 1].encode()))
        at -= abs(size)
    return out[::-1]
