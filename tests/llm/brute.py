"""Plain reference implementations, one text at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def secrets(text: str) -> str:
    out = []
    for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text
    ):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, "hex", m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def quality(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def shingles(text: str | None, k: int) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def groups(texts: dict[int, str | None], k: int, percent: int) -> dict[int, int]:
    """Smallest key reachable over links of at least ``percent`` similarity; all pairs are compared."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(texts)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def repeats(texts: dict[int, str | None], length: int) -> dict[int, tuple]:
    """n_bytes, n_removed, n_spans, kept_sha256, by key."""
    seen: set[bytes] = set()
    out = {}
    for key in sorted(texts):
        raw = (texts[key] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            part = raw[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(part)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = len(bytes(gone).replace(b"\x00", b" ").split())
        out[key] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def personal(text: str) -> str:
    """The base spans as kind:start:end."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in out)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def by_group(members: dict[int, int]) -> dict[int, list[int]]:
    out = defaultdict(list)
    for i, g in members.items():
        out[g].append(i)
    return out
