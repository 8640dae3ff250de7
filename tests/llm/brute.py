"""Plain single-process versions of what the operators return."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(value: bytes | str) -> str:
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def exact(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    return {i: (min(ids), len(ids), i == min(ids), sha(t)) for t, ids in groups.items() for i in ids}


def byte_repeats(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            piece = raw[k : k + length]
            if piece in seen:
                gone[k : k + length] = True
            else:
                seen.add(piece)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        out[i] = (len(raw), int(gone.sum()), spans, sha(np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return out


def word_repeats(rows: list[tuple[int, str | None]], size: int = 20) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        stays = [True] * len(words)
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                stays[k : k + size] = [False] * size
            else:
                seen.add(window)
        kept = [w for w, s in zip(words, stays) if s]
        out[i] = (len(words), len(words) - len(kept), sha(" ".join(kept)))
    return out


def near(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple]:
    sets = {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    key = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    found = [
        ("assign", *m.span())
        for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 12
    ]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""

    def luhn(d: str) -> bool:
        return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) % 10 == 0

    def digits(m: re.Match) -> str:
        return re.sub("[^0-9]", "", m[0])

    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [
        ("ip", *m.span())
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    found += [
        ("card", *m.span())
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 13 <= len(digits(m)) <= 19 and luhn(digits(m))
    ]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def pieces(tokens: list[int], capacity: int = 1024) -> list[tuple[int, int, int, int]]:
    ids = np.array([*tokens, 2], "<u4")
    first = (len(ids) - 1) % capacity + 1
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def quality(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    repeated = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
    )


FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | None, longest: int = 2, buckets: int = 10_000) -> tuple[int, list[int]]:
    words = FEATURE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def importance(rows: list[tuple[int, str | None]], target: list[str | None]) -> dict[int, tuple]:
    """n_features, weight, score and rank of every row with its own id."""
    own = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    out = {}
    for i, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out[i] = (n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    ranked = sorted((i for i in out if out[i][0] >= 20), key=lambda i: (-out[i][3], i))
    rank = {i: k + 1 for k, i in enumerate(ranked[: 25 * len(ranked) // 100])}
    return {i: (*o[1:], rank.get(i)) for i, o in out.items()}


def part_codes(rows: list[tuple], rounds: int = 6) -> tuple[dict, list]:
    """(code, error, label_error) of every row with a whole vector, and the codebooks; rows are (id, vector, label)."""
    kept = [(i, [math.floor(4096 * int(x) if abs(x) >= 2.0**60 else 4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    width = len(kept[0][1]) // 8
    parts = [[v[p * width : (p + 1) * width] for _, v, _ in kept] for p in range(8)]
    books = [own[:16] for own in parts]

    def nearest(p: int, x: list[int]) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p, own in enumerate(parts):
            groups = defaultdict(list)
            for x in own:
                groups[nearest(p, x)[1]].append(x)
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out, sums = [], Counter()
    for k, (i, _, label) in enumerate(kept):
        near = [nearest(p, parts[p][k]) for p in range(8)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near)))
        sums[label] += out[-1][3]
    cap = (1 << 63) - 1
    return sorted((i, code, min(error, cap), min(sums[label], cap)) for i, label, code, error in out), books
