"""Plain Python versions of what the operators compute."""

import hashlib
import re

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_hits(text, items, window=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, named = cut(text), set(), set()
    for item, said in items:
        own = cut(said)
        size = min(window, len(own))
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                named.add(str(item))
    return len(words), len(hit), sorted(named)


def brute_removed(docs, window):
    from collections import Counter

    cut = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in docs}
    count = Counter(tuple(w[i : i + window]) for w in cut.values() for i in range(len(w) - window + 1))
    out = {}
    for k, w in cut.items():
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out[k] = len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def brute_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if fine:
                found.append((m.start(), k, m.end()))
    return ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(found))


def brute_classes(docs, shingle, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w)} if 0 < len(w) < shingle else {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if w else set()

    sets = {k: shingles(t) for k, t in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {k: (len(sets[k]), find(k), find(k) == k) for k in keys}


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)
