"""The same results by plain Python, one text after the other."""

import hashlib
import re

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text):
    return PLAIN.findall((text or "").translate(CAPITALS))


def spaced_words(text):
    return SPACED.findall((text or "").translate(CAPITALS))


def contamination(texts, items, span=13):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        n = min(span, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words, hit, met = plain_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i : i + n]))
                if found:
                    met |= found
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((len(words), len(hit), len(met), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def shingle_set(text, k):
    words = spaced_words(text)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_groups(texts, k, percent):
    """(number of shingles, smallest index reached) of each text."""
    sets = [shingle_set(t, k) for t in texts]
    group = list(range(len(texts)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def repeats(texts, span=200):
    """(bytes, removed, spans, sha of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for t, raw in enumerate(raws):
        for i in range(len(raw) - span + 1):
            seen.setdefault(raw[i : i + span], []).append((t, i))
    gone = [bytearray(len(r)) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for t, i in places:
                gone[t][i : i + span] = b"\1" * span
    out = []
    for raw, mask in zip(raws, gone):
        left = bytes(b for b, m in zip(raw, mask) if not m)
        spans = len(re.findall(b"\1+", bytes(mask)))
        out.append((len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out
