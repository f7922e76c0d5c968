"""Plain versions of the contracts, over lists of (doc_id, text) in the order of doc_id."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(docs):
    return sorted(docs, key=lambda d: ((d[0] is not None, d[0] or 0), (d[1] is not None, (d[1] or "").encode())))


def substring_dedup(docs, window=20):
    seen, out = set(), []
    for doc, text in ordered(docs):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def line_dedup(docs, near_words=3):
    equal, before, out = set(), {}, []
    for doc, text in ordered(docs):
        lines, kept = text.split("\n") if text else [], []
        for line in lines:
            w = WORD.findall(line)
            near = len(w) >= near_words
            if not w or not (tuple(w) in equal or near and any(within_one(w, x) for n in (-1, 0, 1) for x in before.get(len(w) + n, ()))):
                kept.append(line)
            equal.add(tuple(w))
            if near:
                before.setdefault(len(w), []).append(w)
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text, words=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def jaccard(docs, words=5, percent=75):
    docs = ordered(docs)
    sets = [shingles(t, words) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    x, y = sorted((root(i), root(j)))
                    up[y] = x
    return [(d, len(s), docs[root(i)][0]) for i, ((d, _), s) in enumerate(zip(docs, sets))]
