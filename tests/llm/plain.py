"""Brute-force versions of operators, in plain Python, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def kept_words(docs, window):
    """Per row of (id, text): its words and which of them stay."""
    first = {}
    for doc, text in docs:
        if doc is not None:
            w = words(text)
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(doc, first.get(k, doc))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        if doc is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < doc:
                    gone.update(range(i, i + window))
        out.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def repeats_digest(docs, window=50):
    return Counter(
        (doc, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
        for (doc, _), (w, k) in zip(docs, kept_words(docs, window))
    )


def shingle_set(text, k=5):
    w = words(lower(text or ""))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def groups(docs, percent=80):
    """Component number of each row of (id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    return sets, [find(i) for i in range(len(docs))]


def classes(docs):
    sets, comp = groups(docs)
    least = {}
    for (doc, _), c in zip(docs, comp):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return Counter((doc, len(s), least.get(c)) for (doc, _), s, c in zip(docs, sets, comp))


def draw(doc, text, number, seed="mix"):
    text = hashlib.md5((text or "").encode()).hexdigest()
    text = f"{seed}:{'' if doc is None else doc}:{text}:{number}"
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def copies(docs, weights=(3, 1, 2), share=1.5, most=2):
    """Target by source, and the number of copies of each row of (id, text, source)."""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if most * sizes[s] <= weight[s] * level}
        if not over:
            break
        full |= over
    target = {s: float(most * sizes[s]) if s in full else weight[s] * level for s in order}
    out, seen = [], Counter()
    for doc, text, source in docs:
        rate = target[source] / sizes[source] if sizes[source] else 0
        seen[doc, text or "", source] += 1
        drawn = draw(doc, text, seen[doc, text or "", source])
        out.append(int(rate) + (drawn < rate - int(rate)))
    return target, sizes, out
