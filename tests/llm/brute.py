"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def kept_words(docs, size=13):
    """doc_id -> (words, removed, kept text) of (doc_id, text) rows."""
    first = {}
    for i, t in docs:
        w = WORD.findall(t or "")
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < i:
                gone.update(range(s, s + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def gone_words(docs, size=13):
    """doc_id -> numbers of the words that ``kept_words`` removes."""
    first, out = {}, {}
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in words:
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            first[k] = min(first.get(k, i), i)
    for i, w in words:
        out[i] = {p for s in range(len(w) - size + 1) if first[tuple(w[s : s + size])] < i for p in range(s, s + size)}
    return out


def rest(t, gone, word=WORD):
    """The text without the words numbered ``gone`` and the white space behind them, lines kept apart."""
    found = list(word.finditer(t))
    out, at, i = "", 0, 0
    while i < len(found):
        if i not in gone:
            i += 1
            continue
        j = i
        while j < len(found) and j in gone:
            j += 1
        begin, end = found[i].start(), found[j].start() if j < len(found) else len(t)
        out += t[at:begin]
        if "\n" in t[begin:end] and begin and t[begin - 1] != "\n" and end < len(t):
            out += "\n"
        at, i = end, j
    return out + t[at:]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def simhash(t, size=3):
    w = WORD.findall(lower(t or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=2):
    """key -> smallest key linked, of (key, fingerprint) rows."""
    root = {k: k for k, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in prints:
        for b, y in prints:
            if a < b and bin(x ^ y).count("1") <= radius:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k, _ in prints}


def quality(t):
    """(words, characters in words, symbols, equal lines, words in repeated windows)"""
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def posterior(votes, prior=0.9, rounds=200):
    """Probability of being good of each row of votes (0 bad, 1 none, 2 good), row by row."""
    n, rules = len(votes), range(len(votes[0]))
    count = lambda weight, i: [sum(w for v, w in zip(votes, weight) if v[i] == o) + 1 for o in range(3)]
    rates = [[], []]
    for i in rules:
        c = count([1] * n, i)
        for cls, bad in enumerate((0.4, 0.02)):
            rates[cls].append([bad, (1 - bad) * c[1] / (c[1] + c[2]), (1 - bad) * c[2] / (c[1] + c[2])])
    share, good = prior, [prior] * n
    for _ in range(rounds):
        before, good = good, []
        for v in votes:
            like = [share_ for share_ in (1 - share, share)]
            for cls in (0, 1):
                for i in rules:
                    like[cls] *= rates[cls][i][v[i]]
            good.append(like[1] / (like[0] + like[1]))
        if max(abs(a - b) for a, b in zip(good, before)) < 1e-9:
            break
        for i in rules:
            held = [count([1 - g for g in good], i), count(good, i)]
            if held[0][0] / sum(held[0]) < held[1][0] / sum(held[1]):
                held = [[a + b for a, b in zip(*held)]] * 2
            for cls in (0, 1):
                rates[cls][i] = [x / sum(held[cls]) for x in held[cls]]
        share = (sum(good) + 1) / (n + 2)
    return good


def pieces(text, key_hash, vocabulary, alpha, seed):
    """Forward filtering and backward sampling of one text, place by place."""
    import math

    import numpy as np

    from feedloom.llm.pieces import SPACE, uniform

    weight = {i: -alpha * math.log(2 + r) for i, r in vocabulary.ranks.items()}
    in_bytes = -alpha * math.log(2 + len(vocabulary.pieces))
    out = []
    for number, word in enumerate(re.findall(r"\n| +[^ \n]*|[^ \n]+", text)):
        looked = word.replace(SPACE, "\0").replace(" ", SPACE)
        n = len(word)
        edges = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(n, i + 32) + 1):
                if looked[i:j] in vocabulary.ids:
                    p = vocabulary.ids[looked[i:j]]
                    edges[j].append((j - i, weight[p], [p], i))
            if looked[i] not in vocabulary.ids:
                raw = word[i].encode()
                edges[i + 1].append((99, in_bytes * len(raw), [vocabulary.byte[b] for b in raw], i))
        forward = [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = math.log(sum(math.exp(forward[e[3]] + e[1]) for e in edges[j]))
        ids, j, step = [], n, 0
        while j:
            u = uniform(seed, np.array([key_hash], np.int64), np.array([number]), step)[0]
            total = 0.0
            for _, w, p, i in sorted(edges[j], key=lambda e: e[0]):
                total += math.exp(forward[i] + w - forward[j])
                if u < total:
                    break
            ids = p + ids
            j, step = i, step + 1
        out += ids
    return out


def kernel(a, b, decay):
    """The string kernel of three characters, by listing all subsequences."""
    from itertools import combinations

    def weights(s):
        out = Counter()
        for t in combinations(range(len(s)), 3):
            out["".join(s[i] for i in t)] += decay ** (t[-1] - t[0] + 1)
        return out

    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5 if x and y else 0.0
