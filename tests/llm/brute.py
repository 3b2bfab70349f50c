"""Plain versions of the operators' results, one document or pair at a time."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    covered = {j for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def failed_bits(m):
    n_words, chars, symbols, dup, repeat, lines = m
    return (
        (n_words < 10) + 2 * (100 * repeat > 20 * n_words)
        + 4 * (n_words > 0 and (chars < 2 * n_words or chars > 25 * n_words))
        + 8 * (n_words > 0 and 10 * symbols > n_words) + 16 * (100 * dup > 30 * lines)
    )


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= size:
        return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def union(pairs, nodes):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near_duplicates(docs, size, percent=80):
    """doc_id -> (set size, component) of {doc_id: text}."""
    sets = {i: shingles(t, size) for i, t in docs.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in sets.items():
        for j, common in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                links.append((i, j))
    component = union(links, docs)
    return {i: (len(sets[i]), component[i]) for i in docs}


def kept_words(docs, window):
    """doc_id -> (words, removed, digest of the kept words)."""
    words, first = {i: WORD.findall(t or "") for i, t in docs.items()}, {}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][j : j + window]), i)
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                keep[j : j + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out[i] = len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        double = int(c) * (1 + i % 2)
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def base_spans(text):
    """Sorted (start, kind number, end, kind)."""
    return sorted(
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "") if valid(kind, m[0])
    )


def spans_digest(text):
    shown = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in base_spans(text))
    return hashlib.sha256(shown.encode()).hexdigest()


def budgets(tree, weights, budget):
    """Share a budget over a tree of {name: subtree or room}: full children first, the rest by weight."""
    def room(node):
        return node if isinstance(node, int) else sum(map(room, node.values()))

    def share(node, path, amount, out):
        if isinstance(node, int):
            out[path] = amount
            return
        open_, given = {k: weights.get(path + (k,), 1) for k in node}, {}
        while True:
            left = amount - sum(given.values())
            total = sum(open_.values())
            full = [k for k, w in open_.items() if room(node[k]) * total <= left * w]
            if not full:
                break
            # The one that runs out first, as its share of a weight is the smallest.
            k = min(full, key=lambda k: (room(node[k]) / open_[k], k))
            given[k] = room(node[k])
            del open_[k]
        left, total = amount - sum(given.values()), sum(open_.values())
        for k, w in open_.items():
            given[k] = left * w // total
        for k, v in given.items():
            share(node[k], path + (k,), v, out)

    out = {}
    share(tree, (), budget, out)
    return out
