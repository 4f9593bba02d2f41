"""Small tables with every hard case, and brute-force versions of the operators."""

import random
import re
from collections import defaultdict

WORDS = "alpha beta gamma delta Epsilon zeta éta thêta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, uid string, block string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def corpus(seed=3):
    """Documents with exact, near and nested copies, shared passages, nulls, empty, repetitive and very long texts."""
    rng = random.Random(seed)
    passage, line = prose(rng, 90), prose(rng, 20)
    base = prose(rng, 200)
    texts = [prose(rng, rng.randrange(1, 160)) for _ in range(30)]
    texts += [base, base, base + " end", base.replace(" ", "\t", 5), "x " + base]
    for i in range(6):
        words = base.split()
        words[rng.randrange(len(words))] = f"edit{i}"
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(5)]
    texts += [f"{prose(rng, 5)}\n{line}\n{prose(rng, 8)}" for _ in range(8)]
    texts += [None, "", "   \n\t ", "one", "one two", "one two", "ONE Two", "a " * 900, "ab" * 500, "é" * 450, "\x0bone\x0ctwo\r"]
    texts += [prose(rng, 30_000), passage]
    rows = [(i, x, "en", f"src{i % 4}" if i % 9 else None, len(x or ""), "clash", "clash", "clash") for i, x in enumerate(texts)]
    rows += [(None, base, None, None, None, None, None, None), (7, texts[7], "en", "src1", 1, "clash", None, None)]
    rng.shuffle(rows)
    return rows


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def windows_removed(rows, k=13):
    """doc_id -> (words, kept words) by the rule on k-word windows."""
    first = {}
    for i, x, *_ in rows:
        w = words(x)
        for j in range(len(w) - k + 1) if i is not None else ():
            key = tuple(w[j : j + k])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, x, *_ in rows:
        w = words(x)
        gone = [False] * len(w)
        for j in range(len(w) - k + 1) if i is not None else ():
            if first[tuple(w[j : j + k])] < i:
                gone[j : j + k] = [True] * k
        out[i] = (len(w), " ".join(a for a, b in zip(w, gone) if not b))
    return out


def bytes_removed(rows, length):
    """A list of (doc_id, bytes, kept bytes) by the rule on byte strings."""
    seen = defaultdict(int)
    raws = [(i, (x or "").encode()) for i, x, *_ in rows]
    for _, b in raws:
        for j in range(len(b) - length + 1):
            seen[b[j : j + length]] += 1
    out = []
    for i, b in raws:
        gone, until = bytearray(len(b)), 0
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                until = j + length
            if j < until:
                gone[j] = 1
        for j in range(max(0, len(b) - length + 1), until):
            gone[j] = 1
        out.append((i, len(b), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shingles(text, k):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_components(rows, k, part=80, whole=100):
    """doc_id -> smallest doc_id reachable over links between sets of k-word shingles."""
    sets = {i: shingles(x, k) for i, x, *_ in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    names = sorted(sets)
    for a in names:
        for b in names:
            if a < b and sets[a] and sets[b] and whole * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def passages(rows, length, count):
    """A list of (doc_id, bytes covered by repeated strings of `length` bytes, or of `count` words under `length` bytes)."""
    raws = [(i, (x or "").encode()) for i, x, *_ in rows]
    strings = [[(j, j + length) for j in range(len(b) - length + 1)] for _, b in raws]
    for (_, b), own in zip(raws, strings):
        w = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", b)]
        own += [(x, y) for (x, _), (_, y) in zip(w, w[count - 1 :]) if y - x < length]
    seen = defaultdict(int)
    for (_, b), own in zip(raws, strings):
        for x, y in set(own):
            seen[b[x:y]] += 1
    out = []
    for (i, b), own in zip(raws, strings):
        gone = set()
        for x, y in own:
            if seen[b[x:y]] > 1:
                gone.update(range(x, y))
        out.append((i, len(gone)))
    return out
