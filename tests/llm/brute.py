"""Plain Python versions of the operators' contracts."""

import collections
import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items):
    """(doc_id, n_words, n_hit, items found)."""
    windows = {}
    for i, t in items:
        w = item_words(t)
        size = min(10, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).add(str(i))
    sizes, out = {len(k) for k in windows}, []
    for i, t in docs:
        w, hit, found = item_words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                key = tuple(w[a : a + n])
                if key in windows:
                    found |= windows[key]
                    hit |= set(range(a, a + n))
        out.append((i, len(w), len(hit), ",".join(sorted(found))))
    return out


def quality(text):
    w, seen, dup = white_words(text), set(), 0
    for line in (text or "").split("\n"):
        if white_words(line):
            dup += line in seen
            seen.add(line)
    grams = list(zip(w, w[1:], w[2:]))
    count, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def secrets(text):
    rules = (
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
    )
    found, n = [], []
    for rank, (kind, pattern, ok) in enumerate(rules):
        own = [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "", re.A) if ok(m)]
        n.append(len(own))
        found += own
    return (*n, sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private(text):
    digits = lambda v: re.sub("[^0-9]", "", v)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    )
    found, n = [], []
    for kind, pattern, ok in rules:
        own = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if ok(m.group())]
        n.append(len(own))
        found += own
    return (*n, sha(",".join(found)))


def shingles(words):
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def near(a, b):
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= 75 * (len(a) + len(b) - shared)


def removed_lines(docs):
    """doc_id -> (lines with a word, removed ones, text left); every doc_id once."""
    seen, out = [], {}
    for d, t in sorted(docs):
        keep, n, gone = [], 0, 0
        for line in t.split("\n"):
            s = shingles(white_words(line))
            if not s:
                keep.append(line)
                continue
            n += 1
            if any(near(s, o) for o in seen):
                gone += 1
            else:
                keep.append(line)
            seen.append(s)
        out[d] = (n, gone, "\n".join(keep))
    return out


def without_repeats(docs):
    first = {}
    for i, t in docs:
        w = white_words(t)
        for a in range(len(w) - 12) if i is not None else ():
            first[tuple(w[a : a + 13])] = min(first.get(tuple(w[a : a + 13]), i), i)
    out = []
    for i, t in docs:
        w, gone = white_words(t), set()
        for a in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[a : a + 13])] < i:
                gone |= set(range(a, a + 13))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def linked(docs):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {i: shingles(white_words((t or "").translate(LOWER))) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        others = {o for s in sets[i] for o in holders[s]}
        for o in others:
            if near(sets[i], sets[o]):
                a, b = sorted((root(i), root(o)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}
