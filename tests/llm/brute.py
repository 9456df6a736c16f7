"""The contracts of the ten queries in plain Python, by the shortest way."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def contamination(docs, items, window=10):
    found = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            found[tuple(w[k : k + n])].add(str(item) if item is not None else "")
    out = []
    for doc, text in docs:
        w, hit, ids = alnum(text), set(), set()
        for n in {len(g) for g in found}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in found:
                    hit |= set(range(k, k + n))
                    ids |= found[g]
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def bytes_removed(docs, length=200):
    texts, times = [(t or "").encode() for _, t in docs], Counter()
    for b in texts:
        times.update(b[k : k + length] for k in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(docs, texts):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if times[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(b)))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def base_statistics(text):
    text = text or ""
    words, seen, dup = PLAIN.findall(text), set(), 0
    for line in text.split("\n"):
        if PLAIN.search(line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def shingles(text, size):
    w = PLAIN.findall((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def components(docs, size=4, percent=80):
    sets, parent, holders = [shingles(t, size) for _, t in docs], list(range(len(docs))), defaultdict(list)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        common = Counter(j for g in own for j in holders[g])
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in own:
            holders[g].append(i)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def words_removed(docs, length=50):
    words, first = [PLAIN.findall(t or "") for _, t in docs], {}
    for (doc, _), w in zip(docs, words):
        for k in range(len(w) - length + 1 if doc is not None else 0):
            g = tuple(w[k : k + length])
            first[g] = min(first.get(g, doc), doc)
    out = []
    for (doc, _), w in zip(docs, words):
        gone = [False] * len(w)
        for k in range(len(w) - length + 1 if doc is not None else 0):
            if first[tuple(w[k : k + length])] < doc:
                gone[k : k + length] = [True] * length
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def licenses(text, templates, shingle=5, percent=80):
    w, out = alnum(text), []
    for name, template in sorted(templates):
        v = alnum(template)
        if not v:
            continue
        s, best = min(shingle, len(v)), None
        wanted = {tuple(v[i : i + s]) for i in range(len(v) - s + 1)}
        step = max(1, len(v) // 8)
        for begin in range(0, len(w), step):
            z = w[begin : begin + len(v) + len(v) // 4 + step]
            n = len(wanted & {tuple(z[i : i + s]) for i in range(len(z) - s + 1)})
            if n and 100 * n >= percent * len(wanted) and (best is None or n > best[3]):
                best = (name, begin, len(wanted), n)
        out += [best] if best else []
    return out


def conversations(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return out
