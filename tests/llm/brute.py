"""Plain versions of the operators, one document at a time, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE = r"[\x20\x09-\x0D]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text, n=4, seed=42):
    own = words((text or "").translate(LOWER))
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + n]), seed) for i in range(max(1, len(own) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, radius=4):
    """[(doc_id, fingerprint, component)] for [(doc_id, text)]."""
    marks = [simhash(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(docs, group, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return [(d, f"{m:016x}", least.get(g)) for (d, _), m, g in zip(docs, marks, group, strict=True)]


def quality(text):
    body = text or ""
    own = words(body)
    lines = [line for line in body.split("\n") if words(line)]
    at = defaultdict(list)
    for i in range(len(own) - 4):
        at[tuple(own[i : i + 5])].append(i)
    covered = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 5)}
    n = len(own)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", body)), len(lines) - len(set(lines)), len(covered), failed)


def scores(docs, order):
    """[(n_words, log_score)] of stupid backoff over all words, own occurrences left out."""
    own = [words((t or "").translate(LOWER)) for _, t in docs]
    total = sum(map(len, own))

    def grams(ws):
        return Counter(tuple(ws[i : i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1))

    every = sum(map(grams, own), Counter())

    def ratio(gram, mine):
        if len(gram) == 1:
            return every[gram] / total
        rest = every[gram] - mine[gram]
        return rest / every[gram[:-1]] if rest > 0 else 0.4 * ratio(gram[1:], mine)

    out = []
    for ws in own:
        mine = grams(ws)
        at = [tuple(ws[max(0, i - order + 1) : i + 1]) for i in range(len(ws))]
        out.append((len(ws), sum(math.floor(math.log(ratio(g, mine)) * 1e6 + 0.5) for g in at)))
    return out


def substrings(docs, length=50):
    """[(doc_id, n_words, n_removed, kept)]; a null doc_id sorts first."""
    order = [-(1 << 63) if d is None else d for d, _ in docs]
    own = [words(t) for _, t in docs]
    first = {}
    for o, ws in zip(order, own, strict=True):
        for i in range(len(ws) - length + 1):
            key = tuple(ws[i : i + length])
            first[key] = min(o, first.get(key, o))
    out = []
    for (d, _), o, ws in zip(docs, order, own, strict=True):
        gone = set()
        for i in range(len(ws) - length + 1):
            if first[tuple(ws[i : i + length])] < o:
                gone.update(range(i, i + length))
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out.append((d, len(ws), len(gone), sha(" ".join(kept))))
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, size=10):
    """[(doc_id, n_words, n_hit, items)]."""
    windows = defaultdict(set)
    for item, text in items:
        own = bench_words(text)
        n = min(size, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            windows[tuple(own[i : i + n])].add(item)
    out = []
    for d, text in docs:
        own, hit, found = bench_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                key = tuple(own[i : i + n])
                if key in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out.append((d, len(own), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def lines(docs, least=40, often=5):
    """[(doc_id, n_lines, n_dropped, kept)]; rows count as documents."""
    own = [[(line, re.sub(f"^{SPACE}+|{SPACE}+\\Z", "", line).translate(LOWER)) for line in (t or "").split("\n")] for _, t in docs]
    holders = defaultdict(list)
    for (d, _), ls in zip(docs, own, strict=True):
        for key in {k for _, k in ls if len(k) >= least}:
            holders[key].append(-(1 << 63) if d is None else d)
    last = {k: max(ds) for k, ds in holders.items() if len(ds) >= often}
    out = []
    for (d, _), ls in zip(docs, own, strict=True):
        me = -(1 << 63) if d is None else d
        kept = [line for line, k in ls if k not in last or last[k] == me]
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out
