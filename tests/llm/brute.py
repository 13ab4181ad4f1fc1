"""The contracts of the numbered queries, spelled out in plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def joined(spans, order):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM_WORDS.findall(lower(text))
        for i in range(max(1, len(words) - size + 1)) if words else ():
            windows[tuple(words[i : i + size])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = ALNUM_WORDS.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if owners := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= owners
        ids = ",".join(sorted(str(x) for x in found))
        out.append((doc, len(words), len(hit), len(found), sha(ids), bool(hit)))
    return out


def shingles(text, k=4):
    words = SPACE_WORDS.findall(lower(text))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_duplicates(docs, k=4):
    sets = [shingles(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter()
    for members in holders.values():
        for a in range(len(members)):
            for b in range(a):
                common[members[b], members[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least.setdefault(find(i), []).append(doc)
    return [(doc, len(sets[i]), min(least[find(i)]), doc == min(least[find(i)])) for i, (doc, _) in enumerate(docs)]


SECRETS = (
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def secrets(docs):
    out = []
    for doc, text in docs:
        spans, counts = [], []
        for order, (kind, pattern, group, least) in enumerate(SECRETS):
            found = [m for m in pattern.finditer(text or "") if len(m[group]) >= least]
            counts.append(len(found))
            spans += [(m.start(), order, m.end()) for m in found]
        base = joined([(SECRETS[o][0], a, b) for a, o, b in sorted(spans)], None)
        out.append((doc, *counts, sha(base)))
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


PERSONAL = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda t: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda t: all(int(x) <= 255 for x in t.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda t: 13 <= len(_digits(t)) <= 19 and luhn(_digits(t))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda t: 9 <= len(_digits(t)) <= 15),
)


def personal(docs):
    out = []
    for doc, text in docs:
        spans, counts = [], []
        for kind, pattern, passes in PERSONAL:
            found = [(kind, m.start(), m.end()) for m in pattern.finditer(text or "") if passes(m[0])]
            counts.append(len(found))
            spans += found
        out.append((doc, *counts, sha(joined(spans, None))))
    return out


def repeats(docs, size=13):
    first = {}
    words = [(doc, SPACE_WORDS.findall(text or "")) for doc, text in docs]
    for doc, w in words:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < doc:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def chats(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        out.append((conv, len(turns), sha(said), len(learned), sha(learned)))
    return out


def statistics(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        words = SPACE_WORDS.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if SPACE_WORDS.search(line):
                dup += line in seen
                seen.add(line)
        triples = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = set()
        for i in range(len(words) - 2):
            if triples[tuple(words[i : i + 3])] > 1:
                covered.update(range(i, i + 3))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        out.append(
            (doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)
        )
    return out


def pieces(docs, tokenizer, capacity=2048):
    out = []
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            out.append((doc, n, start, len(part), crc))
    return out


def periodic_stretches(words, least=6, power=4):
    """All runs as (start, length, smallest period), straight from the definition."""
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.array([code[w] for w in words], np.int64)
    found = {}
    for q in range(1, len(words) // power + 1):
        equal = np.concatenate([[0], codes[q:] == codes[:-q], [0]])
        steps = np.diff(equal)
        for i, j in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist()):
            if j - i + q >= max(least, power * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
    return sorted((a, b - a, q) for (a, b), q in found.items())


def planted(doc, text):
    words = SPACE_WORDS.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def periodic(docs):
    out = []
    for doc, text in docs:
        words = planted(doc, text)
        runs = periodic_stretches(words)
        dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        start, length, period = best or (None,) * 3
        milli = 1000 * length // period if best else None
        out.append((doc, len(runs), start, length, period, milli, sha(listed), sha(kept)))
    return out


def simhash(text, k=3):
    import xxhash

    words = SPACE_WORDS.findall(lower(text))
    spans = [words[i : i + k] for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def connected(prints, radius=3):
    """A number for each fingerprint's component, all pairs compared."""
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = list(parent)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {p: find(p) for p in names}


def simhash_groups(docs):
    prints = [simhash(t) for _, t in docs]
    root = connected(prints)
    least = {}
    for (doc, _), p in zip(docs, prints):
        if doc is not None:
            least[root[p]] = min(doc, least.get(root[p], doc))
    return [(doc, f"{p:016x}", least.get(root[p])) for (doc, _), p in zip(docs, prints)]


def divergence(docs, least_docs=3, top=200):
    """``docs`` are (lang, source, text)."""
    letters = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    held, used, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", c) for a, b, c in docs):
        words = letters.findall(lower(text))
        groups[lang].add(source)
        held[lang].update(set(words))
        used[lang, source].update(words)
        used[lang].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least_docs]

        def p(group):
            total = sum(used[group][t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (used[group][t] + 1) // total for t in kept}

        of, q = {s: p((lang, s)) for s in sources}, p(lang)
        for s in sources:
            pairs = [(t, sum((of[s][w] - of[t][w]) ** 2 // of[t][w] for w in kept)) for t in sources - {s}]
            terms = [(w, (of[s][w] - q[w]) ** 2 // q[w]) for w in kept if used[lang, s][w] and of[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(items[:limit])]
    return out
