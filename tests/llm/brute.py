"""Plain versions of the operators, for small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = SPACE_WORDS.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near(rows):
    """doc_id -> (n_shingles, component_id)"""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def contamination(rows, items, window=13):
    """doc_id -> (n_words, n_hit, sorted item ids)"""
    found = defaultdict(set)
    for item, text in items:
        words = ALNUM_WORDS.findall(lower(text))
        n = min(len(words), window)
        for i in range(len(words) - n + 1 if words else 0):
            found[tuple(words[i : i + n])].add(str(item))
    sizes = {len(w) for w in found}
    out = {}
    for doc, text in rows:
        words = ALNUM_WORDS.findall(lower(text))
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                who = found.get(tuple(words[i : i + n]))
                if who:
                    hit.update(range(i, i + n))
                    ids |= who
        out[doc] = (len(words), len(hit), sorted(ids))
    return out


def repeats(rows, length=35):
    """One (n_words, n_removed, kept text) per row."""
    texts = [SPACE_WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for w in texts:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def luhn(digits):
    odd = [int(d) for d in digits[::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def identifiers(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def url_parts(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[2]), m[3]) if m else ("", "")


def url_verdict(url, rules, default="allow"):
    host, path = url_parts(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, default)


def plant_period(doc_id, words):
    """The words of a document as operator 11 wants them."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def runs(words, least=6, exponent=4):
    """All (start, length, period), diagonal by diagonal."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def without_runs(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def interpolated(rows, folds=10, rounds=20, close=0.001):
    """(doc_id, text) -> (held_out, n_tokens, n_known, N, base score, score), all in plain loops, and
    a function that gives the probability of a word after two others."""
    texts = []
    for i, text in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else None
        role = 2 if h is None else 0 if h % folds == 0 else 1 if h // folds % folds == 0 else 2
        texts.append((role, ["<b>", "<b>", *SPACE_WORDS.findall(lower(text)), "<e>"]))

    def counts(roles):
        grams, contexts = Counter(), Counter()
        for role, words in texts:
            if role in roles:
                for at in range(2, len(words)):
                    for n in range(3):
                        grams[tuple(words[at - n : at + 1])] += 1
                        contexts[tuple(words[at - n : at])] += 1
        return grams, contexts

    def parts(model, words, at):
        grams, contexts = model
        out = []
        for n in range(3):
            seen = contexts[tuple(words[at - n : at])]
            out.append((grams[tuple(words[at - n : at + 1])] / seen if seen else 0.0, seen.bit_length()))
        return out

    every = counts({1, 2})
    known = {w[0] for w in every[0] if len(w) == 1}
    total, floor = every[1][()], 1 / (len(known) + 1)
    weights = defaultdict(lambda: 0.5)
    part = counts({2})
    events = [parts(part, words, at) for role, words in texts if role == 1 for at in range(2, len(words))]

    def weight(n, kind):
        if kind == 0:
            return 0.0
        met = [d for d in range(1, kind + 1) if (n, d) in weights]
        return weights[n, met[-1]] if met else 0.5

    def levels(event):
        mixed = [floor]
        for n, (ratio, kind) in enumerate(event):
            mixed.append(weight(n, kind) * ratio + (1 - weight(n, kind)) * mixed[-1])
        return mixed

    for _ in range(rounds if events else 0):
        own, reached = Counter(), Counter()
        for event in events:
            mixed, share = levels(event), 1.0
            for n in (2, 1, 0):
                ratio, kind = event[n]
                here = share * weight(n, kind) * ratio / mixed[n + 1]
                own[n, kind] += here
                reached[n, kind] += share
                share -= here
        before = {k: weight(*k) for k in reached}
        weights.update({k: round(own[k] / reached[k], 6) for k in reached if k[1]})
        if max(abs(weight(*k) - v) for k, v in before.items()) < close:
            break

    def probability(words, at):
        return levels(parts(every, words, at))[-1]

    out = []
    for role, words in texts:
        places = range(2, len(words))
        base = sum(math.log10((every[0][(words[at],)] + 0.1) / (total + 0.1 * (len(known) + 1))) for at in places)
        score = sum(math.log10(probability(words, at)) for at in places)
        out.append((role == 0, len(words) - 2, sum(words[at] in known for at in places), total, base, score))
    return out, probability, known


def hard_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    """Rows ``(vec_id, vector, label)`` to sorted (anchor, positive, rank, negative, scores)."""
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(scale * x) for x in v]
            if sum(x * x for x in whole) < 2**62:
                usable.append((i, label, whole))
    anchors = {}
    for i, label, v in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for i, (label, v) in anchors.items():
        met = [(-sum(x * y for x, y in zip(v, w)), j, other == label) for j, other, w in usable if len(w) == len(v)]
        for p, pid, _ in sorted((s, j, a) for s, j, a in met if a and j != i)[:positives]:
            kept = sorted((s, j) for s, j, a in met if not a and -low * p <= -100 * s <= -high * p)[:negatives]
            out += [(i, pid, rank, j, -p, -s) for rank, (s, j) in enumerate(kept, 1)]
    return sorted(out)
