"""Plain-Python versions of the operators' results, for small tables."""

import hashlib
import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(docs, max_docs=10, max_share=0.1, share_docs=5, min_left=0.3, min_words=50):
    """docs: (doc_id, text, source) rows; documents with the same lines count once in a host."""
    lines, hosts, out = Counter(), Counter(), []
    norm = lambda x: " ".join(WORD.findall(lower(x)))
    for source, content in {(s, frozenset({norm(x) for x in (t or "").split("\n")} - {""})) for _, t, s in docs}:
        hosts[source] += 1
        for x in content:
            lines[source, x] += 1
    for doc, text, source in docs:
        text = text or ""
        words = WORD.findall(text)
        wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = Counter(wins)
        rep = {i + j for i, w in enumerate(wins) if many[w] > 1 for j in range(3)}
        seen, dup = set(), 0
        left = len(words)
        for x in text.split("\n"):
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
                n = lines[source, norm(x)]
                if n > max_docs or (n >= share_docs and n > max_share * hosts[source]):
                    left -= len(WORD.findall(x))
        failed = len(words) < min_words or 100 * len(rep) > 50 * len(words)
        out.append((doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(rep), failed,
                    not failed and left >= min_left * len(words) and left >= min_words))
    return out


def hits(docs, items, width=10):
    wins = {}
    for item, text in items:
        words = ALNUM.findall(lower(text))
        w = min(width, len(words))
        for i in range(len(words) - w + 1):
            if w:
                wins.setdefault(tuple(words[i : i + w]), set()).add(str(item))
    widths = {len(w) for w in wins}
    out = []
    for doc, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for w in widths:
            for i in range(len(words) - w + 1):
                if x := wins.get(tuple(words[i : i + w])):
                    hit |= set(range(i, i + w))
                    found |= x
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def targets(sizes, share=1.0, epochs=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > epochs * sizes[s]} if total else set()
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        free -= over


def near(docs, width, percent):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {}
    for doc, text in docs:
        words = WORD.findall(lower(text))
        w = min(width, len(words))
        sets[doc] = {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: (len(sets[d]), find(d)) for d in ids}


def secret_spans(text):
    text, out = text or "", []
    for no, (kind, pattern, group, least) in enumerate((
        ("assign", r"""((?:(?ai:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
    )):
        out += [(m.start(), no, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def model(samples, alphabet, backoff):
    """Log-likelihood ratios of all transitions: ``(a, b) -> weight``."""
    out = Counter()
    for label, sign in ((1, 1), (0, -1)):
        pairs = Counter()
        for token, secret in samples:
            if secret == label:
                pairs.update((a, b) for a, b in zip(token, token[1:]) if a in alphabet and b in alphabet)
        total = sum(pairs.values()) + 0.5 * len(alphabet)
        after = Counter()
        start = Counter()
        for (a, b), n in pairs.items():
            after[b] += n
            start[a] += n
        for a in alphabet:
            for b in alphabet:
                out[a, b] += sign * math.log((pairs[a, b] + backoff * (after[b] + 0.5) / total) / (start[a] + backoff))
    return out


def random_spans(text, weights, least):
    """Base spans and the candidates beside them that score ``least`` or more per transition."""
    base = [x.split(":") for x in secret_spans(text)]
    order = ["assign", "access", "hex", "random"]
    spans = [(int(a), order.index(k), int(b)) for k, a, b in base]
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text or ""):
        t = m.group()
        if sum(weights[p] for p in zip(t, t[1:])) / (len(t) - 1) >= least:
            if not any(int(a) < m.end() and m.start() < int(b) for _, a, b in base):
                spans.append((m.start(), 3, m.end()))
    return ",".join(f"{order[k]}:{a}:{b}" for a, k, b in sorted(spans))


def phrases(text):
    words, out = ALNUM.findall(lower(text)), []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), out


def licenses(text, templates, k=5, band=8, least=0.4):
    """Labels and best score of the templates: hits by diagonal bands, neighbours merged, the longest rising chain of each span."""
    runs = lambda x: [tuple(x[i : i + k]) for i in range(len(x) - k + 1)]
    words, labels, best = runs(ALNUM.findall(lower(text))), set(), 0.0
    for label, template in templates:
        own, places, bands = runs(ALNUM.findall(lower(template))), {}, {}
        for t, run in enumerate(own):
            places.setdefault(run, []).append(t)
        for at, run in enumerate(words):
            for t in places.get(run, ()):
                bands.setdefault((at - t) // band, []).append((at, t))
        spans, last = [], None
        for b in sorted(bands):
            if last is None or b - last > 1:
                spans.append([])
            spans[-1] += bands[b]
            last = b
        for hits in spans:
            chain = {}
            for at, t in sorted(hits):
                chain[at, t] = 1 + max((n for (a, u), n in chain.items() if a < at and u < t), default=0)
            score = max(chain.values()) / len(own)
            if score >= least:
                labels.add(label)
                best = max(best, score)
    return labels, best


def repeats(docs, length=50):
    """(doc_id, bytes, removed, runs, digest of the rest) by brute force."""
    low = {}
    data = [(d, (t or "").encode()) for d, t in docs]
    for d, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if d is not None and (s not in low or d < low[s]):
                low[s] = d
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            first = low.get(b[p : p + length])
            if first is not None and (d is None or first < d):
                gone[p : p + length] = b"\1" * length
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def text_hash(text):
    """The engine's 64-bit hash of a text, which orders rows of one id."""
    return 42 if text is None else int.from_bytes(xxhash.xxh64(text.encode(), seed=42).digest(), "big", signed=True)


def line_dedup(docs, percent=80):
    """(doc_id, text) -> (lines, links of sets first seen here, kept line numbers)."""
    first, lines = {}, {}
    for d in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1]))):
        lines[d] = []
        for i, x in enumerate((d[1] or "").split("\n")):
            if s := frozenset(WORD.findall(x.lower())):
                lines[d].append((i, s))
                first.setdefault(s, (d, i))
    order = list(first)
    links, later = Counter(), set()
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                links[a] += 1
                links[b] += 1
                later.add(b)
    return {
        d: (len(own), sum(links[s] for i, s in own if first[s] == (d, i)),
            ",".join(str(i) for i, s in own if first[s] == (d, i) and s not in later))
        for d, own in lines.items()
    }
