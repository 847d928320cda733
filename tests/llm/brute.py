"""Plain single-machine versions of the corpus operators, for comparison on small inputs."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANKS.findall(text or "")


def components(nodes, linked):
    """Smallest member reachable, by flooding."""
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo, out[n] = [n], n
        while todo:
            a = todo.pop()
            for b in nodes:
                if b not in out and linked(a, b):
                    out[b] = n
                    todo.append(b)
    return out


def fingerprint(text, shingle=3):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def base_counts(text):
    text = text or ""
    w = words(text)
    where = defaultdict(list)
    for i in range(len(w) - 4):
        where[tuple(w[i:i + 5])].append(i)
    repeated = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), sum(n - 1 for n in Counter(lines).values()), len(repeated)


def normal(line):
    return " ".join(words(line.translate(LOWER)))


def quality(rows, min_docs=20, share=0.05):
    """rows: (doc_id, text, source) -> {doc_id: (counts, base_failed, kept, clean text)}"""
    hosts, held = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        if t is not None:
            hosts[s].add(t)
            for line in t.split("\n"):
                if normal(line):
                    held[s, normal(line)].add(t)
    over = {k for k, v in held.items() if len(v) > min_docs and len(v) > share * len(hosts[k[0]])}
    out = {}
    for d, t, s in rows:
        counts = base_counts(t)
        lines = (t or "").split("\n")
        left = [x for x in lines if (s, normal(x)) not in over]
        n_left = counts[0] - sum(len(words(x)) for x in lines if (s, normal(x)) in over)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        out[d] = counts, failed, not failed and n_left >= 10 and n_left >= 0.5 * counts[0], "\n".join(left) if len(left) < len(lines) else t
    return out


def paragraphs(rows, min_words):
    """rows: (doc_id, text) -> [(doc_id, line number, normal form)]"""
    return [(d, i, normal(x)) for d, t in rows for i, x in enumerate((t or "").split("\n")) if len(words(x)) >= min_words]


def jaccard(a, b, n=5):
    wa, wb = a.split(" "), b.split(" ")
    sa, sb = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for w in (wa, wb))
    return len(sa & sb) / len(sa | sb)


def substring_dedup(rows, min_words=25, threshold=0.8):
    """{(doc_id, line number)} of removed paragraphs."""
    found = paragraphs(rows, min_words)
    forms = sorted({p for _, _, p in found})
    number = {p: i for i, p in enumerate(forms)}
    of = components(range(len(forms)), lambda a, b: jaccard(forms[a], forms[b]) >= threshold)
    classes = defaultdict(list)
    for d, i, p in found:
        classes[of[number[p]]].append((d, i))
    return {x for at in classes.values() if len({d for d, _ in at}) > 1 for x in at if x != min(at)}


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(LOWER))


def contamination(rows, items, window=10):
    """{doc_id: (n_words, n_hit, sorted item ids)}"""
    windows = defaultdict(set)
    for item, t in items:
        w = bench_words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[i:i + window])].add("null" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for d, t in rows:
        w = bench_words(t)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out[d] = len(w), len(hit), sorted(found)
    return out


def sha256(ids):
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def crc32(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def pairs(xs):
    return itertools.combinations(xs, 2)
