"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

_UP = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lower(text):
    return (text or "").translate(_UP)


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def word_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text):
    text, spans = text or "", []
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    for m in assign.finditer(text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            spans.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            spans.append((m.start(), 2, "hex", m.end()))
    spans.sort()
    return [f"{k}:{a}:{b}" for a, _, k, b in spans]


def contamination(docs, items, width=10):
    """doc texts and (item_id, text) to (n_words, n_hit, item ids) per document."""
    windows = defaultdict(set)
    for item, text in items:
        words = word_words(text)
        n = min(width, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows[tuple(words[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        words = word_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                key = tuple(words[i : i + n])
                if key in windows:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in windows[key] if x is not None}
        out.append((len(words), len(hit), sorted(found)))
    return out


def targets(sizes, repeat=3, weights=(1, 2, 3)):
    """source to size, to source to target."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, level = sum(sizes.values()), set(), 0.0
    while True:
        left = sum(weight[s] for s in sizes if s not in full)
        if left:
            level = (total - sum(repeat * sizes[s] for s in full)) / left
        more = {s for s in sizes if weight[s] * level > repeat * sizes[s]} | full
        if more == full:
            return {s: float(min(weight[s] * level, repeat * sizes[s])) for s in sizes}
        full = more


def base_scores(docs):
    """(doc_id, text) to (held_out, n_tokens, n_known, N, base score) per document."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    tokens = [[*spaced_words(lower(t)), None] for _, t in docs]
    c = Counter(x for h, t in zip(held, tokens, strict=True) if not h for x in t)
    n, v = sum(c.values()), len(c)
    return [
        (h, len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t))
        for h, t in zip(held, tokens, strict=True)
    ]


def quality_counts(text):
    text = text or ""
    words = spaced_words(text)
    lines = [x for x in text.split("\n") if spaced_words(x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(triples)
    covered = {j for i, t in enumerate(triples) if count[t] > 1 for j in range(i, i + 3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def fingerprint(text):
    words = spaced_words(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=2):
    """(doc_id, fingerprint) rows to the component id of each fingerprint."""
    prints = sorted({f for _, f in rows})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    known = defaultdict(list)
    for d, f in rows:
        known[find(f)] += [] if d is None else [d]
    return {f: min(known[find(f)], default=None) for f in prints}


def cut_and_turned(doc_id, text, seed=42, fim=50, spm=80):
    """n, form, code points of prefix and middle, and output of a fill-in-the-middle text."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def _siblings(levels, at):
    path = []
    for nodes in levels[:-1]:
        begin = at - at % 16
        path.append(("".join(nodes[begin:at]), "".join(nodes[at + 1 : begin + 16])))
        at //= 16
    return path


def merkle(rows):
    """(doc_id, source, lang, n_chars, text) rows to the columns of the report."""
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    trees = {s: _levels([leaf(r) for r in members[s]]) for s in order}
    above = _levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(members[s]):
            path = _siblings(trees[s], i) + _siblings(above, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            node = leaf((*r[:4], lower(r[4]))) if tampered else leaf(r)
            for before, after in path:
                node = sha(before + node + after)
            proof = sha("".join(b + a for b, a in path))
            root = above[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, proof, node, node == root))
    return out
