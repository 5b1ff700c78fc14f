"""The operators' contracts, one document after another."""

import hashlib
import re
import zlib
from collections import Counter
from math import log

import numpy as np
import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def base_measures(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def grams(text, buckets):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in SPACED.findall(text or "")]
    pairs = [
        xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(hashes, hashes[1:])
    ]
    signed = [h - (1 << 64) if h >= 1 << 63 else h for h in hashes + pairs]
    return [h % buckets for h in signed]


def mean_ratios(docs, trusted, cfg):
    """Whole millionths per document, from (doc_id, text) and the trusted ids."""
    raw, good = Counter(), Counter()
    listed = [grams(t, cfg.buckets) for _, t in docs]
    for (i, _), own in zip(docs, listed):
        raw.update(own)
        if i is not None and i in trusted:
            good.update(own)
    n_raw, n_good, spread = sum(raw.values()), sum(good.values()), cfg.smoothing * cfg.buckets

    def ratio(b):
        if not n_good:
            return 0
        return round(log(((good[b] + cfg.smoothing) / (n_good + spread)) / ((raw[b] + cfg.smoothing) / (n_raw + spread))) * 1e6)

    table = {b: ratio(b) for b in raw}
    return [sum(table[b] for b in own) // max(1, len(own)) for own in listed]


def fingerprint(text):
    words = SPACED.findall(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(prints):
    """For each fingerprint its component, as the smallest place in the list."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    array = np.array(prints, np.uint64)
    for i in range(len(array)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 2) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def windows_of(items, size=10):
    found = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - size + 1)) if words else ():
            found.setdefault(tuple(words[i : i + size]), set()).add(item)
    return found


def leaks(text, windows):
    words, hit, items = WORD.findall(lower(text)), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            own = windows.get(tuple(words[i : i + size]))
            if own:
                hit.update(range(i, i + size))
                items |= own
    listed = sorted(str(i) for i in items if i is not None)
    return len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


def substrings_removed(docs, depth=50):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) per (doc_id, text)."""
    first = {}
    for i, text in docs:
        data, rank = (text or "").encode(), float("inf") if i is None else i
        for o in range(len(data) - depth + 1):
            w = data[o : o + depth]
            first[w] = min(first.get(w, rank), rank)
    out = []
    for i, text in docs:
        data, rank = (text or "").encode(), float("inf") if i is None else i
        gone = bytearray(len(data))
        for o in range(len(data) - depth + 1):
            if first[data[o : o + depth]] < rank:
                gone[o : o + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def token_rows(docs, tokenizer, end=2):
    """(doc_id, start, n, crc32) of documents in order."""
    out, start = [], 0
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def merkle_rows(docs):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""

    def h(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(values):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)

    def climb(nodes):
        """The one node above, and per node its siblings by level: (left, right)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, place in enumerate(at):
                low = place // 8 * 8
                paths[k].append((nodes[low:place], nodes[place + 1 : low + 8]))
                at[k] = place // 8
            nodes = [h(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        return nodes[0], paths

    groups = {}
    for row in docs:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = climb([leaf(r) for r in rows])
    root, upper = climb([trees[lang][0] for lang in order]) if order else (None, [])
    out = []
    for lang, above in zip(order, upper):
        subroot, paths = trees[lang]
        for row, path in zip(groups[lang], paths):
            path = path + above
            false = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            node = leaf((*row[:4], lower(row[4]))) if false else leaf(row)
            for left, right in path:
                node = h([*left, node, *right])
            proof = h(s for left, right in path for s in [*left, *right])
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return out


def runs_in(words, least=12):
    """All (start, length, smallest period), word by word."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def without_repeats(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def period_row(doc_id, text):
    words = planted(doc_id, SPACED.findall(text or ""))
    runs = runs_in(words)
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()
    rest = hashlib.sha256(without_repeats(words, runs).encode()).hexdigest()
    return doc_id, len(runs), s, length, q, 1000 * length // q if runs else None, digest, rest
