"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def repeated_bytes(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by looking at every
    string of ``length`` bytes of rows (doc_id, text)."""
    key = lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))
    first, out = {}, []
    ordered = sorted(rows, key=key)
    for r in ordered:
        t = (r[1] or "").encode()
        for p in range(len(t) - length + 1):
            first.setdefault(t[p:p + length], (key(r), p))
    for r in ordered:
        t = (r[1] or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] != (key(r), p):
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, size=4):
    words = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(fps, threshold=4):
    """The smallest id that each (id, fingerprint) reaches over links."""
    group = list(range(len(fps)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= threshold:
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, fp, least.get(root(i))) for i, (d, fp) in enumerate(fps)]


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def within(pattern, text, budget):
    """Whether a stretch of ``text`` is within ``budget`` edits (Sellers)."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        last, row = row, [0]
        for i, p in enumerate(pattern):
            row.append(min(last[i] + (p != c), last[i + 1] + 1, row[i] + 1))
        best = min(best, row[-1])
    return best <= budget


def host_path_rule(url, rules):
    """host, path, rule, what it says."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]
