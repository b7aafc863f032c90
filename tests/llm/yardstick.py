"""Plain Python counterparts of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc_fold(doc_id, n: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def tokens(docs, path: str, end_id: int) -> list[tuple[int, list[int]]]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id]) for i, t in docs]


def check_packing(pieces, docs, path: str, end_id: int = 2, most: int = 4096) -> None:
    """Every token in one piece, lengths powers of two, one piece per sequence, ids without gap."""
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    for doc_id, ids in tokens(docs, path, end_id):
        own, at = sorted(by_doc.pop(doc_id), key=lambda p: p["start"]), 0
        for p in own:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and len(part) == p["length"] and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    assert not by_doc
    assert all(p["length"] & (p["length"] - 1) == 0 and p["length"] <= most and p["offset"] == 0 for p in pieces)
    assert sorted(p["sequence_id"] for p in pieces) == list(range(len(pieces)))


def item_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, size: int = 13):
    found = []
    cut = {i: item_words(t) for i, t in items}
    for doc_id, text in docs:
        words, hit, named = item_words(text), set(), set()
        for item, own in cut.items():
            width = min(size, len(own))
            windows = {tuple(own[k : k + width]) for k in range(len(own) - width + 1)} if own else set()
            for k in range(len(words) - width + 1):
                if tuple(words[k : k + width]) in windows:
                    hit.update(range(k, k + width))
                    named.add(item)
        digest = sha(",".join(sorted(map(str, named))))
        found.append((doc_id, len(words), len(hit), len(named), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return found


def shingles(text, k: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def near_duplicates(docs, k: int = 4):
    sets = [(i, shingles(t, k)) for i, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(x)] = find(y)
    low: dict = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            low[find(x)] = min(low.get(find(x), i), i)
    return [(i, len(s), low.get(find(x)), i == low.get(find(x))) for x, (i, s) in enumerate(sets)]


def edited_texts(docs):
    """``(doc_id, n_chars, edited)`` in the stated order of rows."""
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out = []
    for at, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        out.append((doc_id, len(text), text[: len(text) - quarter] + after[:quarter]))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for at, char in enumerate(reversed(digits)):
        value = int(char) * (2 if at % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def pii_base(text) -> list[tuple[str, int, int]]:
    text, found = text or "", []
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in plain.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append((kind, m.start(), m.end()))
    return found


def secret_base(text) -> list[tuple[str, int, int]]:
    text, found = text or "", []
    names = "(password|passwd|secret|token|api_?key)"
    either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in names)
    assign = either + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for rank, (kind, pattern, least) in enumerate((("assign", assign, 12), ("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16))):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def span_text(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def unigrams(docs):
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)``; the end of a text is a token."""
    import collections
    import math

    split = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None] for _, t in docs]
    counts = collections.Counter()
    for (doc_id, _), words in zip(docs, split, strict=True):
        if crc_fold(doc_id, 7) != 2:
            counts.update(words)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (i, crc_fold(i, 7) == 2, len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w))
        for (i, _), w in zip(docs, split, strict=True)
    ]


def plain_line(line: str) -> str:
    return re.sub(r"[ \t\n\x0B\f\r]+", " ", line).strip(" ")


def line_shingles(line: str) -> set:
    return {line[i : i + 7] for i in range(max(1, len(line) - 6))}


def line_drops(docs):
    """``(doc_id, text)`` with repeated lines taken out."""
    order = lambda i, t, n: (i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest(), n)
    firsts: dict = {}
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n") if t is not None else []):
            if plain_line(line):
                firsts[plain_line(line)] = min(firsts.get(plain_line(line), (True, 1 << 62, "~", 0)), order(i, t, n))
    names = list(firsts)
    sets, root = [line_shingles(x) for x in names], list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(names)):
        for z in range(x):
            if 100 * len(sets[x] & sets[z]) >= 80 * len(sets[x] | sets[z]):
                root[find(x)] = find(z)
    best: dict = {}
    for x, name in enumerate(names):
        best[find(x)] = min(best.get(find(x), firsts[name]), firsts[name])
    keep = {name: best[find(x)] for x, name in enumerate(names)}
    out = []
    for i, t in docs:
        left = None if t is None else "\n".join(
            line for n, line in enumerate(t.split("\n")) if not plain_line(line) or keep[plain_line(line)] == order(i, t, n)
        )
        out.append((i, left))
    return out


def divergence(docs, least: int, listed: int):
    """Rows (lang, source, part, item, value, rank) of ``(text, lang, source)``, by trying everything."""
    docs = [tuple(x or "" for x in d) for d in docs]
    found = []
    for lang in {d[1] for d in docs}:
        own = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)), s) for t, l, s in docs if l == lang]
        spread: dict = {}
        for words, _ in own:
            for word in set(words):
                spread[word] = spread.get(word, 0) + 1
        kept = [w for w, n in spread.items() if n >= least]
        sources = {s for _, s in own}
        counts = {s: {w: 0 for w in kept} for s in [*sources, None]}
        for words, s in own:
            for word in words:
                if spread[word] >= least:
                    counts[s][word] += 1
                    counts[None][word] += 1
        shares = {
            s: {w: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for w, n in c.items()} for s, c in counts.items()
        }
        for s in sources:
            gap = [(o, sum(abs(shares[s][w] - shares[o][w]) for w in kept)) for o in sources if o != s]
            more = [(w, shares[s][w] - shares[None][w]) for w in kept if counts[s][w] and shares[s][w] > shares[None][w]]
            for part, rows, most in (("pair", gap, None), ("term", more, listed)):
                rows = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]
                found += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(rows)]
    return found


def with_repeats(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    crc = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if crc is None or crc % 10 or not words:
        return text
    n, g = len(words), crc // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return " ".join(words[i] if i < at else words[at + (i - at) % period] for i in range(n))


def periodic_runs(text):
    """``(n_words, runs, strongest, collapsed)`` by trying every period at every place."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        if len(set(words)) == 1 and q > 1:
            break  # one word throughout: period 1 is all there is
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(24, 3 * q):
                found.setdefault((i, end + q - i), q)
            i = end + 1
    runs = sorted((s, length, q) for (s, length), q in found.items())
    runs.sort(key=lambda r: (r[0], r[2]))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return n, runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)
