"""Plain Python yardsticks for small fixtures."""

import hashlib
import itertools
import string


def _cut(text, marks, goes_on):
    """``text`` without each run that begins with one of ``marks``, followed by at least one character that goes on."""
    out, at = [], 0
    while at < len(text):
        mark = next((m for m in marks if text.startswith(m, at)), None)
        end = at + len(mark or "")
        while mark and end < len(text) and goes_on(text[end]):
            end += 1
        if mark and end > at + len(mark):
            at = end
        else:
            out.append(text[at])
            at += 1
    return "".join(out)


def words(text):
    """Character-wise yardstick of the cleaning rules."""
    unnamed = _cut(text.lower(), ("@",), lambda c: c.isalnum() or c == "_")
    unlinked = _cut(unnamed, ("https://", "http://", "www."), lambda c: not c.isspace())
    return unlinked.translate({ord(c): None for c in string.punctuation}).split()


def shingle_set(text, k=1):
    tokens = words(text)
    grams = {" ".join(tokens[i:i + k]) for i in range(len(tokens) - k + 1)}
    return {int(hashlib.md5(g.encode()).hexdigest()[:8], 16) for g in grams}


def similar_pairs(rows, threshold, k=1):
    """``{(doc_id_1, doc_id_2): similarity}`` over all pairs of each author."""
    sets = {}
    for doc_id, user, text in rows:
        shingles = shingle_set(text, k)
        if shingles:
            sets.setdefault(user, []).append((doc_id, shingles))
    found = {}
    for docs in sets.values():
        for (a, x), (b, y) in itertools.combinations(sorted(docs, key=lambda d: d[0]), 2):
            similarity = len(x & y) / len(x | y)
            if similarity >= threshold:
                found[(a, b)] = similarity
    return found


def as_dict(pairs):
    rows = pairs.collect()
    found = {(r.doc_id_1, r.doc_id_2): r.similarity for r in rows}
    assert len(found) == len(rows), "a pair is listed twice"
    return found
