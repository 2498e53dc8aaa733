"""Plain versions shared by test modules."""

import re

WORD8 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words8(text):
    return WORD8.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, size=10):
    """(words, hit words, items hit) of a document."""
    w, hit, ids = words8(text), set(), set()
    for name, t in items:
        b = words8(t)
        n = min(size, len(b))
        wanted = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in wanted:
                hit.update(range(i, i + n))
                ids.add(name or "")
    return len(w), len(hit), sorted(ids)
