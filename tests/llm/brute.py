"""Plain versions of the operators, for small tables."""

import hashlib
import html as characters
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, source="s", first=0):
    rows = [
        (first + i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def shingles(text):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_duplicates(texts):
    """doc_id: (set size, component) of a dict of texts."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = [i for i in sets if sets[i]]
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    component = roots(sets, links)
    return {i: (len(sets[i]), component[i]) for i in sets}


def repeats(texts, length):
    """Per text: bytes, removed bytes, removed runs and hash of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    rows = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        rows.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return rows


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(s) for s in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def article(page):
    """The blocks of a page whose article holds nothing but headings and paragraphs."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    plain = (characters.unescape(re.sub("<[^>]*>", "", b)) for b in blocks)
    return "\n".join(filter(None, (" ".join(b.split()) for b in plain)))
