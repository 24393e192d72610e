"""Small documents with every odd case, and plain versions of what the operators compute."""

import re

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sentence(seed, n=40):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(n))


def odd_rows():
    a, b, c = sentence(1), sentence(2, 60), sentence(3, 25)
    long = " ".join(sentence(k, 200) for k in range(10, 30))
    texts = [
        (5, a), (3, a), (7, a + " tail é"), (7, a + " tail é"), (9, None), (10, ""), (11, " \n\t "), (12, "one two"), (13, "one two"),
        (14, "One two"), (15, c + " " + b), (16, b + " " + c), (17, "x " * 300), (18, "x " * 200 + "y"), (19, long), (20, long + " z"),
        (21, b[:-3]), (None, b), (None, a), (22, "ünï " * 20), (23, "ünï " * 20), (24, a.upper()), (7, "other text under the same id " + c),
    ]
    return [(i, t, "en", f"s{k % 2}", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


def frame(spark, rows=None, schema=DOCS):
    return spark.createDataFrame(odd_rows() if rows is None else rows, schema)


def key(i):
    return (1 << 63) - 1 if i is None else i


def words(text):
    return SPACE.findall((text or "").encode())


def removed(rows, window, split):
    """Per row: symbols and which of them a smaller document's window covers."""
    owner, parts = {}, []
    for i, text in rows:
        w = split(text)
        parts.append(w)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            owner[g] = min(owner.get(g, key(None)), key(i))
    out = []
    for (i, _), w in zip(rows, parts):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if owner[tuple(w[k : k + window])] < key(i):
                gone[k : k + window] = [True] * window
        out.append((w, gone))
    return out


def groups(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def shingles(text, size):
    w = [x.translate(LOW) for x in words(text)]
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1))


def jaccard_groups(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = groups(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, key(None)), key(i))
    return [least[r] for r in root], [len(s) for s in sets]
