"""Small tables with every odd case, and brute-force versions to compare with."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(20_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
BODY = [" ".join(f"t{d}n{i}" for i in range(80)) for d in range(12)]

#: Columns whose names the operators use themselves.
CLASHES = ["size", "Target", "taken", "position", "shard", "slot", "score", "kept", "block", "body", "id", "c0", "_key"]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in CLASHES
)


def documents(spark, rows=None):
    """Rows of (doc_id, text, source) as a documents table with clashing further columns."""
    rows = ODD if rows is None else rows
    full = [(d, t, "en", s, None if t is None else len(t), *CLASHES) for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, BODY[0], "a"),
    (2, BODY[0] + " one more", "a"),
    (3, "  " + BODY[0].upper() + "\n", "b"),
    (4, BODY[1] + " " + PASSAGE, "a"),
    (5, PASSAGE + "\t" + BODY[2], None),
    (6, BODY[3] + "\n" + PASSAGE + " " + BODY[4], "b"),
    (7, None, "a"),
    (8, "", "a"),
    (9, " \t\n ", None),
    (10, "one two", "c"),
    (11, "One TWO", "c"),
    (12, LONG, "a"),
    (13, LONG[: len(LONG) // 2], "d"),
    (14, "é€😀 " * 40, "a"),
    (15, "é€😀 " * 40, "a"),
    (16, "\x00" * 120 + "x", "d"),
    (17, "\x00" * 120 + "y", "d"),
    (18, BODY[5], "\u00e9"),
    (18, BODY[5], "\u00e9"),
    (19, BODY[5], "a"),
    (20, BODY[6], "a"),
    (20, BODY[7], "a"),
    (-5, BODY[6], "b"),
    (None, BODY[8], "a"),
    (None, BODY[8], None),
    (30, BODY[8], "a"),
    (31, "aaaa " * 300, "b"),
    (32, "b " + "aaaa " * 300, "b"),
    (33, "solid" * 400, "b"),
    (34, "x" + "solid" * 400, "b"),
]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def stretches(units, length):
    return [tuple(units[i : i + length]) for i in range(len(units) - length + 1)]


def brute_cut(rows, split, join, length):
    """(doc_id, units, removed, spans, hash) of every row, by a table of all stretches."""
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            for s in stretches(split(t or ""), length):
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t, *_ in rows:
        units = split(t or "")
        gone = [False] * len(units)
        for i, s in enumerate(stretches(units, length)):
            if d is not None and first[s] < d:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = [u for u, g in zip(units, gone, strict=True) if not g]
        out.append((d, len(units), sum(gone), spans, sha(join(kept))))
    return sorted(out, key=repr)


def brute_bytes(rows, length=50):
    return brute_cut(rows, lambda t: list(t.encode()), bytes, length)


def brute_words(rows, length=13):
    return brute_cut(rows, WORD.findall, lambda w: " ".join(w).encode(), length)


def shingles(text, size=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return frozenset(stretches(words, size)) if len(words) >= size else frozenset([tuple(words)] if words else [])


class Groups:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
