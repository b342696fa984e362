"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

A word is compared by its subsequences of four symbols within six neighbours, gaps
weighing less: an insult with a character put in between, or with dots or blanks between its
letters, still shares most of them with the insult. The kernel of two words is
the normalised product of their subsequence weights.

Training: sentences of labelled documents carry the document's label, but only some words of a
toxic document are toxic. The most telling word of each toxic sentence's document
stands for it (multiple instances); landmarks are taken from those words and from clean ones;
an SVM is fitted on Nyström features, clean words that it takes for toxic are added, and the
words are chosen anew. The score of a document is the probability that a logistic curve,
fitted by Platt's method, gives its `TOP` most toxic words for its length.

Scoring: with a fixed set of landmarks the machine is one weight per subsequence (32**4), so
whole texts are scored by table lookups where they lie; nothing is shuffled.

Bounds: at most `TOXIC_DOCS` and `CLEAN_DOCS` labelled documents, and `TOXIC_SENTENCES` and `CLEAN_SENTENCES` of their
sentences, train the model; longer ones than `SENTENCE_CHARS` count as several. Each document gives one, then each a second
one, and so on, in an order by hash, so that long texts push no others out. All documents are scored, whole.

Defined cases: null and empty texts have no word and get the score of that; documents with several
labels count with each; without both labels nothing is rejected; repeated rows are scored each; an empty table gives an empty one; no other
columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

TOXIC_DOCS, CLEAN_DOCS, TOXIC_SENTENCES, CLEAN_SENTENCES, SENTENCE_CHARS = 500, 2500, 13_000, 27_000, 1000
LANDMARKS, ROUNDS, CLEAN_WORDS, SURE_WORDS, COST, CHANCE, SURE = 192, 4, 5_000, 4_000, 1000.0, 1e-4, 2.0
DECAY, SYMBOLS, EDGE, LENGTH, SPAN, TOP = 0.9, 32, 31, 4, 6, 3
#: Text bytes scored at a time.
SLICE = 1 << 20

#: Places of a subsequence's second to fourth symbol after its first, and the weight.
SHAPES = [
    ((a, b, c), DECAY ** (c - LENGTH + 1))
    for a in range(1, SPAN)
    for b in range(a + 1, SPAN)
    for c in range(b + 1, SPAN)
]


def _symbols() -> np.ndarray:
    """Symbol of a byte: letters without case, look-alike digits, four kinds of other letters; 0: skipped."""
    table = np.zeros(256, np.int32)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    for sign, letter in zip("0134578@$!", "oieastbasi", strict=True):
        table[ord(sign)] = ord(letter) - ord("a") + 1
    for byte in range(0x80, 0xC0):
        table[byte] = 27 + byte % 4
    table[[32, 9, 10, 11, 12, 13]] = EDGE
    return table


SYMBOL = _symbols()


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words with an edge before, between and after; number of words of each text.

    Letters standing alone, one after another, are one word.
    """
    data = b"".join(b" " + text + b" " for text in texts)
    raw = np.frombuffer(data, np.uint8)
    symbols = SYMBOL[raw]
    # A mark of exclamation stands for a letter inside a word only.
    bang = raw == ord("!")
    if bang.any():
        after = np.minimum.accumulate(np.where(bang, len(raw), np.arange(len(raw)))[::-1])[::-1]
        symbols[bang & np.isin(symbols[np.minimum(after, len(raw) - 1)], (0, EDGE))] = 0
    owner = np.repeat(np.arange(len(texts)), [len(text) + 2 for text in texts])
    symbols, owner = symbols[symbols > 0], owner[symbols > 0]
    edge = symbols == EDGE
    keep = np.ones(len(symbols), bool)
    keep[1:] = ~(edge[1:] & edge[:-1] & (owner[1:] == owner[:-1]))
    symbols, owner, edge = symbols[keep], owner[keep], edge[keep]
    # An edge between two letters that stand alone: edge, letter, edge, letter, edge.
    inner = np.zeros(len(symbols), bool)
    if len(symbols) >= 5:
        inner[2:-2] = edge[2:-2] & edge[:-4] & edge[4:] & ~edge[1:-3] & ~edge[3:-1] & (owner[:-4] == owner[4:])
    symbols, owner = symbols[~inner], owner[~inner]
    return symbols, owner


class Words:
    """Words of some texts in symbols, ready for lookups."""

    def __init__(self, texts: list[bytes]) -> None:
        self.symbols, owner = encode(texts)
        edges = np.flatnonzero(self.symbols == EDGE)
        # A word goes from an edge to the next; two edges in a row part two texts.
        word = np.diff(edges) > 1
        self.start, self.end = edges[:-1][word], edges[1:][word] + 1
        self.owner = owner[self.start]
        sizes = self.end - self.start
        weight = sum(w * w * np.maximum(sizes - shape[-1], 0) for shape, w in SHAPES)
        self.norm = np.sqrt(np.maximum(weight, 1e-9))
        # Symbols from a place to the next edge: a subsequence must not reach over it.
        first = np.append(edges, len(self.symbols))
        self.room = np.repeat(first[1:], np.diff(first)).astype(np.int32) - np.arange(first[0], len(self.symbols), dtype=np.int32)

    def subsequences(self, shapes: int = len(SHAPES)) -> Iterator[tuple[np.ndarray, float, int]]:
        """Subsequence numbers by place of the first symbol, their weight and reach, shape by shape."""
        s = self.symbols
        for (a, b, c), weight in SHAPES[:shapes]:
            n = len(s) - c
            if n > 0:
                yield ((s[:n] * SYMBOLS + s[a : a + n]) * SYMBOLS + s[b : b + n]) * SYMBOLS + s[c : c + n], weight, c

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Kernel sum of every word for one weight per subsequence."""
        total = np.zeros(len(self.symbols) + 1, np.float64)
        for numbers, weight, reach in self.subsequences():
            total[1 : len(numbers) + 1] += weight * table[numbers] * (self.room[: len(numbers)] >= reach)
        np.cumsum(total, out=total)
        # What begins at the closing edge belongs to the next word.
        return (total[self.end - 1] - total[self.start]) / self.norm

    def features(self, rows: np.ndarray, shapes: int = len(SHAPES)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse kernel features of some words: (word, subsequence, weight), normalised."""
        word_of = np.full(len(self.symbols), -1, np.int32)
        sizes = self.end[rows] - 1 - self.start[rows]
        at = np.repeat(self.start[rows] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        word_of[at] = np.repeat(np.arange(len(rows)), sizes)
        last = np.zeros(len(self.symbols), np.int32)
        last[at] = np.repeat(self.end[rows], sizes)
        words, numbers, weights = [], [], []
        for found, weight, reach in self.subsequences(shapes):
            n = len(found)
            inside = np.flatnonzero((word_of[:n] >= 0) & (np.arange(n) + reach < last[:n]))
            words.append(word_of[inside])
            numbers.append(found[inside])
            weights.append(np.full(len(inside), weight))
        word = np.concatenate(words) if words else np.zeros(0, np.int64)
        weight = np.concatenate(weights) if weights else np.zeros(0)
        norm = self.norm[rows]
        return word, np.concatenate(numbers) if numbers else word, weight / norm[word]


def kernel(words: Words, rows: np.ndarray, landmarks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Kernel values of some words with landmarks given as weights of few subsequences."""
    word, number, weight = words.features(rows)
    index, table = landmarks
    column = index[number]
    known = np.flatnonzero(column >= 0)
    known = known[np.argsort(word[known], kind="stable")]
    out = np.zeros((len(rows), table.shape[1]), np.float32)
    for first in range(0, len(known), 1 << 13):
        part = known[first : first + (1 << 13)]
        heads = np.flatnonzero(np.concatenate(([True], word[part][1:] != word[part][:-1])))
        out[word[part][heads]] += np.add.reduceat(weight[part, None] * table[column[part]], heads, axis=0)
    return out


def landmark_table(words: Words, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences of the landmark words: a number for each, and its weight in each landmark."""
    word, number, weight = words.features(rows)
    present, at = np.unique(number, return_inverse=True)
    index = np.full(SYMBOLS**LENGTH, -1)
    index[present] = np.arange(len(present))
    table = np.zeros((len(present), len(rows)))
    np.add.at(table, (at, word), weight)
    return index, table


def support_vector_machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights (the last one the bias) with the least squared hinge loss, y being sign times margin: Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        wrong = np.sign(y) * (x @ w) < np.abs(y)
        a = (x[wrong] * cost[wrong, None]).astype(np.float32)
        new = np.linalg.solve(ridge + (a.T @ x[wrong]).astype(float), a.T @ y[wrong])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def logistic(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve (the last one the bias), with Platt's softened targets: Newton's method."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - target * z) + 0.05 * w @ w)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (p - target) + 0.1 * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def strongest(score: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Of every text: its TOP highest word scores (-1, a sure clean word, where words lack) and the log of its words."""
    out = np.full((texts, TOP + 1), -1.0)
    out[:, TOP] = np.log1p(np.bincount(owner, minlength=texts))
    some = np.flatnonzero(score > -1)
    order = some[np.lexsort((-score[some], owner[some]))]
    texts_of = owner[order]
    heads = np.flatnonzero(np.concatenate(([True], texts_of[1:] != texts_of[:-1]))) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    top = rank < TOP
    out[texts_of[top], rank[top]] = np.minimum(score[order[top]], SURE)
    return out


class Model:
    """One weight per subsequence, a bias, and the logistic curve over a text's strongest words."""

    def __init__(self, table: np.ndarray, bias: float, curve: np.ndarray) -> None:
        self.table, self.bias, self.curve = table, bias, curve

    def probability(self, texts: list[bytes]) -> np.ndarray:
        words = Words(texts)
        x = strongest(words.scores(self.table) + self.bias, words.owner, len(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -35, 35)))


UNTRAINED = (np.zeros(SYMBOLS**LENGTH, np.float32), -1.0, np.array([0.0] * (TOP + 1) + [-1.0]))


def fit(sentences: list[tuple[int, bytes, bool]], seed: int = 0) -> Model:
    """A model from (document, sentence, label) rows."""
    docs = np.unique(np.array([d for d, _, _ in sentences], np.int64), return_inverse=True)[1]
    label = np.array([t for _, _, t in sentences], bool)
    if label.all() or not label.any():
        return Model(*UNTRAINED)
    rng = np.random.default_rng(seed)
    words = Words([s for _, s, _ in sentences])
    doc, toxic = docs[words.owner], label[words.owner]
    clean = np.flatnonzero(~toxic)
    kind = _kind_numbers(words)
    # A word that clean documents use, too, cannot be what makes a document toxic.
    suspect = np.flatnonzero(toxic & ~np.isin(kind, kind[clean]))
    if not len(suspect) or not len(clean):
        return Model(*UNTRAINED)
    sure = _only_toxic(kind, doc, suspect, len(np.unique(doc[toxic])) / len(np.unique(doc)))
    score = words.scores(_telling(words, doc, toxic))
    taught = rng.permutation(sure)[:SURE_WORDS]
    hard = np.zeros(0, np.int64)
    machine = None
    for _ in range(ROUNDS):
        others = np.setdiff1d(_witnesses(score, doc, suspect, machine is not None), sure)
        chosen = np.sort(np.concatenate([taught, rng.permutation(others)[:SURE_WORDS]]))
        spread = rng.choice(clean, min(len(clean), CLEAN_WORDS), replace=False)
        marks = np.concatenate([_frequent(kind, chosen, LANDMARKS * 3 // 4), spread[: LANDMARKS // 4]])
        table = landmark_table(words, marks)
        values, vectors = np.linalg.eigh(kernel(words, marks, table))
        solid = values > 1e-6 * values.max()
        root = vectors[:, solid] / np.sqrt(values[solid])
        worst = clean[np.argsort(-score[clean])[: CLEAN_WORDS // 2]]
        hard = np.unique(np.concatenate([hard, worst]))
        # The insults that are sure, with a character put in: they count as insults, too.
        altered = Words(_altered(words, _frequent(kind, chosen, 100, least=2), rng))
        known = np.concatenate([chosen, spread, hard])
        root = root.astype(np.float32)
        x = np.vstack([kernel(words, known, table) @ root, kernel(altered, np.arange(len(altered.start)), table) @ root])
        # Words that only toxic documents have are asked to stand out further.
        margin = np.where(np.isin(chosen, sure), SURE, 1.0)
        y = np.concatenate([margin, -np.ones(len(known) - len(chosen)), np.ones(len(altered.start))])
        sizes = np.array([len(chosen), len(known) - len(chosen), len(altered.start)])
        w = support_vector_machine(x, y, np.repeat(COST / np.maximum(sizes, 1), sizes))
        machine = np.zeros(SYMBOLS**LENGTH, np.float32)
        machine[table[0] >= 0] = table[1] @ (root @ w[:-1])
        score = words.scores(machine) + w[-1]
    n_docs = docs.max() + 1
    doc_toxic = np.zeros(n_docs, bool)
    np.logical_or.at(doc_toxic, docs, label)
    # Documents, and single sentences with a sure word beside as many clean ones.
    telling = np.unique(words.owner[sure])
    plain = np.unique(words.owner[clean])
    pick = np.concatenate([rng.permutation(telling)[:n_docs], rng.permutation(plain)[: min(len(telling), n_docs)]])
    x = np.vstack([strongest(score, doc, n_docs), strongest(score, words.owner, len(sentences))[pick]])
    return Model(machine, float(w[-1]), logistic(x, np.concatenate([doc_toxic, np.isin(pick, telling)])))


def _kind_numbers(words: Words) -> np.ndarray:
    """Equal words have equal numbers."""
    numbers: dict[bytes, int] = {}
    data, width = words.symbols.tobytes(), words.symbols.itemsize
    spans = zip((words.start * width).tolist(), (words.end * width).tolist(), strict=True)
    return np.array([numbers.setdefault(data[a:b], len(numbers)) for a, b in spans], np.int64)


def _telling(words: Words, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Unbroken subsequences that toxic documents hold more often than clean ones: standardised differences."""
    total = SYMBOLS**LENGTH
    n = [max(1, len(np.unique(doc[toxic == flag]))) for flag in (False, True)]
    # The first shape is the one without gaps.
    word, number, _ = words.features(np.arange(len(words.start)), 1)
    count = []
    for flag in (False, True):
        mine = toxic[word] == flag
        count.append(np.bincount(np.unique(doc[word[mine]] * total + number[mine]) % total, minlength=total))
    rate = (count[1] + count[0] + 0.5) / (n[0] + n[1] + 1)
    z = (count[1] / n[1] - count[0] / n[0]) / np.sqrt(rate * (1 - np.minimum(rate, 0.99)) * (1 / n[0] + 1 / n[1]))
    return np.where(z > 3, z, np.minimum(z, 0)).astype(np.float32)


def _only_toxic(kind: np.ndarray, doc: np.ndarray, suspect: np.ndarray, share: float) -> np.ndarray:
    """Words in so many documents, all toxic, that chance does not explain it (toxic ones being `share` of all)."""
    pairs = np.unique(np.column_stack([kind[suspect], doc[suspect]]), axis=0)
    kinds, counts = np.unique(pairs[:, 0], return_counts=True)
    return suspect[np.isin(kind[suspect], kinds[share**counts < CHANCE])]


def _witnesses(score: np.ndarray, doc: np.ndarray, suspect: np.ndarray, fitted: bool) -> np.ndarray:
    """The most telling word of every toxic document, and all that the machine is sure of."""
    order = suspect[np.lexsort((-score[suspect], doc[suspect]))]
    first = order[np.concatenate(([True], doc[order][1:] != doc[order][:-1]))]
    return np.union1d(first, suspect[score[suspect] > 0.5]) if fitted else first


def _frequent(kind: np.ndarray, rows: np.ndarray, most: int, least: int = 1) -> np.ndarray:
    """A row of each different word among `rows`, the frequent ones first."""
    _, first, counts = np.unique(kind[rows], return_index=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    return rows[first[order][counts[order] >= least][:most]]


def _altered(words: Words, rows: np.ndarray, rng: np.random.Generator) -> list[bytes]:
    """The plain-letter words among `rows` with a letter put in at each inner place."""
    out = []
    for row in rows.tolist():
        letters = words.symbols[words.start[row] + 1 : words.end[row] - 1]
        if len(letters) >= 5 and letters.max() <= 26:
            text = bytes((letters + 96).astype(np.uint8))
            out += [text[:i] + bytes([int(rng.integers(97, 123))]) + text[i:] for i in range(1, len(text))]
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sentences(docs: DataFrame, labels: DataFrame) -> list[tuple[int, bytes, bool]]:
    """The bounded training sample: sentences of labelled documents that are not held out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    drawn = usable.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"), F.xxhash64("doc_id").alias("_order"))
    sample = [
        drawn.where(F.col("_toxic") == flag).orderBy("_order", "_id").limit(most)
        for flag, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))
    ]
    # At most TOXIC_DOCS + CLEAN_DOCS rows of three numbers.
    chosen = F.broadcast(sample[0].union(sample[1]))
    split = F.split(F.coalesce("text", F.lit("")), r"[.!?\n]+")
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
    sentences = rows.select("_order", "_id", "_toxic", F.explode(split).alias("_whole")).where(F.length("_whole") > 1)
    starts = F.sequence(F.lit(0), F.floor((F.length("_whole") - 1) / SENTENCE_CHARS).cast("int"))
    cut = F.transform(starts, lambda i: F.substring(F.col("_whole"), i * SENTENCE_CHARS + 1, F.lit(SENTENCE_CHARS)))
    pieces = sentences.select("_order", "_id", "_toxic", F.explode(cut).alias("_sentence")).where(F.length("_sentence") > 1)
    turn = F.row_number().over(Window.partitionBy("_id", "_toxic").orderBy(F.xxhash64("_sentence"), "_sentence"))
    turns = pieces.withColumn("_turn", turn)
    some = [
        turns.where(F.col("_toxic") == flag).orderBy("_turn", F.xxhash64("_order"), "_id").limit(most)
        for flag, most in ((1, TOXIC_SENTENCES), (0, CLEAN_SENTENCES))
    ]
    found = some[0].union(some[1]).collect()
    found.sort(key=lambda r: (r["_order"], r["_id"], r["_toxic"], r["_turn"]))
    return [(r["_id"], r["_sentence"].encode(), r["_toxic"] == 1) for r in found]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(labelled_sentences(docs, labels))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` (text, ...) with `score` and `predicted`."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType([*rows.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    # 4 MB whatever the data; its class travels with it.
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column("text").to_pylist()]
            found, first, size = [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= SLICE or i + 1 == len(texts):
                    found.append(model.probability(texts[first : i + 1]))
                    first, size = i + 1, 0
            p = np.concatenate(found) if found else np.zeros(0)
            out = [*batch.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(rate, schema)
