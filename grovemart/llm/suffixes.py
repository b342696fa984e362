"""Suffix-array dedup by prefix-free parsing.

Triggers of a rolling hash cut the corpus into phrases: in `overlap`, the seeds, of which
every stretch of the wanted length holds at least one. The texts around triggers
of equal content come to one shard. There two orders are made: of the phrases that end at a trigger
(read backwards, the dictionary) and of what follows from the trigger on (the suffixes of the
parse). A stretch is a phrase's last t bytes and the first bytes of a parse suffix, so its
place in the order of all stretches is the pair of its places in the two; equal neighbours by
common-prefix lengths are equal stretches. No stretch is ever sorted for itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from grovemart.llm import overlap

BYTES = overlap.Unit("bytes", length=50, seed=20)


def padded(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of `width` bytes: `size` bytes from `start` on, forward or backward, then zeros."""
    size = np.minimum(size, width)
    at = start[:, None] + step * np.arange(width)
    inside = np.arange(width) < size[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)


def order_and_prefixes(key: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order within each key, and common-prefix lengths with the row before (-1: another key)."""
    width = texts.shape[1]
    flat = np.ascontiguousarray(texts).view(f"S{width}").ravel()
    order = np.lexsort((flat, key))
    rows, keys = texts[order], key[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[keys[1:] != keys[:-1]] = -1
    return order, np.concatenate(([-1], common))


def repeated(rows: pa.Table, unit: overlap.Unit) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of `rows` (sorted by key and doc_id) that a smaller doc_id of the same key holds."""
    n, none = rows.num_rows, np.zeros(0, np.int64)
    if not n:
        return none, none
    key, ids, place = (rows[c].to_numpy() for c in ("key", "doc_id", "place"))
    bodies = rows["body"].to_pylist()
    sizes = np.array([len(b) for b in bodies], np.int64)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    trigger = np.concatenate(([0], np.cumsum(sizes)[:-1])) + place
    follow = padded(data, trigger, sizes - place, unit.length, 1)
    phrase = padded(data, trigger - 1, place, unit.length - unit.seed, -1)
    parse_order, parse_common = order_and_prefixes(key, follow)
    dictionary_order, dictionary_common = order_and_prefixes(key, phrase)
    parse_place, dictionary_place = np.empty(n, np.int64), np.empty(n, np.int64)
    found_row, found_stretch = [none], [none]
    stretches = sizes - unit.length + 1
    by_id = np.argsort(ids, kind="stable")
    for left in range(unit.length - unit.seed + 1):
        stretch = place - left
        has = by_id[((stretch >= 0) & (stretch < stretches))[by_id]]
        if len(has) < 2:
            continue
        parse_place[parse_order] = np.cumsum(parse_common < unit.length - left)
        dictionary_place[dictionary_order] = np.cumsum(dictionary_common < left)
        corpus_place = parse_place[has] * (n + 1) + dictionary_place[has]
        order = np.argsort(corpus_place, kind="stable")
        new = np.concatenate(([True], np.diff(corpus_place[order]) != 0))
        least = ids[has[order]][np.flatnonzero(new)][np.cumsum(new) - 1]
        later = has[order][ids[has[order]] > least]
        found_row.append(later)
        found_stretch.append(stretch[later])
    return np.concatenate(found_row), np.concatenate(found_stretch)


def dedup(docs: DataFrame, unit: overlap.Unit = BYTES) -> DataFrame:
    """`docs` with `kept`, `n_units`, `n_removed`, `n_spans`; see `overlap.cut`."""
    return overlap.cut(docs, unit, repeated)
