"""Evaluation texts leaking into training text (problem 8).

Wu-Manber multi-pattern search over words. Patterns are all runs of ``n_words`` consecutive words of
the test texts. A block is two words; the shift table says for a hashed block how many words the
window may jump without passing a pattern (a block of no pattern: ``n_words - 1``). Where the shift is
0, the suffix-hash bucket of the window names the patterns that may stand there, and the words of the
window are compared with those of the pattern: all by their 64-bit names, and the words themselves for
each pair of document and item until one place holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm import arrays

SHIFT_BITS = 22
#: Words that one cursor walks through; long documents get many cursors side by side.
SEGMENT = 512


class Patterns:
    """Shift table, buckets and owners of the test windows of one block of test items."""

    def __init__(self, items: list[tuple[int, str]], n_words: int):
        self.n = n_words
        texts = [text.casefold() for _, text in items]
        names, starts, ends, ranges = arrays.words(texts, arrays.alnum_table())
        self.text, self.starts, self.ends = "".join(texts), starts, ends
        rows, owners, firsts = [], [], []
        for (item, _), a, b in zip(items, ranges[:-1], ranges[1:]):
            if b - a >= n_words:
                windows = np.lib.stride_tricks.sliding_window_view(names[a:b], n_words)
                rows.append(windows)
                owners.append(np.full(len(windows), item, dtype=np.int64))
                firsts.append(np.arange(a, a + len(windows)))
        self.shift = np.full(1 << SHIFT_BITS, n_words - 1, dtype=np.int32)
        self.windows = np.concatenate(rows) if rows else np.zeros((0, n_words), dtype=np.uint64)
        self.owners, self.firsts = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (owners, firsts))
        for end in range(1, n_words):
            at = self.slots(self.windows[:, end - 1], self.windows[:, end])
            np.minimum.at(self.shift, at, n_words - 1 - end)
        suffix = self.suffix(self.windows[:, -3], self.windows[:, -2], self.windows[:, -1]) if len(self.windows) else np.zeros(0, np.uint64)
        order = np.argsort(suffix, kind="stable")
        self.windows, self.owners, self.firsts, self.buckets = self.windows[order], self.owners[order], self.firsts[order], suffix[order]

    @staticmethod
    def slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (arrays.mix(a + arrays.mix(b)) >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    @staticmethod
    def suffix(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return arrays.mix(arrays.mix(arrays.mix(a) + b) + c)

    def search(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of (text number, item) whose text, in folded case, holds a pattern of the item."""
        names, starts, ends, ranges = arrays.words(texts, arrays.alnum_table())
        text, item, last, pattern = self.places(names, ranges)
        whole, pairs = "".join(texts), set()
        for t, i, w, p in zip(text.tolist(), item.tolist(), last.tolist(), pattern.tolist()):
            if (t, i) not in pairs and all(whole[starts[w - k] : ends[w - k]] == self.text[self.starts[p - k] : self.ends[p - k]] for k in range(self.n)):
                pairs.add((t, i))
        found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    def places(self, names: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text number, item, and the last word in the texts and in the patterns, of each place where all names agree."""
        first, last = ranges[:-1], ranges[1:]
        counts = np.maximum(0, -(-(last - first - self.n + 1) // SEGMENT))
        text = np.repeat(np.arange(len(first)), counts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = first[text] + nth * SEGMENT + self.n - 1
        stop = np.minimum(at + SEGMENT, last[text])
        found = []
        while len(at):
            jump = self.shift[self.slots(names[at - 1], names[at])]
            hit = np.flatnonzero(jump == 0)
            if len(hit):
                here = at[hit]
                key = self.suffix(names[here - 2], names[here - 1], names[here])
                low, high = np.searchsorted(self.buckets, key, "left"), np.searchsorted(self.buckets, key, "right")
                many = high - low
                where = np.repeat(np.arange(len(hit)), many)
                pattern = np.arange(len(where)) - np.repeat(np.cumsum(many) - many, many) + low[where]
                window = names[here[where][:, None] + np.arange(1 - self.n, 1)]
                same = (window == self.windows[pattern]).all(axis=1)
                found.append((text[hit[where[same]]], self.owners[pattern[same]], here[where[same]], self.firsts[pattern[same]] + self.n - 1))
                jump[hit] = 1
            at = at + jump
            go = at < stop
            at, stop, text = at[go], stop[go], text[go]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def find_leaks(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_texts: tuple[str, ...] = ("question", "solution"), n_words: int = 12, max_block_chars: int = 8_000_000,
) -> DataFrame:
    """Documents that hold ``n_words`` or more consecutive words of a test text.

    Words are maximal runs of letters and digits, case ignored. Returns distinct ``(item_id, doc_id)``.
    The corpus is read once per block of test items and never shuffled; a block holds at most
    ``max_block_chars`` of test text (the bound of what each task receives), and a test set beyond it
    is searched in several blocks. Null or empty texts and test texts of fewer than ``n_words`` words
    match nothing; a repeated document or item gives one row per pair of ids; an empty table on either
    side gives no rows. Other columns are ignored whatever their names.
    """
    if n_words < 3:
        raise ValueError("n_words must be at least 3")
    tests = items.select(F.col(item_id).alias("i"), F.explode(F.array(*[F.col(c) for c in item_texts])).alias("t"))
    tests = tests.filter(F.col("t").isNotNull() & F.col("i").isNotNull())
    weights = tests.agg(F.sum(F.length("t")).alias("chars")).first()["chars"] or 0
    n_blocks = max(1, -(-weights // max_block_chars))
    docs = documents.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).alias("t")).filter("t is not null and d is not null")
    found = None
    for block in range(n_blocks):
        part = tests if n_blocks == 1 else tests.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == block)
        patterns = Patterns([(r["i"], r["t"]) for r in part.collect()], n_words)
        shared = documents.sparkSession.sparkContext.broadcast(patterns)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table = shared.value
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                texts = batch.column(1).to_pylist()
                for a, b in arrays.blocks(texts):
                    where, item = table.search([t.casefold() for t in texts[a:b]])
                    if len(where):
                        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids[a:b][where])], ["item_id", "doc_id"])

        one = docs.mapInArrow(scan, "item_id bigint, doc_id bigint")
        found = one if found is None else found.unionByName(one)
    return found.distinct()
