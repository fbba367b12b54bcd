"""Repetition inside a single document (problem 5).

A text is coded as its words, four bytes a word, and compressed by zstandard: with words as letters the
ratio says how much of the text is repeated, not how compressible its language is. Ratios of the whole
text and of chunks of fixed length are held against limits that depend on the length. The compressor is
set so that the limit is a bound and not a guess: its window and tables hold the whole text, its binary
tree is searched to the end, and its strategy looks at every position, so each run that stood earlier is
found. A text under the limit cannot have the share and is rejected; what reaches it is measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm import arrays

WORD_BYTES = 4
#: Bytes that zstandard spends at most on a frame with its first block, on each further block (its header
#: and tables), and on one match (offset, two lengths and their codes).
FRAME, BLOCK, MATCH = 24, 160, 8
BLOCK_BYTES = 1 << 17
#: A block is written as it is if compression would save less than this share of it.
LEAST_GAIN = 1 / 64
#: Longer texts (in words) are not compressed but measured: the tables of the compressor grow with the text.
LONGEST = 1 << 22


def least_ratio(n_words: float, share: float, run: int) -> float:
    """The least ratio of a text of n_words with this repeated share.

    Other words cost WORD_BYTES at most. The repeated ones are covered by matches: of the windows of ``run``
    words that stood earlier, a cover without needless ones has at most two for each ``run + 1`` words and
    one more for a run, so no more than one match for each ``run / 2`` words.
    """
    size = WORD_BYTES * n_words
    written = size * (1 - share) + MATCH * share * n_words / (run / 2) + LEAST_GAIN * size + FRAME + BLOCK * (size // BLOCK_BYTES)
    return size / written


@lru_cache(maxsize=64)
def compressor(log: int) -> zstandard.ZstdCompressor:
    """For texts of up to 2**log bytes: every position is looked at and every earlier one is within reach."""
    log = max(10, log)
    settings = zstandard.ZstdCompressionParameters(
        window_log=log, chain_log=log + 1, hash_log=min(log, 20), search_log=log, min_match=6, target_length=256, strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    return zstandard.ZstdCompressor(compression_params=settings)


def ratio_of(coded: bytes) -> float:
    return len(coded) / len(compressor((len(coded) - 1).bit_length()).compress(coded))


def repeated_words(names: np.ndarray, ranges: np.ndarray, run: int) -> np.ndarray:
    """Per text, the words that lie in runs of ``run`` or more words that stood earlier in the text."""
    n = len(names)
    counts = np.zeros(len(ranges) - 1, dtype=np.int64)
    if n < run:
        return counts
    sums = arrays.prefix(names)
    starts = np.arange(n - run + 1)
    text = np.searchsorted(ranges, starts, side="right") - 1
    whole = starts + run <= ranges[text + 1]
    starts, text = starts[whole], text[whole]
    keys = arrays.mix(arrays.span_hash(sums, starts, starts + run) + text.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    again = order[1:][keys[order[1:]] == keys[order[:-1]]]
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts[again], 1)
    np.add.at(steps, starts[again] + run, -1)
    covered = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.cumsum(steps[:-1]) > 0, out=covered[1:])
    return covered[ranges[1:]] - covered[ranges[:-1]]


def measure_repetition(texts: DataFrame, *, keys: tuple[str, ...], text: str = "text", run: int = 6, share: float = 0.35, chunk_words: int = 512, longest: int = LONGEST, banded_only: bool = False) -> DataFrame:
    """Compression bands and the exact repeated share of each text.

    Returns the key columns with ``n_words, n_repeated, repeated_share, ratio, chunk_ratio, band``.
    ``band`` is ``repetitive`` (the whole text or a chunk reaches the limit of its length; every text with
    a repeated share of ``share`` or more does), ``unsure`` (over ``longest`` words, not compressed, its ratios
    are null), ``incompressible`` (the ratio stays under 1 in a text of 64 words or more) or ``normal``.
    With ``banded_only`` the exact share is measured in the first two bands only and is null elsewhere,
    where it is below ``share`` for certain. Words are separated by white space, case ignored; a word is
    repeated if it lies in a run of ``run`` or more words that already stood earlier in the same text. No
    shuffle. Null and blank texts have no words, share 0 and band ``normal``; each input row gives one row.
    """
    fields = [f for f in texts.schema.fields if f.name in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted(fields, key=lambda f: keys.index(f.name)))
    width = len(keys)

    def banded(coded: bytes, n: int) -> tuple[str, float | None, float | None]:
        if not n:
            return "normal", 1.0, 1.0
        if n > longest:
            return "unsure", None, None
        ratio = chunk = ratio_of(coded)
        repetitive = ratio >= least_ratio(n, share, run)
        if n > chunk_words:
            step = chunk_words * WORD_BYTES
            each = [(ratio_of(p), len(p) // WORD_BYTES) for p in (coded[x : x + step] for x in range(0, len(coded), step))]
            chunk = max(r for r, _ in each)
            repetitive |= any(r >= least_ratio(m, share, run) for r, m in each if m == chunk_words)
        return "repetitive" if repetitive else "incompressible" if n >= 64 and ratio < 1 else "normal", ratio, chunk

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = [t or "" for t in batch.column(width).to_pylist()]
            for a, b in arrays.blocks(all_texts):
                names, _, _, ranges = arrays.words([t.lower() for t in all_texts[a:b]], arrays.space_complement())
                n = np.diff(ranges)
                coded = names.astype(np.uint32).tobytes()
                band, ratio, chunk = zip(*(banded(coded[x * WORD_BYTES : y * WORD_BYTES], y - x) for x, y in zip(ranges[:-1].tolist(), ranges[1:].tolist())))
                measured = np.isin(band, ("repetitive", "unsure")) | ~np.bool_(banded_only) | (n == 0)
                repeated = np.zeros(b - a, dtype=np.int64)
                inside = np.zeros(b - a + 1, dtype=np.int64)
                np.cumsum(n * measured, out=inside[1:])
                counts = repeated_words(names[np.repeat(measured, n)], inside, run)
                repeated[measured] = counts[measured]
                columns = [batch.column(i).slice(a, b - a) for i in range(width)]
                columns += [pa.array(n), pa.array(repeated, mask=~measured), pa.array(repeated / np.maximum(n, 1), mask=~measured), pa.array(ratio, pa.float64()), pa.array(chunk, pa.float64()), pa.array(band, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*keys, "n_words", "n_repeated", "repeated_share", "ratio", "chunk_ratio", "band"])

    return texts.select(*keys, text).mapInArrow(scan, schema + ", n_words bigint, n_repeated bigint, repeated_share double, ratio double, chunk_ratio double, band string")
