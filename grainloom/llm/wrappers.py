"""Union-free wrappers of token streams (problem 7).

A stream is a row of markup tokens and text slots ``T``. Repetitions fold into iterators; streams are
aligned one after the other, and what one of them lacks becomes optional. A wrapper is the list of its
blocks: tokens, whether they repeat, and how many texts have them at this place. It is written as an
expression: ``a`` is fixed, ``(a)?`` optional, ``(a T)+`` repeated, ``(a T)*`` both.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Block = tuple[tuple[str, ...], bool, int]
#: Where ``align`` is asked for it, a longer wrapper is generalised: its rarest blocks become part of the text slots around them.
LONGEST = 256
#: Mark of tokens that are markup only where a wrapper says so.
OPEN = "?"
#: Open tokens that begin a line, and so make a list where they repeat.
ITEMS = frozenset({"?markdown:1."})


def fold(items: list[str], longest: int = 8) -> list[tuple[tuple[str, ...], bool]]:
    """Repetitions become iterators: adjacent equal blocks, and items of a list whatever stands between them."""
    out: list[tuple[tuple[str, ...], bool]] = []
    i = 0
    while i < len(items):
        for size in range(1, min(longest, (len(items) - i) // 2) + 1):
            block, n = items[i : i + size], 1
            while items[i + n * size : i + (n + 1) * size] == block:
                n += 1
            if n > 1:
                out.append((tuple(block), True))
                i += n * size
                break
        else:
            out.append(((items[i],), items[i] in ITEMS and items.count(items[i]) > 1))
            i += 1
    return out


def dump(blocks: list) -> str:
    return json.dumps(blocks, ensure_ascii=False, separators=(",", ":"))


def load(text: str, n: int = 1) -> list[Block]:
    """The blocks of a wrapper, or of a stream that ``n`` texts have."""
    return [(tuple(b[0]), b[1], b[2] if len(b) > 2 else n) for b in json.loads(text)]


def expression(wrapper: list[Block], n_texts: int) -> str:
    out = []
    for tokens, repeated, count in wrapper:
        mark = ("+" if repeated else "") if count >= n_texts else ("*" if repeated else "?")
        out.append(f"({' '.join(tokens)}){mark}" if mark or len(tokens) > 1 else tokens[0])
    return " ".join(out)


def places_of(wrapper: list[Block]) -> dict[tuple[str, ...], list[int]]:
    """The places of each block in the wrapper, in order."""
    out: dict[tuple[str, ...], list[int]] = {}
    for k, block in enumerate(wrapper):
        out.setdefault(block[0], []).append(k)
    return out


def walk(found: dict[tuple[str, ...], list[int]], blocks: list) -> list[int]:
    """The place of each block in a wrapper with these places, in order and as early as possible; -1 where it has none."""
    places, at = [], 0
    for block in blocks:
        own = found.get(block[0], ())
        n = bisect_left(own, at)
        places.append(own[n] if n < len(own) else -1)
        at = places[-1] + 1 if n < len(own) else at
    return places


def aligned(a: list[Block], b: list[Block]) -> list[tuple[int, int]]:
    """Pairs of equal blocks on a longest common subsequence, whatever the lengths.

    The table of lengths has a column for each block of ``b``, an integer with a bit for each place of ``a`` whose block
    ``b`` has, the last place lowest; the bit is 0 where that place makes the subsequence longer. Columns are kept at
    the ends of root of ``b`` stretches and made again for one stretch at a time, so memory grows as the places times
    that root, not as the table.
    """
    asked = {t[0] for t in b}
    places = [i for i in range(len(a) - 1, -1, -1) if a[i][0] in asked]
    bits_of: dict[tuple[str, ...], list[int]] = {}
    for k, i in enumerate(places):
        bits_of.setdefault(a[i][0], []).append(k)
    full, width, step = (1 << len(places)) - 1, len(places) // 8 + 1, math.isqrt(len(b)) + 1

    def mask(name: tuple[str, ...]) -> int:
        bits = bytearray(width)
        for k in bits_of.get(name, ()):
            bits[k >> 3] |= 1 << (k & 7)
        return int.from_bytes(bits, "little")

    # no more than root of the places are so frequent; masks of all would be as large as the table
    frequent = {name: mask(name) for name, own in bits_of.items() if len(own) ** 2 > len(places)}

    def before(column: int, name: tuple[str, ...]) -> int:
        here = column & (frequent[name] if name in frequent else mask(name))
        return (column + here | column ^ here) & full

    ends, column = {}, full
    for j in range(len(b) - 1, -1, -1):
        if j == len(b) - 1 or j % step == step - 1:
            ends[j // step] = column
        column = before(column, b[j][0])
    out, k = [], len(places) - 1
    for stretch in range(len(ends)):
        column, columns = ends.pop(stretch), []
        blocks = range(stretch * step, min((stretch + 1) * step, len(b)))
        for j in reversed(blocks):
            column = before(column, b[j][0])
            columns.append(column.to_bytes(width, "little"))
        for j in blocks:
            bits = columns.pop()
            while k >= 0 and a[places[k]][0] != b[j][0] and bits[k >> 3] >> (k & 7) & 1:
                k -= 1
            if k < 0:
                return out
            if a[places[k]][0] == b[j][0]:
                out.append((places[k], j))
                k -= 1
    return out


def align(a: list[Block], b: list[Block], *, longest: int | None = LONGEST) -> list[Block]:
    """The wrapper of both: equal blocks add their texts, the others stay as optional ones; whole if ``longest`` is None."""
    places = walk(places_of(a), b)
    pairs = [(p, j) for j, p in enumerate(places)] if all(p >= 0 for p in places) else aligned(a, b)
    out: list[Block] = []
    i = j = 0
    for p, q in [*pairs, (len(a), len(b))]:
        out += a[i:p]
        out += b[j:q]
        if p < len(a):
            out.append((a[p][0], a[p][1] or b[q][1], a[p][2] + b[q][2]))
        i, j = p + 1, q + 1
    if longest is not None and len(out) > longest:
        kept = sorted(sorted(range(len(out)), key=lambda k: (-out[k][2], k))[:longest])
        out = [out[k] for k in kept]
    return out


def accepted(wrapper: list[Block], n_texts: int, blocks: list, found: tuple[dict, dict] | None = None) -> tuple[list[str], list[str]]:
    """Kinds of markup in a stream, and its open tokens that are markup.

    An open token is markup where it is an item that repeats, or where half of the texts have it at the
    same place of the wrapper; all others are markup wherever they stand. ``found`` are the places of the
    wrapper's blocks from its start and from its end, if they are known.
    """
    first, last = found or (places_of(wrapper), places_of(wrapper[::-1]))
    ahead = walk(first, blocks)
    back = [len(wrapper) - 1 - p if p >= 0 else -1 for p in walk(last, blocks[::-1])][::-1]
    kinds, names = set(), set()
    for (tokens, *_), *places in zip(blocks, ahead, back):
        fixed = any(p >= 0 and 2 * wrapper[p][2] >= n_texts for p in places)
        listed = any(p >= 0 and wrapper[p][1] for p in places)
        for token in tokens:
            if token == "T":
                continue
            if token[0] == OPEN:
                if not (fixed or listed and token in ITEMS):
                    continue
                names.add(token[1:])
            kinds.add(token.lstrip(OPEN).split(":", 1)[0])
    return sorted(kinds), sorted(names)


def merged(parts: DataFrame) -> DataFrame:
    """One wrapper for each ``host, cluster, salt`` of rows ``blocks, n``: sorted parts are read as they come, one wrapper is held at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, wrapper, total = None, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*here, dump(wrapper), total), (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64()))], ["host", "cluster", "salt", "blocks", "n"])

        for batch in batches:
            for *key, blocks, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key != here:
                    if here is not None:
                        yield row()
                    here, wrapper, total = key, [], 0
                other = load(blocks, n)
                wrapper = align(wrapper, other, longest=None) if total else other[:]
                total += n
        if here is not None:
            yield row()

    keys = ["host", "cluster", "salt"]
    return parts.select(*keys, "blocks", "n").repartition(*keys).sortWithinPartitions(*keys, F.desc("n"), "blocks").mapInArrow(scan, "host string, cluster string, salt int, blocks string, n bigint")


def infer(streams: DataFrame, *, fan_in: int = 64) -> DataFrame:
    """``host, cluster, blocks, n``: the wrapper of each cluster of a host's streams.

    ``streams`` has ``host, cluster, blocks`` for each text. Distinct streams are aligned in ``fan_in`` squared
    parts of a cluster, then ``fan_in`` parts of their wrappers, then these: however large a host is, a task
    holds one wrapper and aligns no more than its part.
    """
    distinct = streams.groupBy("host", "cluster", "blocks").agg(F.count("*").alias("n"))
    first = merged(distinct.withColumn("salt", F.pmod(F.xxhash64("blocks"), F.lit(fan_in * fan_in)).cast("int")))
    second = merged(first.withColumn("salt", (F.col("salt") % fan_in).cast("int")))
    return merged(second.withColumn("salt", F.lit(0))).drop("salt")
