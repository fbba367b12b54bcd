"""Long exact spans shared between records (problem 10), by recompression.

A text becomes a row of symbols: words, other characters, runs of one character. Rounds of pair
compression follow: a symbol whose name says "left" in this round joins the next one if that says
"right", and the pair gets a name computed from both names. A name depends on the content alone, so
equal substrings get equal interior symbols in every record without a dictionary shuffled between
rounds: the 64-bit name is the global dictionary, and every link is verified on the texts.

Each symbol carries the interval of characters that its forming depended on. A symbol whose interval
lies in a window is formed in every record that has the window, so for each window the symbols of the
highest round that it holds are the same everywhere. These are the anchors: two records that share a
span of ``min_chars`` share an anchor at matching places, whatever surrounds the span. Around an anchor
the span reaches at least half its length to one side, so only records that also agree on one of the
two halves beside the anchor meet. No span is lost; what is left is checked on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainloom.llm import arrays
from grainloom.session import checkpoint

#: Longest word taken as one symbol; a longer run of letters goes in by characters, so that one
#: endless word cannot hide a span. Likewise the longest run of one character.
LONGEST = 32
ROUNDS = 40


def base_symbols(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Names, starts and dependence intervals of the first row of symbols, their texts, the texts' offsets and the sums for span names."""
    points, offsets = arrays.codes(texts)
    n = len(points)
    values = arrays.code_values()[points]
    alnum = arrays.alnum_table()[points]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    same = np.zeros(n, dtype=bool)
    same[1:] = np.where(alnum[1:], alnum[:-1], points[1:] == points[:-1]) & ~edge[1:n]
    starts = np.flatnonzero(~same)
    ends = np.append(starts[1:], n)
    long = ends - starts > LONGEST
    low, high = starts - 1, ends + 1
    if long.any():  # a long run: each character is a symbol that knows itself to be in a long run
        inner = np.zeros(n, dtype=bool)
        for a, b in zip(starts[long], ends[long]):
            inner[a:b] = True
        run_start, run_end = np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)
        first = ~same | inner
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        low = np.where(inner[starts], np.maximum(run_start[starts] - 1, starts - LONGEST - 1), starts - 1)
        high = np.where(inner[starts], np.minimum(run_end[starts] + 1, starts + LONGEST + 2), ends + 1)
    sizes = np.searchsorted(starts, offsets)  # symbols of each text; starts are in order
    text = np.repeat(np.arange(len(texts)), np.diff(sizes))
    np.maximum(low, offsets[text], out=low)
    np.minimum(high, offsets[text + 1], out=high)
    sums = arrays.prefix(values)
    small = np.int32 if n < 1 << 30 else np.int64
    return arrays.span_hash(sums, starts, ends), *(x.astype(small) for x in (starts, low, high, text, offsets)), sums


def anchors(texts: list[str], min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, name and place (in the text) of each text's anchors."""
    return anchors_with_sides(texts, min_chars)[:3]


def anchors_with_sides(texts: list[str], min_chars: int) -> tuple[np.ndarray, ...]:
    """The same with the names of the halves of a span before and behind each anchor, and whether the text has them."""
    *symbols, sums = base_symbols(texts)
    text, names, places = _anchors(symbols, min_chars)
    offsets, half = symbols[-1], min_chars // 2
    at = places + offsets[text]
    before, behind = places >= half, at + half <= offsets[text + 1]
    left, right = (arrays.span_hash(sums, np.maximum(at + x, 0), np.minimum(at + x + half, len(sums) - 1)) for x in (-half, 0))
    return text, names, places, left, right, before, behind


def _anchors(symbols: list[np.ndarray], min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names, starts, low, high, text, offsets = symbols
    width = min_chars - LONGEST - 2
    inside = low + width <= offsets[text + 1]
    grid, grid_text = low[inside], text[inside]  # window g: characters grid[g] .. grid[g] + width
    if not len(grid):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    made = [(names, starts, low, high, text)]
    for round_ in range(ROUNDS):
        if len(names) < 2:
            break
        right = names * np.uint64(0x5851F42D4C957F2D * (2 * round_ + 1) & (1 << 64) - 1) >> np.uint64(63) > 0
        beside = text[:-1] == text[1:]
        ahead, back = beside & ~right[:-1], beside & right[1:]
        pair = np.flatnonzero(ahead & back & (high[1:] - low[:-1] <= width))  # may be empty: the intervals widen all the same, or anchors would depend on the block
        # what stays single looked at its neighbour on one side
        new_low, new_high = low.copy(), high.copy()
        np.maximum(high[:-1], high[1:], out=new_high[:-1], where=ahead)
        np.minimum(low[1:], low[:-1], out=new_low[1:], where=back)
        new_low[pair], new_high[pair] = np.minimum(low[pair], low[pair + 1]), np.maximum(high[pair], high[pair + 1])
        joined = arrays.mix(arrays.mix(names[pair]) + names[pair + 1])
        made.append((joined, starts[pair], new_low[pair], new_high[pair], text[pair]))
        names = names.copy()
        names[pair] = joined
        keep = np.ones(len(names), dtype=bool)
        keep[pair + 1] = False
        kept = np.flatnonzero(keep)
        names, starts, low, high, text = (x.take(kept) for x in (names, starts, new_low, new_high, text))
    # from the highest round down: a symbol is an anchor if a window that holds it holds none of a higher round
    out, open_ = [], np.ones(len(grid), dtype=bool)
    for names, starts, low, high, text in reversed(made):
        fits = np.flatnonzero(high - low <= width)
        if not len(fits):
            continue
        first = np.maximum(np.searchsorted(grid, high[fits] - width, "left"), np.searchsorted(grid_text, text[fits], "left"))
        last = np.minimum(np.searchsorted(grid, low[fits], "right"), np.searchsorted(grid_text, text[fits], "right"))
        waiting = np.zeros(len(grid) + 1, dtype=np.int64)
        np.cumsum(open_, out=waiting[1:])
        first = np.minimum(first, last)
        wanted = waiting[last] > waiting[first]
        fits, first, last = fits[wanted], first[wanted], last[wanted]
        out.append((text[fits], names[fits], starts[fits] - offsets[text[fits]]))
        steps = np.zeros(len(grid) + 1, dtype=np.int64)
        np.add.at(steps, first, 1)
        np.add.at(steps, last, -1)
        open_ &= np.cumsum(steps[:-1]) == 0
        if not open_.any():
            break
    return tuple(np.concatenate(x) for x in zip(*out))


def extend(a: str, b: str, at: int, bt: int) -> tuple[int, int]:
    """The greatest equal span around a[at] and b[bt]: start in a, and length; length 0 if they differ."""

    def common(x: str, y: str) -> int:
        low, high = 0, min(len(x), len(y))
        if x[:high] == y[:high]:
            return high
        while low + 1 < high:  # x[:low] is equal, x[:high] is not
            half = (low + high) // 2
            low, high = (half, high) if x[low:half] == y[low:half] else (low, half)
        return low

    ahead = common(a[at:], b[bt:])
    if not ahead:
        return at, 0
    back = common(a[:at][::-1], b[:bt][::-1])
    return at - back, back + ahead


def _content(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).alias("t")).filter("t is not null and d is not null").withColumn("cls", F.unhex(F.md5(F.col("t").cast("binary"))))


def _marks(content: DataFrame, min_chars: int) -> DataFrame:
    """``cls, sym, pos, n``: anchors with one of their halves that two or more different texts have, and in how many marks.

    Two steps: anchors first, as one row each, and of those that met the two halves.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in arrays.blocks(texts):
                where, names, places, left, right, before, behind = anchors_with_sides(texts[a:b], min_chars)
                order = np.argsort(where, kind="stable")
                bounds = pa.array(np.searchsorted(where[order], np.arange(b - a + 1)).astype(np.int32))
                values = [pa.array(names[order].view(np.int64)), pa.array(places[order].astype(np.int32)), *(pa.array((x[order] >> np.uint64(32)).astype(np.uint32).view(np.int32), mask=~there[order]) for x, there in ((left, before), (right, behind)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.ListArray.from_arrays(bounds, v) for v in values)], ["cls", "sym", "pos", "left", "right"])

    # a row for each text: what is written is the anchors and little else; half of a name is enough beside that of the anchor
    lists = checkpoint(content.mapInArrow(name, "cls binary, sym array<bigint>, pos array<int>, left array<int>, right array<int>"))
    found = lists.select("cls", F.inline(F.arrays_zip("sym", "pos", "left", "right")))
    side = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64("sym", c, F.lit(c)))
    near = met(found, "left", "right").select("cls", "pos", F.explode(F.array_compact(F.array(side("left"), side("right")))).alias("sym"))
    # copies of one text bring the same anchors; they fall together here, where few are left
    return met(near.distinct())


def met(marks: DataFrame, *others: str) -> DataFrame:
    """Marks whose name stands in two or more different texts, with the number of marks of the name."""
    cls = F.xxhash64("cls")
    counts = marks.groupBy("sym").agg(F.min(cls).alias("lo"), F.max(cls).alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("sym", "n")
    return marks.join(counts, "sym").select("cls", "sym", "pos", *others, "n")


def _windows(texts: DataFrame, min_chars: int) -> DataFrame:
    """``cls, sym, pos``: the exact names of all windows of ``min_chars`` around the ``places`` of ``cls, t, places``."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, text_, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                sums = arrays.prefix(arrays.code_values()[arrays.codes([text_])[0]])
                around = np.zeros(len(text_) + 2, dtype=np.int64)
                p = np.array(places)
                np.add.at(around, np.maximum(0, p + 1 - min_chars), 1)
                np.add.at(around, np.maximum(0, np.minimum(p, len(text_) - min_chars) + 1), -1)
                starts = np.flatnonzero(np.cumsum(around)[: len(text_) - min_chars + 1] > 0)
                if len(starts):
                    names = arrays.span_hash(sums, starts, starts + min_chars)
                    yield pa.RecordBatch.from_arrays([pa.array([cls] * len(names), pa.binary()), pa.array(names.view(np.int64)), pa.array(starts.astype(np.int32))], ["cls", "sym", "pos"])

    return texts.select("cls", "t", "places").mapInArrow(windows, "cls binary, sym bigint, pos int")


def _texts_of(content: DataFrame, classes: DataFrame) -> DataFrame:
    """Class and text of the classes that met another one; copies fall together before they move."""
    return content.join(classes.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("t").alias("t"))


def shared_spans(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 400, hot: int = 64) -> tuple[DataFrame, DataFrame]:
    """Spans of ``min_chars`` or more code points that stand in more than one text, character for character.

    Returns ``members (cls, doc_id)``, which puts each document in the class of its exact text, and
    ``links (cls_a, cls_b, start_a, start_b, n_chars)``: one row per pair of different texts and
    diagonal with a shared span. Copies are not expanded. A name with more than ``hot`` marks (a boilerplate
    passage) makes no pairs by itself: it is replaced by the exact names of the windows of ``min_chars``
    around it, so only texts that do share a whole window meet.

    Null texts and ids take no part; texts under ``min_chars`` link to nothing; repeated rows are
    members of one class; an empty table gives empty results. Other columns are ignored.
    """
    if min_chars < 4 * LONGEST:
        raise ValueError(f"min_chars must be at least {4 * LONGEST}")
    content = _content(documents, doc_id, text)
    members = content.select("cls", F.col("d").alias("doc_id")).distinct()

    def meet(marks: DataFrame) -> DataFrame:
        a = marks.select("sym", F.col("cls").alias("cls_a"), F.col("pos").alias("pos_a"))
        b = marks.select("sym", F.col("cls").alias("cls_b"), F.col("pos").alias("pos_b"))
        pairs = a.join(b, "sym").filter("cls_a < cls_b")
        return pairs.groupBy("cls_a", "cls_b", (F.col("pos_a") - F.col("pos_b")).alias("diagonal")).agg(F.collect_set("pos_a").alias("places"))

    long_enough = content.filter(F.length("t") >= min_chars).select("cls", "t")
    marks = checkpoint(_marks(long_enough, min_chars))
    crowded = marks.filter(F.col("n") > hot).groupBy("cls").agg(F.collect_set("pos").alias("places"))
    texts = _texts_of(long_enough, marks)
    exact = met(_windows(texts.join(crowded, "cls"), min_chars)).select("sym", "cls", "pos")
    pairs = meet(marks.filter(F.col("n") <= hot).select("sym", "cls", "pos")).unionByName(meet(exact))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                done = -1
                for place in sorted(r["places"]):
                    if place < done:
                        continue
                    start, size = extend(r["text_a"], r["text_b"], place, place - r["diagonal"])
                    done = start + size
                    if size >= min_chars:
                        rows.append((r["cls_a"], r["cls_b"], start, start - r["diagonal"], size))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32()))], ["cls_a", "cls_b", "start_a", "start_b", "n_chars"])

    both = pairs.join(texts.select(F.col("cls").alias("cls_a"), F.col("t").alias("text_a")), "cls_a").join(texts.select(F.col("cls").alias("cls_b"), F.col("t").alias("text_b")), "cls_b")
    links = both.select("cls_a", "cls_b", "diagonal", "places", "text_a", "text_b").mapInArrow(verify, "cls_a binary, cls_b binary, start_a int, start_b int, n_chars int")
    return members, links.distinct()


def sharing_pairs(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 400) -> DataFrame:
    """Pairs ``doc_a < doc_b`` whose texts share a span of ``min_chars`` code points; copies are expanded here."""
    members, links = shared_spans(documents, doc_id=doc_id, text=text, min_chars=min_chars)
    a, b = (members.select(F.col("cls").alias(f"cls_{x}"), F.col("doc_id").alias(x)) for x in "ab")
    across = links.select("cls_a", "cls_b").distinct().join(a, "cls_a").join(b, "cls_b").select("a", "b")
    long_enough = _content(documents, doc_id, text).filter(F.length("t") >= min_chars)
    several = long_enough.groupBy("cls").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo < hi").select(F.col("cls").alias("cls_a"))
    copies = several.join(a, "cls_a").join(b, F.col("cls_a") == F.col("cls_b")).filter("a < b").select("a", "b")
    return across.unionByName(copies).select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).filter("doc_a < doc_b").distinct()


def shared_portions(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 400) -> DataFrame:
    """For each document the class of its exact text, its copies, and how much of it stands elsewhere too.

    ``n_shared`` counts the code points in windows of ``min_chars`` that another text has (by their 64-bit
    names); a document with copies of at least ``min_chars`` is shared wholly. No pairs are made: a passage of
    a million texts is a million windows. Null texts have no row; an empty text has share 0.
    """
    content = _content(documents, doc_id, text)
    members = content.select("cls", F.col("d").alias("doc_id")).distinct()
    long_enough = content.filter(F.length("t") >= min_chars).select("cls", "t")
    places = checkpoint(_marks(long_enough, min_chars)).groupBy("cls").agg(F.collect_set("pos").alias("places"))
    windows = met(_windows(_texts_of(long_enough, places).join(places, "cls"), min_chars))
    ahead = F.lead("pos").over(Window.partitionBy("cls").orderBy("pos")) - F.col("pos")
    covered = windows.select("cls", F.least(F.coalesce(ahead, F.lit(min_chars)), F.lit(min_chars)).alias("n")).groupBy("cls").agg(F.sum("n").alias("covered"))
    sizes = content.groupBy("cls").agg(F.min("d").alias("class_id"), F.count_distinct("d").alias("n_copies"), F.max(F.length("t")).cast("bigint").alias("n_chars"))
    per_class = sizes.join(covered, "cls", "left")
    shared = F.when((F.col("n_copies") > 1) & (F.col("n_chars") >= min_chars), F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)))
    return members.join(per_class, "cls").select("doc_id", "class_id", "n_copies", "n_chars", shared.cast("bigint").alias("n_shared"), F.round(shared / F.greatest("n_chars", F.lit(1)), 6).alias("share"))
