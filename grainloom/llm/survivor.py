"""Best representative of each duplicate group, field by field (problem 6)."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainloom.functions.text import strip

#: What is written in place of a missing value, in lower case.
PLACEHOLDERS = (
    "-", "--", "---", "–", "—", "?", "??", "???", ".", "..", "...", "…", "_", "*", "#", "x", "xx", "xxx", "null", "(null)", "none", "nil", "nan", "n/a", "na", "n.a.", "#n/a", "tba", "tbd", "tbc", "todo", "to do",
    "unknown", "undefined", "missing", "empty", "(empty)", "blank", "void", "not available", "not applicable", "not known", "no value", "placeholder", "pending", "[object object]",
)


def surviving(value: Column) -> Column:
    """The value without outer white space, null if it is blank or a placeholder."""
    bare = strip(value)
    return F.when((bare != "") & ~F.lower(bare).isin(*PLACEHOLDERS), bare)


def value_class(value: Column) -> Column:
    """What kind of value it is, for the order in which kinds follow each other: the host of an address, else its shape."""
    host = F.regexp_extract(value, r"^[a-z]+://([^/?#]+)", 1)
    return F.when(host != "", host).otherwise(F.regexp_replace(F.lower(value), r"\p{Nd}+", "9"))


def transitions(values: DataFrame, *, salts: int = 32, hot: int = 10_000) -> DataFrame:
    """What follows what: ``before, after``, one row for each two kinds of which one follows the other more often.

    ``values`` has ``key, row_id, kind, at``. In each group, rows with a time are put in order and each
    step from one kind to another is a transition. Groups of ``hot`` rows or more are ordered in about ``salts``
    ranges of time, and the step from each range to the next is added, so the steps are those of the whole group.
    """
    dated = values.filter("at is not null").select("key", "kind", F.struct("at", "row_id", "kind").alias("row"))
    sizes = dated.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= hot)
    # the bounds of a hot group's parts: about 16 rows a part, taken by hash, every 16th of them in order
    drawn = dated.join(sizes, "key").filter(F.pmod(F.xxhash64("row.row_id"), F.greatest(F.lit(1), F.floor(F.col("n") / (16 * salts)))) == 0)
    bounds = drawn.groupBy("key").agg(F.sort_array(F.collect_set("row")).alias("drawn"))
    cuts = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.element_at("drawn", F.floor(i * F.size("drawn") / salts).cast("int") + 1))
    bounds = sizes.join(bounds, "key", "left").select("key", F.coalesce(cuts, F.array()).alias("cuts"))
    parted = dated.join(bounds, "key", "left").select("key", "kind", "row", F.when(F.col("cuts").isNotNull(), F.size(F.filter("cuts", lambda c: c <= F.col("row")))).alias("part"))
    row = Window.partitionBy("key", "part").orderBy("row")
    within = parted.select("kind", F.lead("kind").over(row).alias("next"))
    ends = parted.filter("part is not null").groupBy("key", "part").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    across = ends.select(F.col("last.kind").alias("kind"), F.lead("first.kind").over(Window.partitionBy("key").orderBy("part")).alias("next"))
    steps = within.unionByName(across).filter("kind <> next")
    pair = steps.groupBy(F.least("kind", "next").alias("a"), F.greatest("kind", "next").alias("b")).agg(F.sum(F.when(F.col("kind") < F.col("next"), 1).otherwise(-1)).alias("ahead")).filter("ahead <> 0")
    return pair.select(F.when(F.col("ahead") > 0, F.col("a")).otherwise(F.col("b")).alias("before"), F.when(F.col("ahead") > 0, F.col("b")).otherwise(F.col("a")).alias("after"))


def components(after: list[list[int]]) -> list[int]:
    """The number of each node's strongly connected component; an edge between two components goes to the lower number."""
    n = len(after)
    number, low, part = [-1] * n, [0] * n, [-1] * n
    stack: list[int] = []
    seen = parts = 0
    for root in range(n):
        if number[root] >= 0:
            continue
        walk = [(root, iter(after[root]))]
        number[root] = low[root] = seen
        seen += 1
        stack.append(root)
        while walk:
            node, rest = walk[-1]
            for other in rest:
                if number[other] < 0:
                    number[other] = low[other] = seen
                    seen += 1
                    stack.append(other)
                    walk.append((other, iter(after[other])))
                    break
                if part[other] < 0:
                    low[node] = min(low[node], number[other])
            else:
                walk.pop()
                if walk:
                    low[walk[-1][0]] = min(low[walk[-1][0]], low[node])
                if low[node] == number[node]:
                    while part[node] < 0:
                        part[stack.pop()] = parts
                    parts += 1
    return part


class Precedence:
    """The learned order of kinds: their graph, and the graph of its strongly connected components."""

    def __init__(self, edges: Iterable[tuple[str, str]]) -> None:
        self.ids: dict[str, int] = {}
        found = {(self.ids.setdefault(a, len(self.ids)), self.ids.setdefault(b, len(self.ids))) for a, b in edges}
        self.after: list[list[int]] = [[] for _ in self.ids]
        for a, b in found:
            self.after[a].append(b)
        self.part = components(self.after)
        self.next: list[set[int]] = [set() for _ in range(max(self.part, default=-1) + 1)]
        for a, b in found:
            if self.part[a] != self.part[b]:
                self.next[self.part[a]].add(self.part[b])

    def levels(self, kinds: Iterable[str]) -> dict[str, int]:
        """Of a group's kinds, how many of them the longest path that ends at a kind has passed.

        A kind precedes another if a path leads to it, over kinds of other groups too, and none back. Of kinds
        in one cycle only the direct steps between kinds of the group count, and what is a cycle even so is level.
        """
        level = dict.fromkeys(kinds, 0)
        members: dict[int, list[int]] = {}
        names = {self.ids[k]: k for k in level if k in self.ids}
        for node in names:
            members.setdefault(self.part[node], []).append(node)
        passed = dict.fromkeys(members, 0)
        lowest, heap = min(members, default=0), [-p for p in members]
        heapq.heapify(heap)
        while heap:
            here = -heapq.heappop(heap)
            out = passed[here]
            if here in members:
                inner = self.within(members[here])
                level.update((names[node], out + depth) for node, depth in inner.items())
                out += 1 + max(inner.values())
            for there in self.next[here]:
                if there >= lowest:
                    if there not in passed:
                        heapq.heappush(heap, -there)
                    passed[there] = max(passed.get(there, 0), out)
        return level

    def within(self, nodes: list[int]) -> dict[int, int]:
        """The same for kinds of one component, by the direct steps between them."""
        if len(nodes) == 1:
            return {nodes[0]: 0}
        place = {node: i for i, node in enumerate(nodes)}
        after = [[place[x] for x in self.after[node] if x in place] for node in nodes]
        part = components(after)
        depth = [0] * (max(part) + 1)
        for i in sorted(range(len(nodes)), key=lambda i: -part[i]):
            for j in after[i]:
                if part[i] != part[j]:
                    depth[part[j]] = max(depth[part[j]], depth[part[i]] + 1)
        return {node: depth[part[i]] for i, node in enumerate(nodes)}


def group_levels(edges: DataFrame, groups: DataFrame, *, parts: int = 8) -> DataFrame:
    """``kinds, kind, level`` for each row ``kinds`` (a sorted array) of ``groups``; the higher level comes later in the group.

    Each of ``parts`` tasks has the whole graph of kinds and a part of the groups.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: set[tuple[str, str]] = set()
        order = None
        for batch in batches:
            rows: list[tuple] = []
            for kinds, edge in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                if edge:
                    edges.add(tuple(kinds))
                else:
                    order = order or Precedence(edges)
                    rows += [(kinds, kind, level) for kind, level in order.levels(kinds).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.list_(pa.string()), pa.string(), pa.int64()))], ["kinds", "kind", "level"])

    graph = edges.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("edge"), F.array("before", "after").alias("kinds"))
    asked = groups.select("kinds").distinct().select(F.pmod(F.xxhash64("kinds"), F.lit(parts)).cast("int").alias("part"), F.lit(False).alias("edge"), "kinds")
    return graph.unionByName(asked).repartition(parts, "part").sortWithinPartitions(F.desc("edge")).mapInArrow(scan, "kinds array<string>, kind string, level bigint")


def transition_precedence(values: DataFrame, *, salts: int = 32, hot: int = 10_000) -> DataFrame:
    """Learned order of all value classes: ``kind, level``; the higher level comes later.

    The level is the length of the longest path of transitions to the kind; kinds in one cycle have the same.
    """
    edges = transitions(values, salts=salts, hot=hot)
    every = edges.select(F.explode(F.array("before", "after")).alias("kind")).agg(F.sort_array(F.collect_set("kind")).alias("kinds")).filter("size(kinds) > 0")
    return group_levels(edges, every, parts=1).select("kind", "level")


def url_values(rows: DataFrame, *, key: str = "index", row_id: str = "row_id", url: str = "url", at: str = "updated_at") -> DataFrame:
    """The surviving addresses with their kinds and times: ``key, row_id, kind, at``."""
    values = rows.select(F.col(key).alias("key"), F.col(row_id).alias("row_id"), surviving(F.col(url)).alias("url"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"))
    return values.filter("key is not null and row_id is not null and url is not null").select("key", "row_id", value_class(F.col("url")).alias("kind"), "at")


def surviving_rows(rows: DataFrame, sources: DataFrame, *, key: str = "index", row_id: str = "row_id", messages: str = "messages", answer: str = "final_answer", url: str = "url", source: str = "source", at: str = "updated_at", values: bool = True) -> DataFrame:
    """For each key and field the row whose value survives, and the value: ``index, field, row_id, value``.

    Without ``values`` only the row is told, and no text is moved.

    Only keys with two or more rows; null keys stand alone and give nothing. ``solution``: the longest
    assistant content without outer white space; ``final_answer``: the value of the most trusted source
    (sources without a rank come last); ``url``: the latest value; where no value of the group has a time,
    the topologically latest of its kinds by the transitions learned from all groups. Null, blank and placeholder values
    never survive; a field without a surviving value gives no row; the smallest row_id decides ties and
    repeated rows count as one row. Every choice is a minimum of a small struct, so no group, however
    large, meets in one task; only its distinct kinds do, and the graph of kinds. Empty tables give no rows;
    other columns are ignored.
    """
    ranks = sources.groupBy(F.col("source").alias("s")).agg(F.min("trust_rank").alias("rank"))
    solution = F.array_max(F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: F.struct(F.length(surviving(m["content"])).alias("n"), surviving(m["content"]).alias("v"))))
    base = rows.filter(F.col(key).isNotNull() & F.col(row_id).isNotNull()).select(
        F.col(key).alias("key"), F.col(row_id).alias("row_id"), F.col(source).alias("s"), solution["v"].alias("solution"), surviving(F.col(answer)).alias("answer"), surviving(F.col(url)).alias("url"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"),
    )
    addresses = url_values(rows, key=key, row_id=row_id, url=url, at=at)
    undated = addresses.groupBy("key").agg(F.max("at").alias("at"), F.sort_array(F.collect_set(F.when(F.col("at").isNull(), F.col("kind")))).alias("kinds")).filter("at is null and size(kinds) > 1").select("key", "kinds")
    levels = undated.join(group_levels(transitions(addresses), undated), "kinds").select("key", "kind", "level")
    ranked = base.join(ranks, "s", "left").withColumn("kind", value_class(F.col("url"))).join(levels, ["key", "kind"], "left")
    last = F.lit(2**31 - 1)

    ranked = ranked.withColumn("size", F.length("solution"))
    kept = ["solution", "answer", "url"]
    if not values:  # whether there is a value is all that the choice needs
        ranked = ranked.withColumns({c: F.when(F.col(c).isNotNull(), "") for c in kept})

    def best(value: str, *order: Column) -> Column:
        return F.min(F.when(F.col(value).isNotNull(), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("row_id").alias("row_id"), F.col(value).alias("value"))))

    chosen = ranked.groupBy("key").agg(
        (F.min("row_id") < F.max("row_id")).alias("several"),
        best("solution", -F.col("size")).alias("solution"),
        best("answer", F.coalesce("rank", last)).alias("final_answer"),
        best("url", F.col("at").isNull(), -F.col("at"), -F.coalesce("level", F.lit(0))).alias("url"),
    )
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}.row_id").alias("row_id"), F.col(f"{f}.value").alias("value")) for f in ("solution", "final_answer", "url")]))
    found = chosen.filter("several").select(F.col("key").alias("index"), fields.alias("x")).filter("x.row_id is not null").select("index", "x.field", "x.row_id", "x.value")
    return found if values else found.drop("value")


def survivors(rows: DataFrame, sources: DataFrame, **columns: str) -> DataFrame:
    """One record per key, built of the surviving values: ``index, solution, final_answer, url``."""
    chosen = surviving_rows(rows, sources, **columns)
    return chosen.groupBy("index").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in ("solution", "final_answer", "url")])
