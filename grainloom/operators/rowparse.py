"""Rows that fail to parse (problem 3): load the valid ones, say of the others what is wrong.

Each line is parsed at minimum cost. Reading what the format allows costs nothing; inserting, deleting
or escaping a quote, or inserting or deleting a delimiter, costs one. A line of cost zero whose values
have the right types loads (what json.loads reads costs nothing and is not parsed twice, except that it
reads NaN and Infinity, which are no JSON; what it refuses may still cost nothing). For any other the cheapest edits name the reason: edits at the end of the
line mean a broken shape, edits of quotes and escapes broken quoting, delimiters between csv fields a
wrong number of columns.
"""

from __future__ import annotations

import heapq
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame

ROLES = ("system", "user", "assistant")
KEYS = ("index", "source", "messages")
_LITERAL = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null", re.ASCII)
_WORDS = {"true": True, "false": False, "null": None}
_ESCAPE = re.compile(r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})')
_WHOLE = re.compile(r"-0|[0-9]+")
_STRING_END = re.compile(r'["\\\x00-\x1f,}\]:]')
_PIECE = re.compile(r'[",:\[\]{}]')
_SPACE = re.compile(r"[ \t\r\n]*")
#: Edits after which a line is not one whole object; all other edits of JSON concern quotes and escapes.
SHAPE_EDITS = frozenset({"close", "drop rest", "insert delimiter", "delete delimiter"})


#: A parse that is so many edits dearer than one that has read further is given up.
LEAD = 6


def json_edits(line: str, lead: int = LEAD) -> list[tuple[str, int]] | None:
    """The cheapest edits that make the line one JSON object, as (edit, position); None if it is no object at all.

    Dynamic programming over (position, mode, open brackets), cheapest first. Modes: ``v`` a value is due,
    ``k`` a key or the end of an object, ``K`` a key, ``:`` a colon, ``,`` a comma or a closing bracket,
    ``s`` and ``t`` within a string that is a value or a key, ``.`` the object is complete. A few edits lead
    from any mode to any other, so a state that lies behind one cheaper by ``lead`` edits is dropped: the work
    is in proportion to the length of the line, however many edits it needs.
    """
    start = _SPACE.match(line).end()
    if line[start : start + 1] != "{":
        return None
    end = len(line)
    pieces = [m.start() for m in _PIECE.finditer(line)]
    # open brackets are numbered: each stack is a bracket on another stack
    under: list[tuple[int, str]] = [(-1, "")]
    numbers: dict[tuple[int, str], int] = {}
    heap: list[tuple] = [(0, -start, 0, start, "v", 0)]
    parents: dict[tuple, tuple | None] = {(start, "v", 0): None}
    best = {(start, "v", 0): 0}
    done: set[tuple] = set()
    farthest: list[int] = []  # by cost, the farthest place reached at it or cheaper
    serial = 0

    def push(stack: int, bracket: str) -> int:
        if (stack, bracket) not in numbers:
            numbers[stack, bracket] = len(under)
            under.append((stack, bracket))
        return numbers[stack, bracket]

    def reach(here: tuple, cost: int, pos: int, mode: str, stack: int, edit: tuple[str, int] | None = None) -> None:
        nonlocal serial
        state = (pos, mode, stack)
        if cost < best.get(state, 1 << 30):
            best[state] = cost
            parents[state] = (here, edit)
            serial += 1
            heapq.heappush(heap, (cost, -pos, serial, pos, mode, stack))

    while heap:
        cost, _, _, pos, mode, stack = heapq.heappop(heap)
        here = (pos, mode, stack)
        if here in done or cost >= lead and pos < farthest[cost - lead]:
            continue
        done.add(here)
        while len(farthest) <= cost:
            farthest.append(farthest[-1] if farthest else 0)
        farthest[cost] = max(farthest[cost], pos)
        if mode in "st":
            after = "," if mode == "s" else ":"
            match = _STRING_END.search(line, pos)
            at = match.start() if match else end
            if at == end:
                reach(here, cost + 1, end, after, stack, ("close", end))
                continue
            ch = line[at]
            if ch == '"':
                reach(here, cost, at + 1, after, stack)
                reach(here, cost + 1, at + 1, mode, stack, ("escape quote", at))
            elif ch == "\\":
                legal = _ESCAPE.match(line, at)
                if legal:
                    reach(here, cost, legal.end(), mode, stack)
                else:
                    reach(here, cost + 1, at + 1, mode, stack, ("escape backslash", at))
            elif ch < " ":
                reach(here, cost + 1, at + 1, mode, stack, ("escape control", at))
            else:
                reach(here, cost, at + 1, mode, stack)
                reach(here, cost + 1, at, after, stack, ("insert quote", at))
            at = line.find("'", pos, at)
            if at >= 0:
                reach(here, cost + 1, at + 1, after, stack, ("replace quote", at))
            continue
        pos = _SPACE.match(line, pos).end()
        ch = line[pos : pos + 1]
        if mode == ".":
            if pos == end:
                edits, state = [], here
                while parents[state] is not None:
                    state, edit = parents[state]
                    if edit:
                        edits.append(edit)
                return edits[::-1]
            # what follows a faultless object goes at once; else piece by piece, or it would pay to end an object early
            reach(here, cost + (max(1, len(pieces) - bisect_left(pieces, pos)) if cost else 1), end, ".", 0, ("drop rest", pos))
            continue
        if pos == end:
            if mode in ",k":
                left = under[stack][0]
                reach(here, cost + 1, end, "," if left else ".", left, ("close", end))
            elif mode == ":":
                reach(here, cost + 1, end, "v", stack, ("close", end))
            elif mode == "K":
                reach(here, cost + 1, end, ",", stack, ("close", end))
            else:
                reach(here, cost + 1, end, ",", stack, ("close", end))
            continue
        if mode == "v":
            if ch == "{":
                reach(here, cost, pos + 1, "k", push(stack, "{"))
            elif ch == "[":
                reach(here, cost, pos + 1, "a", push(stack, "["))
            elif ch == '"':
                reach(here, cost, pos + 1, "s", stack)
            else:
                literal = _LITERAL.match(line, pos)
                if literal:
                    reach(here, cost, literal.end(), ",", stack)
                if ch == "'":
                    reach(here, cost + 1, pos + 1, "s", stack, ("replace quote", pos))
                elif ch in ",]}":
                    reach(here, cost + 1, pos, ",", stack, ("insert delimiter", pos))
                else:
                    reach(here, cost + 1, pos, "s", stack, ("insert quote", pos))
        elif mode == "a":
            if ch == "]":
                reach(here, cost, pos + 1, "," if under[stack][0] else ".", under[stack][0])
            else:
                reach(here, cost, pos, "v", stack)
        elif mode in "kK":
            if ch == '"':
                reach(here, cost, pos + 1, "t", stack)
            elif ch == "}":
                left = under[stack][0]
                extra = 0 if mode == "k" else 1
                reach(here, cost + extra, pos + 1, "," if left else ".", left, ("delete delimiter", pos) if extra else None)
            elif ch == "'":
                reach(here, cost + 1, pos + 1, "t", stack, ("replace quote", pos))
            elif ch == ",":
                reach(here, cost + 1, pos + 1, mode, stack, ("delete delimiter", pos))
            else:
                reach(here, cost + 1, pos, "t", stack, ("insert quote", pos))
        elif mode == ":":
            if ch == ":":
                reach(here, cost, pos + 1, "v", stack)
            elif ch == '"':
                reach(here, cost + 1, pos + 1, ":", stack, ("delete quote", pos))
                reach(here, cost + 1, pos, "v", stack, ("insert delimiter", pos))
            else:
                reach(here, cost + 1, pos, "v", stack, ("insert delimiter", pos))
        else:  # a comma or a closing bracket
            if ch == ",":
                reach(here, cost, pos + 1, "K" if under[stack][1] == "{" else "v", stack)
            elif ch == ("}" if under[stack][1] == "{" else "]"):
                reach(here, cost, pos + 1, "," if under[stack][0] else ".", under[stack][0])
            elif ch == '"':
                reach(here, cost + 1, pos + 1, ",", stack, ("delete quote", pos))
                reach(here, cost + 1, pos, "K" if under[stack][1] == "{" else "v", stack, ("insert delimiter", pos))
            else:
                reach(here, cost + 1, pos + 1, ",", stack, ("delete delimiter", pos))
                reach(here, cost + 1, pos, "," if under[stack][0] else ".", under[stack][0], ("insert delimiter", pos))
    return None


class Number:
    """A number as the line spells it, of any length."""

    def __init__(self, text: str) -> None:
        self.text = text


def json_record(line: str) -> tuple[dict, dict[str, str]] | None:
    """The object of a line that costs nothing, and the texts of its values; None if an edit is due.

    The grammar and modes of ``json_edits``: at cost 0 there is never a choice, so one state at a time is
    enough, and brackets may be as deep as they like. Of equal keys the last counts.
    """
    pos, end = _SPACE.match(line).end(), len(line)
    if line[pos : pos + 1] != "{":
        return None
    top: dict = {}
    texts: dict[str, str] = {}
    stack: list[tuple[dict | list, str, int]] = [(top, "", pos)]
    pos, mode, key = pos + 1, "k", ""
    while stack:
        pos = _SPACE.match(line, pos).end()
        if pos == end:
            return None
        ch, into = line[pos], stack[-1][0]
        closing = "}" if isinstance(into, dict) else "]"
        if mode in ",ka" and ch == closing:
            _, name, at = stack.pop()
            pos, mode = pos + 1, ","
            if len(stack) == 1:
                texts[name] = line[at:pos]
        elif mode == ",":
            if ch != ",":
                return None
            pos, mode = pos + 1, "K" if closing == "}" else "v"
        elif mode == ":":
            if ch != ":":
                return None
            pos, mode = pos + 1, "v"
        else:
            at, value = pos, None
            if ch == '"':
                try:
                    value, pos = scanstring(line, pos + 1, True)
                except ValueError:
                    return None
                if mode in "kK":
                    key, mode = value, ":"
                    continue
            elif mode in "kK":
                return None
            elif ch in "{[":
                value, pos = {} if ch == "{" else [], pos + 1
            else:
                literal = _LITERAL.match(line, pos)
                if not literal:
                    return None
                value, pos = _WORDS.get(literal[0], Number(literal[0])), literal.end()
            if closing == "}":
                into[key] = value
            else:
                into.append(value)
            if into is top:
                texts[key] = line[at:pos]
            mode = ","
            if ch in "{[":
                stack.append((value, key, at))
                mode = "k" if ch == "{" else "a"
    return (top, texts) if _SPACE.match(line, pos).end() == end else None


def _refuse(text: str) -> None:
    raise ValueError(text)


def csv_edits(line: str, n_fields: int = 4) -> tuple[list[tuple[str, int]], list[str]]:
    """The cheapest edits that make the line ``n_fields`` csv fields, and the fields as they then read.

    Quotes come first: the line is cut into fields at the least number of quote edits (ties: the fields
    nearest to ``n_fields``), and only then delimiters are inserted or deleted.
    """
    # mode: f field begins, u plain, q quoted, e a quote within quotes has been read; value: cost, number of
    # fields, edits and pieces, the latter two as chains (one before, item), so that no step copies them
    states: dict[tuple[str, int], tuple] = {("f", 0): (0, 1, None, None)}

    def offer(to: dict, key: tuple[str, int], cost: int, count: int, edits: tuple | None, pieces: tuple | None) -> None:
        if key not in to or cost < to[key][0]:
            to[key] = (cost, count, edits, pieces)

    for m in re.finditer(r'[",]|[^",]+', line):
        piece, at = m[0], m.start()
        after: dict[tuple[str, int], tuple] = {}
        for (mode, n), (cost, count, edits, pieces) in states.items():
            if piece == ",":
                if mode in "fue":
                    offer(after, ("f", min(n + 1, n_fields)), cost, count + 1, edits, (pieces, None))
                if mode == "q":
                    offer(after, ("q", n), cost, count, edits, (pieces, ","))
            elif piece == '"':
                if mode == "f":
                    offer(after, ("q", n), cost, count, edits, pieces)
                elif mode == "q":
                    offer(after, ("e", n), cost, count, edits, pieces)
                    offer(after, ("q", n), cost + 1, count, (edits, ("double quote", at)), (pieces, '"'))
                elif mode == "e":
                    offer(after, ("q", n), cost, count, edits, (pieces, '"'))
                if mode in "fu":
                    offer(after, ("u", n), cost + 1, count, (edits, ("delete quote", at)), pieces)
            elif mode == "e":
                offer(after, ("q", n), cost + 1, count, (edits, ("double quote", at - 1)), (pieces, '"' + piece))
            else:
                offer(after, ("u" if mode in "fu" else "q", n), cost, count, edits, (pieces, piece))
        states = after

    def chain(node: tuple | None) -> list:
        out = []
        while node is not None:
            node, item = node
            out.append(item)
        return out[::-1]

    ends = []
    for (mode, _), (cost, count, edits, pieces) in states.items():
        if mode == "q":
            cost, edits = cost + 1, (edits, ("insert quote", len(line)))
        ends.append((cost, abs(count - n_fields), edits, pieces))
    least = min(e[:2] for e in ends)
    edits, pieces = min(((chain(e), p) for c, o, e, p in ends if (c, o) == least), key=lambda x: x[0])
    fields: list[list[str]] = [[]]
    for piece in chain(pieces):
        if piece is None:
            fields.append([])
        else:
            fields[-1].append(piece)
    word = "insert delimiter" if len(fields) < n_fields else "delete delimiter"
    return [*edits, *[(word, len(line))] * least[1]], ["".join(f) for f in fields]


def valid_index(value: object) -> bool:
    if isinstance(value, bool):
        return False
    if isinstance(value, Number):
        return bool(_WHOLE.fullmatch(value.text))
    if isinstance(value, int):
        return value >= 0
    return value is None or isinstance(value, str) and value.isascii() and value.isdigit()


def valid_messages(value: object) -> bool:
    return isinstance(value, list) and bool(value) and all(isinstance(m, dict) and m.get("role") in ROLES and isinstance(m.get("content"), str) for m in value)


def parse_line(fmt: str, line: str) -> tuple[str | None, list[tuple[str, int]], dict | None]:
    """Reason (None if the line loads), the edits behind it, and the record if it loads."""
    if fmt == "csv":
        edits, fields = csv_edits(line)
        if any("quote" in e for e, _ in edits):
            return "quoting", edits, None
        if edits:
            return "columns", edits, None
        index = fields[0] or None
        if not valid_index(index):
            return "value", [], None
        return None, [], {"index": index, "source": fields[1], "messages": [{"role": "user", "content": fields[2]}, {"role": "assistant", "content": fields[3]}]}
    try:
        record, texts = json.loads(line, parse_constant=_refuse), None
    except (ValueError, RecursionError):  # no JSON, or too deep or a number too long for it: the parse decides
        record, texts = json_record(line) or (None, None)
    if record is None and line.strip(" \t\r\n") != "null":
        edits = json_edits(line)
        shape = edits is None or any(e in SHAPE_EDITS for e, _ in edits)
        return "shape" if shape else "quoting", edits or [], None
    if not isinstance(record, dict):
        return "shape", [], None
    if any(k not in record for k in KEYS):
        return "columns", [], None
    if not valid_index(record["index"]) or not valid_messages(record["messages"]):
        return "value", [], None
    if texts is not None and isinstance(record["index"], Number):
        record["index"] = record["index"].text.lstrip("-")
    if texts is not None and isinstance(record["source"], (Number, bool, dict, list)):
        record["source"] = texts["source"]
    return None, [], record


def parse_rows(lines: DataFrame, *, line_id: str = "line_id", fmt: str = "fmt", line: str = "line") -> DataFrame:
    """One row per line: ``line_id, status, reason, edits, index, source, messages``.

    ``status`` is ``loaded``, ``failed`` or ``blank`` (null, empty or white space only: neither loads nor
    fails). ``reason`` is the first of ``shape``, ``quoting``, ``columns`` and ``value`` that applies, ``edits``
    the cheapest edits with their positions. Formats are ``csv`` and ``jsonl``; a null or unknown format is
    read as jsonl. Index and source are strings as loaded (a source of another type as its JSON). No
    shuffle; repeated lines give a row each; lines of any length are parsed whole; an empty table gives no
    rows; other columns are ignored.
    """
    messages = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for kind, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is None or not text.strip():
                    row = ("blank", None, None, None, None, None)
                else:
                    reason, edits, record = parse_line(kind, text.rstrip("\r\n"))
                    said = "; ".join(f"{e} at {p}" for e, p in edits) or None
                    if record is None:
                        row = ("failed", reason, said, None, None, None)
                    else:
                        index, source = record["index"], record["source"]
                        source = source if isinstance(source, str) or source is None else json.dumps(source, ensure_ascii=False)
                        row = ("loaded", None, None, None if index is None else str(index), source, [{"role": m["role"], "content": _clean(m["content"])} for m in record["messages"]])
                        row = (*row[:4], None if row[4] is None else _clean(row[4]), row[5])
                for column, value in zip(out, row):
                    column.append(value)
            arrays = [pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), messages))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["line_id", "status", "reason", "edits", "index", "source", "messages"])

    kind = lines.schema[line_id].dataType.simpleString()
    return lines.select(line_id, fmt, line).mapInArrow(scan, f"line_id {kind}, status string, reason string, edits string, index string, source string, messages array<struct<role:string,content:string>>")


def _clean(text: str) -> str:
    """Lone surrogates, which JSON can spell and UTF-8 cannot hold, become U+FFFD."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
