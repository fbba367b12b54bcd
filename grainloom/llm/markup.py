"""Markup residue in text documents (problem 7).

Texts become streams of markup tokens and text slots; formulas and code are kept apart, so symbols in
them are never tokens. The streams of one host are aligned into wrappers, union-free regular expressions
(``wrappers``). Tokens of a known grammar are markup; tokens that only may be markup (a numbered line, an
unknown tag) are so where the wrapper of their host has them at a fixed or repeated place. What the
wrapper accepts is replaced by plain structure, and everything else is text and stays.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.llm import wrappers
from grainloom.session import checkpoint

#: Names of HTML elements.
ELEMENTS = (
    "a abbr article aside b big blockquote body br caption center cite code col dd del div dl dt em fieldset figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li "
    "link main mark meta nav ol option p pre q s samp script section select small span strike strong style sub sup table tbody td textarea tfoot th thead title tr tt u ul var video"
)
#: Text and layout commands and environments of LaTeX; mathematics is not among them.
COMMANDS = (
    "part chapter section subsection subsubsection paragraph subparagraph textbf textit texttt textsc textsf textrm emph underline uline item label ref eqref pageref cite footnote caption centering "
    "noindent indent medskip bigskip smallskip vspace hspace vfill hfill newpage clearpage pagebreak linebreak newline maketitle tableofcontents documentclass usepackage title author date includegraphics "
    "input include bibliography href url large Large LARGE huge Huge small footnotesize tiny bfseries itshape ttfamily"
)
ENVIRONMENTS = "document proof theorem lemma corollary proposition definition remark example problem solution claim exercise enumerate itemize description center flushleft flushright quote quotation verse abstract figure table tabular tabbing minipage verbatim lstlisting asy tikzpicture"
MATHS = "align alignat aligned equation eqnarray gather gathered multline math displaymath cases split array matrix pmatrix bmatrix vmatrix"

_FORMULA = r"(?<!\\)\$\$[^$]*\$\$|(?<!\\)\$[^$]*\$|\\\[.*?\\\]|\\\(.*?\\\)|\\begin\{(?:" + "|".join(MATHS.split()) + r")\*?\}.*?\\end\{(?:" + "|".join(MATHS.split()) + r")\*?\}"
_CODE = r"```[^\n]*\n.*?(?:```|\Z)|<pre\b[^>]*>.*?</pre\s*>|<code\b[^>]*>.*?</code\s*>|(?<!`)`[^`\n]+`(?!`)|\\begin\{(?:verbatim|lstlisting)\}.*?\\end\{(?:verbatim|lstlisting)\}|<math\b.*?</math\s*>|<nowiki>.*?</nowiki>"
_TAG = r"</?(?:" + "|".join(ELEMENTS.split()) + r")(?:\s[^<>]*)?/?>|<!--.*?-->|<!DOCTYPE[^>]*>"
_ENTITY = r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_LATEX = r"\\(?:" + "|".join(COMMANDS.split()) + r")(?![A-Za-z])\*?(?:\[[^\]\n]*\])?\{?|\\(?:begin|end)\{(?:" + "|".join(ENVIRONMENTS.split()) + r")\*?\}(?:\[[^\]\n]*\])?"
_WIKI = (
    r"^={2,6}(?=[^=\n]+={2,6}[ \t]*$)|(?<=[^=\n])={2,6}[ \t]*$|'{5}|'{3}|'{2}(?=[^'\s])|(?<=[^'\s])'{2}|\[\[[^\W\d_][^\[\]\n]*\]\]|\{\{[^\W\d_][^{}]*\}\}|^\{\|[^\n]*$|^\|}[ \t]*$|^\|-(?![-:| \t]*\|)[^\n]*$|^!(?=[^\n]*!!)[^\n]*$|^\|(?=[^\n]*\|\|)[^\n]*$"
    r"|\[https?://[^\s\]]+(?:[ \t][^\]\n]*)?\](?!\()|<ref\b[^<>]*/?>|</ref>|__(?:TOC|NOTOC)__|^[:;]+(?=[ \t]*[^\W\d])"
)
_MARKDOWN = (
    r"^#{1,6}[ \t]+(?=\S)|(?<![*\w])\*\*(?=[^\s*])|(?<=[^\s*])\*\*(?![*\w])|(?<!\w)__(?=\w)|(?<=\w)__(?!\w)|!?\[[^\[\]\n]+\]\([^\s()]+(?:[ \t][^()\n]*)?\)|^[ \t]*[-*+][ \t]+(?=\S)|^[ \t]*\d{1,3}[.)][ \t]+(?=\S)"
    r"|^>[ \t]?(?=\S)|^\|[^\n]*\|[ \t]*$|^[-*_]{3,}[ \t]*$|~~(?=\S)|(?<![*\w])\*(?=[^\s*\d])(?=[^*\n]+[^\s*]\*(?![*\w]))|(?<=[^\s*\d])\*(?![*\w])(?=[\s.,;:!?)]|$)"
)
_UNKNOWN = r"</?[A-Za-z][A-Za-z0-9:-]{0,30}(?:\s+[A-Za-z:-]+\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s<>\"']+))*\s*/?>"
TOKEN = re.compile(
    f"(?P<code>{_CODE})|(?P<formula>{_FORMULA})|(?P<html>{_TAG}|{_ENTITY})|(?P<unknown>{_UNKNOWN})|(?P<latex>{_LATEX})|(?P<wiki>{_WIKI})|(?P<markdown>{_MARKDOWN})",
    re.S | re.M | re.I,
)
KINDS = ("html", "markdown", "wiki", "latex")
#: What a text must hold outside simple formulas to be tokenised at all; a superset of what TOKEN finds.
SUSPECT = r"(?m)</?[A-Za-z!][^<>]*>|&#?[A-Za-z0-9]+;|\\[A-Za-z]{2,}|''|={2}|\[\[|\{\{|^[\{|!]|__|\*\*|`|\]\(|\[https?:|^[ \t]*(?:#{1,6}|[-*+:;>]|\d{1,3}[.)])[ \t>]*\S|^[:;]|~~|\*[^\s*\d]|[-*_]{3}"
_ORDERED = re.compile(r"\d{1,3}[.)]\s*\Z")


Token = tuple[str, str, int, int, bool]


def tokens(text: str) -> list[Token]:
    """Markup tokens in order: (kind, name, start, end, sure); formulas are ``formula``, code has the kind of its marks.

    A numbered line and an unknown tag are not sure; a star or quote mark is a token only with its partner.
    """
    out: list[Token] = []
    for m in TOKEN.finditer(text):
        kind, piece, sure = m.lastgroup, m[0], True
        if kind == "formula":
            name = "$"
        elif kind == "code":
            kind = "markdown" if piece[0] == "`" else "latex" if piece[0] == "\\" else "html" if re.match(r"<(?:pre|code)\b", piece, re.I) else "wiki"
            name = "code"
        elif kind in ("html", "unknown"):
            sure, kind = kind == "html", "html"
            if piece[0] == "&":
                if html.unescape(piece) == piece:
                    continue
                name = "&;"
            else:
                name = re.match(r"</?[!A-Za-z0-9:-]+", piece)[0].lower()
        elif kind == "latex":
            name = re.match(r"\\[A-Za-z]+\*?(?:\{[A-Za-z*]+\})?", piece)[0] if piece.startswith(("\\begin", "\\end")) else re.match(r"\\[A-Za-z]+", piece)[0]
        else:
            bare = piece.strip()
            sure = not _ORDERED.match(bare)
            name = bare if sure and len(bare) <= 6 and not bare[0].isalnum() else bare[:2] if sure else "1."
        out.append((kind, re.sub(r"[\s()]", "", name) or "_", m.start(), m.end(), sure))  # expressions are written with spaces and brackets
    pairs = {n: sum(t[1] == n for t in out) for n in ("**", "__", "~~", "*", "''", "'''", "'''''", "==", "===", "====", "=====", "======")}
    return [t for t in out if pairs.get(t[1], 2) > 1]


def stream(found: list[Token], text: str) -> list[str]:
    """Markup tokens (those that are not sure with the mark OPEN) and slots ``T`` for the text and formulas between them."""
    out, at = [], 0
    for kind, name, start, end, sure in found:
        if kind == "formula":
            continue
        if text[at:start].strip():
            out.append("T")
        out.append(f"{'' if sure else wrappers.OPEN}{kind}:{name}")
        at = end
    if text[at:].strip():
        out.append("T")
    return out


def blocks_of(text: str, found: list[Token]) -> tuple[str, str] | None:
    """Cluster (the kinds of sure tokens) and folded stream of a text with these tokens; None without tokens."""
    # entities may stand within formulas of a text that was escaped as a whole
    inner = [("html", "&;", a + m.start(), a + m.end(), True) for k, _, a, b, _ in found if k == "formula" for m in re.finditer(_ENTITY, text[a:b]) if html.unescape(m[0]) != m[0]]
    if inner:
        found = sorted([*(x for x in found if x[0] != "formula"), *inner], key=lambda x: x[2])
    if all(x[0] == "formula" for x in found):
        return None
    kinds = sorted({x[0] for x in found if x[4] and x[0] != "formula"})
    return " ".join(kinds), wrappers.dump(wrappers.fold(stream(found, text)))


def suspect(text: Column) -> Column:
    """The text may have tokens; most have none and are never tokenised."""
    plain = F.regexp_replace(text, r"(?<!\\)\$[^$]*\$", "\u0001")
    return F.coalesce(plain.rlike(SUSPECT) | text.rlike(r"&#?[A-Za-z0-9]+;"), F.lit(False))


def markup_streams(texts: DataFrame, *, keys: tuple[str, ...], host: str = "host", text: str = "text") -> DataFrame:
    """The key columns, ``host, cluster, blocks`` of each text that has tokens; one pass, no shuffle."""
    rows = texts.filter(suspect(F.col(text))).select(*keys, _host(texts, host).alias("host"), F.col(text).alias("text"))
    n = len(keys)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks_of(t, tokens(t)) or (None, None) for t in batch.column(n + 1).to_pylist()]
            clusters, streams = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n + 1)), pa.array(clusters, pa.string()), pa.array(streams, pa.string())], [*keys, "host", "cluster", "blocks"])

    return rows.mapInArrow(scan, f"{_schema(texts, keys)}, host string, cluster string, blocks string").filter("blocks is not null")


def _schema(texts: DataFrame, keys: tuple[str, ...]) -> str:
    fields = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    return ", ".join(f"`{k}` {fields[k]}" for k in keys)


def _host(texts: DataFrame, host: str) -> Column:
    return F.coalesce(host, F.lit("")) if host in texts.columns else F.lit("")


def host_wrappers(streams: DataFrame, texts: DataFrame, *, host: str = "host") -> DataFrame:
    """``host, cluster, blocks, n_texts``: the wrappers, with the number of texts of each cluster.

    The cluster without sure tokens has the host's plain texts as well.
    """
    found = wrappers.infer(streams)
    every = texts.groupBy(_host(texts, host).alias("h")).agg(F.count("*").alias("n_all"))
    marked = found.groupBy(F.col("host").alias("h")).agg(F.sum(F.when(F.col("cluster") != "", F.col("n"))).alias("n_marked"))
    sizes = every.join(marked, "h")  # a row for each host
    n_texts = F.when(F.col("cluster") == "", F.col("n_all") - F.coalesce("n_marked", F.lit(0))).otherwise(F.col("n"))
    return found.join(sizes, F.col("host") == F.col("h")).select("host", "cluster", "blocks", n_texts.alias("n_texts"))


def judged_streams(streams: DataFrame, found: DataFrame, *, salts: int = 16) -> DataFrame:
    """``host, cluster, blocks, kinds, names`` for each distinct stream: what the wrapper of its cluster accepts.

    Sorted rows are read as they come, a wrapper before its streams: it is sent once for each salt and held once.
    """
    keys = ["host", "cluster", "salt"]
    spread = found.select("host", "cluster", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "blocks", "n_texts")
    forms = streams.select("host", "cluster", "blocks").distinct().select("host", "cluster", F.pmod(F.xxhash64("blocks"), F.lit(salts)).cast("int").alias("salt"), "blocks", F.lit(None).cast("bigint").alias("n_texts"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, wrapper, n_texts, places = None, [], 0, ({}, {})
        for batch in batches:
            out: list[tuple] = []
            for *key, blocks, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if n is not None:
                    here, wrapper, n_texts = key, wrappers.load(blocks), n
                    places = wrappers.places_of(wrapper), wrappers.places_of(wrapper[::-1])
                elif key == here:
                    out.append((*key[:2], blocks, *wrappers.accepted(wrapper, n_texts, wrappers.load(blocks), places)))
            columns = zip(*out) if out else [[]] * 5
            types = [pa.string()] * 3 + [pa.list_(pa.string())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["host", "cluster", "blocks", "kinds", "names"])

    both = spread.unionByName(forms).repartition(*keys).sortWithinPartitions(*keys, F.desc_nulls_last("n_texts"))
    return both.mapInArrow(scan, "host string, cluster string, blocks string, kinds array<string>, names array<string>")


def markup_kinds(texts: DataFrame, *, keys: tuple[str, ...], host: str = "host", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Kinds of markup in each text (``keys, kinds``; only texts with some), and the wrappers of the hosts.

    The wrappers are ``host, cluster, blocks, n_texts``. Null and empty texts have no markup; a null host is a
    host of its own; repeated rows give a row each; an empty table gives empty results; other columns are
    ignored.
    """
    streams = checkpoint(markup_streams(texts, keys=keys, host=host, text=text))
    found = checkpoint(host_wrappers(streams, texts, host=host))
    judged = judged_streams(streams, found).filter("size(kinds) > 0").drop("names")
    return streams.join(judged, ["host", "cluster", "blocks"]).select(*keys, "kinds"), found


def wrapper_expressions(found: DataFrame) -> DataFrame:
    """``host, cluster, wrapper, n_texts``, the wrappers as expressions."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            written = [wrappers.expression(wrappers.load(b), n) for b, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(written, pa.string()), batch.column(3)], ["host", "cluster", "wrapper", "n_texts"])

    return found.mapInArrow(scan, "host string, cluster string, wrapper string, n_texts bigint")


#: Commands that go with their argument; the others leave it.
_GONE = re.compile(r"\\(?:label|ref|eqref|pageref|cite|vspace|hspace|input|include|includegraphics|bibliography|usepackage|documentclass|href)\b")
_BREAKS = ("<br", "</p", "</div", "</tr", "</table", "</ul", "</ol", "</blockquote")


def closing_brace(text: str, at: int) -> int:
    """Where the brace closes that was opened before ``at``; the end of the text if it stays open."""
    depth = 1
    for m in re.compile(r"\\.|[{}]", re.S).finditer(text, at):
        depth += (m[0] == "{") - (m[0] == "}")
        if not depth:
            return m.start()
    return len(text)


def plain_code(piece: str) -> str:
    if re.match(r"<math\b", piece, re.I):
        return "$" + html.unescape(re.sub(r"<[^<>]*>", "", piece)).strip() + "$"
    if piece[0] == "`" and not piece.startswith("```"):
        return piece
    body = re.sub(r"\A```[^\n]*\n|```\Z|\A\\begin\{\w+\}|\\end\{\w+\}\Z", "", piece) if piece[0] in "`\\" else html.unescape(re.sub(r"<[^<>]*>", "", piece))
    return f"\n```\n{body.strip(chr(10))}\n```\n" if "\n" in piece or re.match(r"<pre|\\", piece, re.I) else f"`{body}`"


def cells(row: str, bound: str, accepted: frozenset[str]) -> str:
    return " | ".join(clean(c, accepted) for c in re.split(bound, row.strip().strip("|!")))


def replacements(text: str, token: Token, accepted: frozenset[str]) -> list[tuple[int, int, str]]:
    """What a token is replaced by: (start, end, plain text), more than one where it encloses its text."""
    kind, name, start, end, _ = token
    piece = text[start:end]
    if kind == "formula":
        return [(start, end, html.unescape(piece))]
    if name == "code":
        return [(start, end, plain_code(piece))]
    if name == "<br" or kind == "wiki" and re.match(r"\{\||\|[-}]", piece) or re.fullmatch(r"\|[-:| \t]+", piece):  # marks that have a line to themselves go with it
        return [(start, end + (text[end : end + 1] == "\n"), "\n" if name == "<br" else "")]
    if kind == "html":
        level = re.match(r"<(/?)h([1-6])$", name)
        if level:
            return [(start, end, "\n" if level[1] else f"\n{'#' * int(level[2])} ")]
        if name == "<li":
            return [(start - (len(text[:start]) - len(text[:start].rstrip(" \t"))), end + len(text[end:]) - len(text[end:].lstrip(" \t")), "\n- ")]
        if name in ("</td", "</th"):
            return [(start, end, " | " if re.match(r"\s*<t[dh]\b", text[end:], re.I) else "")]
        return [(start, end, html.unescape(piece).replace("\xa0", " ") if name == "&;" else "\n" if name in _BREAKS else "")]
    if kind == "latex":
        opened = piece.endswith("{")
        last = closing_brace(text, end) if opened else end
        if opened and _GONE.match(piece):
            after = [(last + 1, last + 2, ""), (closing_brace(text, last + 2), closing_brace(text, last + 2) + 1, "")] if name == "\\href" and text[last + 1 : last + 2] == "{" else []
            return [(start, last + 1, ""), *after]
        level = re.match(r"\\((?:sub)*)(section|paragraph)$", name)
        if level and opened:
            depth = 1 + len(level[1]) // 3 if level[2] == "section" else 4
            return [(start, end, f"\n{'#' * depth} "), (last, last + 1, "\n")]
        if name == "\\item" and not opened:
            return [(start, end + len(text[end:]) - len(text[end:].lstrip(" \t")), "- ")]
        return [(start, end, ""), *([(last, last + 1, "")] if opened else [])]
    if kind == "wiki":
        if name.startswith("=="):
            if start == 0 or text[start - 1] == "\n":
                return [(start, end + len(text[end:]) - len(text[end:].lstrip(" \t")), f"\n{'#' * (len(name) - 1)} ")]
            return [(start - (len(text[:start]) - len(text[:start].rstrip(" \t"))), end, "\n")]
        if piece.startswith("[["):
            return [(start, end, clean(piece[2:-2].rsplit("|", 1)[-1], accepted))]
        if piece.startswith("[http"):
            return [(start, end, clean(" ".join(piece[1:-1].split()[1:]), accepted))]
        if re.match(r"!|\|(?![-}])", piece):
            return [(start, end, cells(piece, r"\|\||!!", accepted))]
        return [(start, end, "")]
    if piece[0] in "[!":
        return [(start, end, clean(re.match(r"!?\[([^\[\]\n]+)\]", piece)[1], accepted))]
    if piece[0] == "|":
        return [(start, end, cells(piece, r"\|", accepted))]
    if piece[0] == "#":
        return [(start, end, piece.strip() + " ")]
    if re.match(r"[ \t]*(?:[-*+]|\d{1,3}[.)])[ \t]", piece):
        return [(start, end, "- ")]
    return [(start, end, "")]


def clean(text: str | None, accepted: frozenset[str] = frozenset(), found: list[Token] | None = None) -> str | None:
    """Plain text with structure kept: headings as ``#`` lines, list items as ``-`` lines, code fenced, formulas as they are.

    ``accepted`` are the tokens (``kind:name``) beyond the sure ones that a wrapper has found to be markup,
    ``found`` the tokens of the text if they are known.
    """
    if text is None:
        return None
    edits = sorted(e for t in (tokens(text) if found is None else found) if t[4] or f"{t[0]}:{t[1]}" in accepted for e in replacements(text, t, accepted))
    out, at = [], 0
    for start, end, plain in edits:
        if start < at:  # within what another token has replaced
            continue
        out += text[at:start], plain
        at = end
    done = "".join([*out, text[at:]])
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+$", "", done, flags=re.M)).strip()


def clean_texts(texts: DataFrame, *, keys: tuple[str, ...], host: str = "host", text: str = "text") -> DataFrame:
    """The key columns and the clean text; null stays null, and a text without markup only loses outer space.

    Without a column of hosts all texts are of one host.
    Texts with tokens that are not sure meet the wrapper of their host; the others are done where they lie.
    """
    streams = checkpoint(markup_streams(texts, keys=keys, host=host, text=text))
    judged = judged_streams(streams.filter(F.contains("blocks", F.lit(f'"{wrappers.OPEN}'))), host_wrappers(streams, texts, host=host)).filter("size(names) > 0").drop("kinds")
    n = len(keys)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without names: the clean text, and for texts with open tokens their stream; with names: the clean text."""
        for batch in batches:
            out: list[tuple] = []
            for t, names, marked in zip(*(batch.column(n + k).to_pylist() for k in (1, 2, 3))):
                found = tokens(t) if marked else []
                form = blocks_of(t, found) if marked and names is None else None
                open_ = form is not None and f'"{wrappers.OPEN}' in form[1]
                out.append((clean(t, frozenset(names or ()), found), *(form if open_ else (None, None)), t if open_ else None))
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n + 1)), *(pa.array(c, pa.string()) for c in columns)], [*keys, "host", "clean", "cluster", "blocks", "text"])

    schema = f"{_schema(texts, keys)}, host string, clean string, cluster string, blocks string, text string"
    nothing = F.lit(None).cast("array<string>").alias("names")
    done = texts.select(*keys, _host(texts, host).alias("host"), F.col(text).alias("text"), nothing, suspect(F.col(text)).alias("marked")).mapInArrow(scan, schema)
    done = checkpoint(done)
    settled = done.filter("blocks is null")
    asked = done.filter("blocks is not null").join(judged, ["host", "cluster", "blocks"], "left")
    again = asked.select(*keys, "host", "text", F.coalesce("names", F.array().cast("array<string>")).alias("names"), F.lit(True).alias("marked")).mapInArrow(scan, schema)
    return settled.unionByName(again).select(*keys, F.col("clean").alias("text"))
