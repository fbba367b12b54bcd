"""Problem and solution pairs from LaTeX, wiki and forum text."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import collapse_newlines, strip

#: Rewritings of macros, in order (pattern, replacement).
MACROS = (
    (r"\\dang", r"\\angle"), (r"\\dg(?![a-zA-Z])", r"^{\\circ}"), (r"\\ol\{([^}]*)\}", "$1"), (r"\\ul\{([^}]*)\}", "$1"), (r"\\wt\{([^}]*)\}", r"\\widetilde{$1}"), (r"\\wh\{([^}]*)\}", r"\\widehat{$1}"),
    (r"\\vocab\{([^}]*)\}", "$1"), (r"\\paragraph\{([^}]*)\}", "\n$1\n"), *((rf"\\{c}{c}", rf"\\mathbb{{{c}}}") for c in "RZQNCFK"), (r"\\half", r"\\frac{1}{2}"), (r"\\cbrt\{([^}]*)\}", r"\\sqrt[3]{$1}"),
    *((rf"(?s)\\begin\{{{e}\}}.*?\\end\{{{e}\}}", "") for e in ("center", "asy", "tikzpicture", "figure")), (r"\\label\{[^}]*\}", ""), (r"\\index\{[^}]*\}", ""),
)
#: Boxes that hold a problem, by priority, and what ends a solution.
BOXES = (
    r"\\begin\{mdframed\}[^\n]*?Problem[^\n]*\n(.*?)\\end\{mdframed\}", r"\\begin\{tcolorbox\}[^\n]*?Problem[^\n]*\n(.*?)\\end\{tcolorbox\}",
    r"\\begin\{mdframed\}(.*?)\\end\{mdframed\}", r"\\begin\{problem\}(.*?)\\end\{problem\}", r"\\begin\{boxedproblem\}(.*?)\\end\{boxedproblem\}",
)
SOLUTION_END = r"(?i)\\(?:pagebreak|newpage|clearpage)|\\subsection\{|\\section\{|\\end\{document\}"
#: The headings of a wiki page that begin its parts, and what ends them.
WIKI_SPLIT = r"\n(?=(?:Problem|Solution\s*\d*|Alternate [Ss]olution|[Ss]olution \d+)\s*\n)"
WIKI_PROBLEM, WIKI_SOLUTION = r"(?i)^Problem\s*$", r"(?i)^(?:Solution|Alternate solution)"
WIKI_HALVES, WIKI_END = r"\n(?=Solution)", r"\nSee [Aa]lso\b|\n=="


def clean_tex(c: Column) -> Column:
    """Macros rewritten in order, figures and labels dropped, blank lines collapsed."""
    for pattern, replacement in MACROS:
        c = F.regexp_replace(c, pattern, replacement)
    return strip(collapse_newlines(c))


def tex_pairs(files: DataFrame, *, text: str = "text", source: str = "source", least_problem: int = 40, least_solution: int = 80) -> DataFrame:
    """``source, block, problem, solution`` of TeX files: per subsection the first box by priority and the text after it."""
    blocks = files.select(source, F.posexplode(F.split(text, r"\\subsection\{")).alias("block", "body")).filter("block > 0")
    found = F.coalesce(*[F.when(F.col("body").rlike(f"(?isu){p}"), F.array(F.regexp_extract("body", f"(?isu){p}", 1), F.regexp_extract("body", f"(?isu){p}(.*)\\z", 2))) for p in BOXES])
    pairs = blocks.withColumn("found", found).filter("found is not null")
    pairs = pairs.select(source, "block", clean_tex(strip(F.col("found")[0])).alias("problem"), clean_tex(F.split(F.col("found")[1], SOLUTION_END, 2)[0]).alias("solution"))
    return pairs.filter((F.length("problem") >= least_problem) & (F.length("solution") >= least_solution))


def wiki_pairs(pages: DataFrame, *, text: str = "text", url: str = "url", least: int = 100) -> DataFrame:
    """``url, problem, solutions`` of wiki texts, cut at their headings; the last problem section counts."""
    body = strip(collapse_newlines(F.col(text)))
    sections = F.transform(F.split(body, WIKI_SPLIT), strip)
    head = lambda s: F.split(s, "\n", 2)[0]
    rest = lambda s: F.coalesce(strip(F.get(F.split(s, "\n", 2), F.lit(1))), F.lit(""))
    problems = F.transform(F.filter("sections", lambda s: head(s).rlike(WIKI_PROBLEM)), rest)
    solutions = F.filter(F.transform(F.filter("sections", lambda s: head(s).rlike(WIKI_SOLUTION)), rest), lambda s: F.length(s) > least)
    halves = F.split("body", WIKI_HALVES, 2)
    rows = pages.select(F.col(url).alias("url"), body.alias("body"), sections.alias("sections"))
    rows = rows.withColumn("p", F.coalesce(F.try_element_at(problems, F.lit(-1)), F.lit(""))).withColumn("s", solutions)
    split = (F.col("p") == "") & (F.size(halves) == 2)
    rows = rows.select("url", F.when(split, strip(halves[0])).otherwise(F.col("p")).alias("problem"), F.when(split, F.array(strip(F.get(halves, F.lit(1))))).otherwise(F.col("s")).alias("s"))
    cut = F.filter(F.transform("s", lambda s: strip(F.split(s, WIKI_END, 2)[0])), lambda s: F.length(s) > least)
    return rows.select("url", "problem", cut.alias("solutions")).filter((F.col("problem") != "") & (F.size("solutions") > 0))


def longest(texts: Column) -> Column:
    """The longest string of an array, the first on ties; null for an empty array."""
    start = F.lit(None).cast("string")
    return F.aggregate(texts, start, lambda best, s: F.when(best.isNull() | (F.length(s) > F.length(best)), s).otherwise(best))


class _Text(HTMLParser):
    """Text of a page, formulas as dollars; ``within`` keeps only the named element."""

    def __init__(self, within: tuple[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.within, self.depth, self.found, self.math, self.out = within, 0, within is None, None, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        named = dict(attrs)
        if self.within and not self.depth and self.within[1] in (named.get(self.within[0]) or "").split():
            self.depth, self.found = 1, True
        elif self.depth and tag not in ("br", "img", "hr", "input", "meta", "link"):
            self.depth += 1
        if tag == "math":
            self.math = (named, [])
        if tag == "img" and (self.depth or not self.within) and named.get("alt"):
            self.out.append(named["alt"])

    def handle_endtag(self, tag: str) -> None:
        if tag == "math" and self.math:
            named, body = self.math
            formula = "".join(body).strip() or named.get("alttext") or ""
            self.math = None
            mark = "$$" if named.get("display") == "block" else "$"
            if self.depth or not self.within:
                self.out.append(f"{mark}{formula}{mark}")
        if self.depth and tag not in ("br", "img", "hr", "input", "meta", "link"):
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.math:
            self.math[1].append(data)
        elif self.depth or not self.within:
            self.out.append(data)


def page_text(page: str | None, separator: str = "\n") -> str | None:
    """The content of a wiki page as text, formulas in dollars; null if the page has no content element."""
    for within in (("id", "mw-content-text"), ("class", "mw-parser-output")):
        parser = _Text(within)
        parser.feed(page or "")
        parser.close()
        if parser.found:
            return re.sub(r"\n{3,}", "\n\n", separator.join(p for p in parser.out if p)).strip()
    return None


def post_text(post: str | None) -> str:
    """A forum post as text with newlines between its pieces."""
    parser = _Text()
    parser.feed(post or "")
    parser.close()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(p for p in parser.out if p)).strip()


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a" and (href := dict(attrs).get("href")) is not None:
            self.found.append(href)

    handle_startendtag = handle_starttag


def links(page: str | None) -> list[str]:
    parser = _Links()
    parser.feed(page or "")
    parser.close()
    return parser.found


#: The elements that hold the posts of a thread, as (element or None for any, class).
POSTS = (("div", "cmty-post-body"), ("div", "post-body"), (None, "post_text"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Posts(HTMLParser):
    """The inner markup of each element of POSTS, in order; one within another is a post of its own as well."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.posts: list[list[str]] = []
        self.open: list[tuple[int, int]] = []  # post, depth of its element
        self.depth = 0

    def put(self, text: str) -> None:
        for post, _ in self.open:
            self.posts[post].append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.put(self.get_starttag_text() or "")
        if tag in _VOID:
            return
        self.depth += 1
        classes = (dict(attrs).get("class") or "").split()
        if any(name in classes and element in (None, tag) for element, name in POSTS):
            self.posts.append([])
            self.open.append((len(self.posts) - 1, self.depth))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.put(self.get_starttag_text() or "")

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID:
            return
        self.open = [(p, d) for p, d in self.open if d < self.depth]
        self.depth -= 1
        self.put(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        self.put(data)

    def handle_entityref(self, name: str) -> None:
        self.put(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self.put(f"&#{name};")


def thread_posts(page: str | None) -> list[str]:
    """The texts of a thread's posts, empty ones too, so that the first stays the first."""
    parser = _Posts()
    parser.feed(page or "")
    parser.close()
    return [post_text("".join(p)) for p in parser.posts]


def thread_pairs(pages: DataFrame, *, url: str = "url", page: str = "page") -> DataFrame:
    """``url, problem, solutions`` of thread pages: the first post, and the later ones that look like solutions."""
    posts = F.pandas_udf(lambda s: s.map(thread_posts), "array<string>")
    rows = pages.select(F.col(url).alias("url"), posts(F.col(page)).alias("posts"))
    return rows.select("url", thread_pair(F.col("posts")).alias("pair")).filter("pair is not null").select("url", "pair.*")


def page_texts(pages: DataFrame, column: str = "html") -> DataFrame:
    udf = F.pandas_udf(lambda s: s.map(page_text), "string")
    return pages.withColumn("text", udf(column))


def thread_pair(posts: Column) -> Column:
    """Problem (the first post) and the posts that look like solutions; null if either is missing."""
    solution = F.filter(F.slice(posts, F.lit(2), F.greatest(F.size(posts), F.lit(0))), lambda p: (F.length(p) > 100) & (F.contains(p, F.lit("$")) | F.lower(p).rlike("proof|solution")))
    return F.when((F.get(posts, F.lit(0)) != "") & (F.size(solution) > 0), F.struct(F.get(posts, F.lit(0)).alias("problem"), solution.alias("solutions")))
