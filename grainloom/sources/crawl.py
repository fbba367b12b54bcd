"""Address grids and page fetching with an injectable client."""

from __future__ import annotations

import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.operators.extract import links, page_texts, wiki_pairs
from grainloom.sources.jsonl import store_files


def contest_grid(contests: DataFrame) -> DataFrame:
    """Addresses of (contest, year, number): ``template`` with ``{year}`` and ``{n}``, years ``from_year`` to ``to_year``, numbers 1 to ``n_problems``."""
    years = contests.select("*", F.explode(F.sequence("from_year", "to_year")).alias("year"))
    numbers = years.select("*", F.explode(F.sequence(F.lit(1), F.col("n_problems"))).alias("n"))
    url = F.replace(F.replace("template", F.lit("{year}"), F.col("year").cast("string")), F.lit("{n}"), F.col("n").cast("string"))
    return numbers.select("contest", "year", "n", url.alias("url"))


def year_range(c: str):
    """Two integers of a range such as ``2010-2023``."""
    parts = F.split(c, "-")
    return [parts[i].try_cast("int") for i in (0, 1)]


def name_grid(spark: SparkSession, bases: list[str], patterns: list[str], first_year: int, last_year: int) -> DataFrame:
    """``url`` for each base, year and name pattern (with ``{year}``), in that order of nesting."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("string").alias("year"))
    names = years.select("year", F.explode(F.array(*map(F.lit, patterns))).alias("pattern"))
    return names.select(F.explode(F.array(*map(F.lit, bases))).alias("base"), "year", "pattern").select(F.concat("base", F.replace("pattern", F.lit("{year}"), F.col("year"))).alias("url"))


def bearer(variable: str) -> dict[str, str]:
    """The authorisation header of a token in the environment, if there is one; read where the client is made, so it is in no plan."""
    token = os.environ.get(variable)
    return {"Authorization": f"Bearer {token}"} if token else {}


class HttpClient:
    """A client for ``fetch``: one opener with its headers for each task, a time-out for each request."""

    def __init__(self, headers: dict[str, str] | None = None, *, timeout: float = 15.0, token_variable: str | None = None) -> None:
        self.headers, self.timeout, self.token_variable, self.opener = headers or {}, timeout, token_variable, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"opener": None}

    def __call__(self, url: str) -> tuple[int, str]:
        if self.opener is None:
            self.opener = urllib.request.build_opener()
            self.opener.addheaders = [*(self.headers | (bearer(self.token_variable) if self.token_variable else {})).items()]
        try:
            with self.opener.open(url, timeout=self.timeout) as answer:
                return answer.status, answer.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            return e.code, ""


def fetch(urls: DataFrame, client: Callable[[str], tuple[int, str]], *, attempts: int = 3, delay: float = 0.5, backoff: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``url, page`` (null after the last attempt); only status 200 counts, 429 waits longer each time.

    The client runs in the tasks, one after another with a delay, so few partitions keep a site unharmed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pages = []
            for url in batch["url"]:
                page = None
                for attempt in range(attempts):
                    try:
                        status, body = client(url)
                    except Exception:  # noqa: BLE001 - whatever a client raises is a failed attempt
                        status, body = 0, ""
                    if status == 200:
                        page = body
                        break
                    sleep(backoff * (attempt + 1) if status == 429 else delay)
                pages.append(page)
                sleep(delay)
            yield pd.DataFrame({"url": batch["url"], "page": pages})

    return urls.select("url").mapInPandas(run, "url string, page string")


def page_links(pages: DataFrame, *, suffixes: tuple[str, ...] = (".tex",), distinct: bool = True) -> DataFrame:
    """Absolute addresses that the pages (``url, page``) link to, of the given endings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, urljoin(u, h)) for u, p in zip(batch["url"], batch["page"]) for h in links(p) if h.endswith(suffixes)]
            yield pd.DataFrame(rows, columns=["url", "link"])

    found = pages.select("url", "page").mapInPandas(run, "url string, link string")
    return found.select("link").distinct() if distinct else found


def bytes_as_text(content):
    """Bytes as UTF-8, those that are none left out."""
    return F.pandas_udf(lambda s: s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore")), "string")(content)


def looks_like_tex(content):
    """Download gate: more than 300 bytes and a mark of TeX among the first 200."""
    start = bytes_as_text(F.substring(content, 1, 200))
    return (F.octet_length(content) > 300) & start.rlike(r"\\documentclass|\\begin|Evan Chen|%")


#: Fixed value: what a wiki says on a page without text.
NO_TEXT = "There is currently no text in this page"


def has_text(page):
    return ~F.contains(page, F.lit(NO_TEXT))


def restrict_contests(contests: DataFrame, olympiad: list[str], *, all_contests: bool = False, names: list[str] | None = None) -> DataFrame:
    """The catalog rows to crawl: the named ones (unknown names drop out), else the olympiad ones, else all."""
    rows = contests.filter(F.col("contest").isin(*names)) if names else contests
    return rows if all_contests else rows.filter(F.col("contest").isin(*olympiad))


def forum_threads(searches: DataFrame, *, per_year: int = 10, max_threads: int = 0) -> DataFrame:
    """``year, link``: of each year's search page (``year, url, page``) the first links to threads; 0 means no overall limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(int(y), k, urljoin(u, h)) for y, u, p in zip(batch["year"], batch["url"], batch["page"]) for k, h in enumerate(links(p)) if "/community/c" in h]
            yield pd.DataFrame(rows, columns=["year", "at", "link"])

    from pyspark.sql import Window

    found = searches.select("year", "url", "page").mapInPandas(run, "year int, at int, link string")
    nth = F.row_number().over(Window.partitionBy("year").orderBy("at"))
    kept = found.withColumn("nth", nth).filter(F.col("nth") <= per_year).orderBy("year", "nth").select("year", "link")
    return kept.limit(max_threads) if max_threads else kept


def tree_files(listings: DataFrame, *, suffix: str = ".tex", prefix: str = "") -> DataFrame:
    """``repository, path, file_name`` of the files that JSON tree listings (``repository, body``) name; a body that fails gives none."""
    tree = F.coalesce(F.from_json("body", "tree array<struct<path:string>>")["tree"], F.array().cast("array<struct<path:string>>"))
    paths = listings.select("repository", F.explode(tree).alias("x")).select("repository", "x.path").filter("path is not null")
    return paths.filter(F.endswith("path", F.lit(suffix)) & F.startswith("path", F.lit(prefix))).withColumn("file_name", F.replace("path", F.lit("/"), F.lit("_")))


def not_on_disk(urls: DataFrame, files: DataFrame) -> DataFrame:
    """Addresses whose file name is not among ``file_name`` of the files at hand."""
    name = F.substring_index(F.parse_url("url", F.lit("PATH")), "/", -1)
    return urls.withColumn("file_name", name).join(files.select("file_name").distinct(), "file_name", "left_anti")


def large_enough(content, least: int = 200):
    return F.octet_length(content) > least


def crawl_notes(spark: SparkSession, client: Callable[[str], tuple[int, str]], *, bases: list[str], patterns: list[str], first_year: int, last_year: int, indexes: list[str] = (), files: DataFrame | None = None, folder: str | None = None, **fetching: object) -> DataFrame:
    """Notes of a site: the addresses of the name grid and those its index pages link to, sorted, without the files at hand.

    Without ``folder`` nothing is fetched and the plan of ``url, file_name`` is returned (a dry run; the index
    pages are read when it runs); with it, what looks like TeX is stored there: ``file_name, n_bytes``.
    """
    wanted = name_grid(spark, bases, patterns, first_year, last_year)
    if indexes:
        pages = fetch(spark.createDataFrame([(u,) for u in indexes], "url string"), client, **fetching).filter("page is not null")
        wanted = wanted.union(page_links(pages).select("link")).distinct()
    plan = not_on_disk(wanted, files if files is not None else spark.createDataFrame([], "file_name string")).select("url", "file_name").orderBy("url")
    if folder is None:
        return plan
    content = fetch(plan, client, **fetching).filter("page is not null").select("url", F.encode("page", "utf-8").alias("content")).filter(looks_like_tex(F.col("content")))
    return store_files(content.select(F.substring_index(F.parse_url("url", F.lit("PATH")), "/", -1).alias("file_name"), "content"), folder)


def crawl_wiki(contests: DataFrame, client: Callable[[str], tuple[int, str]], *, cached: DataFrame | None = None, **fetching: object) -> DataFrame:
    """``url, problem, solutions`` of a wiki's problem pages that are not ``cached`` (url) yet."""
    urls = contest_grid(contests).select("url")
    if cached is not None:
        urls = urls.join(cached.select("url").distinct(), "url", "left_anti")
    pages = fetch(urls, client, **fetching).filter("page is not null").filter(has_text(F.col("page")))
    return wiki_pairs(page_texts(pages, "page").filter("text is not null"))
