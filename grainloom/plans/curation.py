"""Queries of the curation operators over the project's tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainloom.functions import text as T
from grainloom.operators import dedup, extract, messages as M, quality as Q
from grainloom.plans import organize as O, stages
from grainloom.session import shared_folder, table
from grainloom.sources import crawl, jsonl
from grainloom.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{_WS}]+', ''), '[{_WS}]+$', '')"


def _first(role: str, ms: str = "messages") -> str:
    return f"list_filter({ms}, lambda m: m.role = '{role}')[1].content"


def _last(role: str, ms: str = "messages") -> str:
    return f"list_filter({ms}, lambda m: m.role = '{role}')[-1].content"


def _any(x: str, phrases: tuple[str, ...]) -> str:
    quoted = [p.replace("'", "''").replace("\n", "' || chr(10) || '") for p in phrases]
    return "(" + " or ".join(f"contains({x}, '{p}')" for p in quoted) + ")"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def chat(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_records")


# --- exclusion, deduplication, merging -------------------------------------------------------------

_PROBLEM = f"coalesce({_strip(_first('user'))}, '')"


@query(f"select rec_id from chat_records where source is distinct from 'lattice_cup' and {_PROBLEM} not in (select {_PROBLEM} from chat_records where source = 'lattice_cup')")
def exclude_by_problem(spark, d):
    rows = chat(spark, d)
    large, small = rows.filter(~F.col("source").eqNullSafe("lattice_cup")), rows.filter("source = 'lattice_cup'")
    return dedup.exclude_by_key(large, small, M.problem_text(F.col("messages"))).select("rec_id")


@query("select rec_id, index from chat_records qualify index is null or row_number() over (partition by index order by rec_id) = 1")
def dedup_exact_first(spark, d):
    return dedup.keep_first(chat(spark, d).select("rec_id", "index"), F.col("index"), F.col("rec_id"))


_KEY2 = f"case when index <> 0 then 'i' || index when len(list_filter(messages, lambda m: m.role = 'user')) > 0 then md5(coalesce({_first('user')}, '')) end"


@query(f"with k as (select cot_id, {_KEY2} k from cot_pairs) select cot_id from k qualify k is null or row_number() over (partition by k order by cot_id) = 1")
def dedup_index_or_md5(spark, d):
    users = M.of_role(F.col("messages"), "user")
    hashed = F.when(F.size(users) > 0, T.md5_text(F.coalesce(F.get(users, F.lit(0))["content"], F.lit(""))))
    key = F.when(F.col("index") != 0, F.concat(F.lit("i"), F.col("index").cast("string"))).otherwise(hashed)
    rows = table(spark, d, "cot_pairs").select("cot_id", key.alias("k"))
    return dedup.keep_first(rows, F.col("k"), F.col("cot_id")).select("cot_id")


@query("select doc_id from documents qualify row_number() over (partition by left(text, 120) order by doc_id) = 1")
def dedup_prefix120(spark, d):
    rows = table(spark, d, "documents").select("doc_id", T.head(F.col("text"), 120).alias("k"))
    return dedup.keep_first(rows, F.col("k"), F.col("doc_id"), null_keys="group").select("doc_id")


@query(f"select page_id from scrape_pages where len(list_filter(solutions, lambda s: length(s) > 150 and length(s) < 15000)) > 0 qualify row_number() over (partition by regexp_replace(lower(left(problem, 120)), '[{_WS}]+', ' ', 'g') order by page_id) = 1")
def dedup_norm_prefix(spark, d):
    pages = table(spark, d, "scrape_pages")
    usable = pages.filter(F.size(F.filter("solutions", lambda s: (F.length(s) > 150) & (F.length(s) < 15000))) > 0)
    rows = usable.select("page_id", T.collapse_space(F.lower(T.head(F.col("problem"), 120))).alias("k"))
    return dedup.keep_first(rows, F.col("k"), F.col("page_id"), null_keys="group").select("page_id")


_MERGE = f"with m as (select row_id ord, {_strip('messages[1].content')} p, coalesce({_strip('messages[2].content')}, '') s from merge_rows where len(messages) >= 2)"


def mergeable(spark, d):
    rows = table(spark, d, "merge_rows").filter(F.size("messages") >= 2)
    return rows, M.positional(F.col("messages"), 0), F.coalesce(M.positional(F.col("messages"), 1), F.lit(""))


@query(_MERGE + " select p problem, min(ord) first_order, arg_min(ord, (-length(s), ord)) row_order, arg_min(s, (-length(s), ord)) solution from m group by p")
def merge_longest(spark, d):
    rows, problem, solution = mergeable(spark, d)
    return dedup.merge_longest(rows, problem, solution, "row_id")


@query(_MERGE + ", w as (select length(s) n, max(length(s)) over (partition by p order by ord rows between unbounded preceding and 1 preceding) m from m) select count(*) filter (m is null) n_new, count(*) filter (n > m) n_replaced, count(*) filter (n <= m) n_kept from w")
def merge_counters(spark, d):
    rows, problem, solution = mergeable(spark, d)
    return dedup.merge_counters(rows, problem, solution, "row_id")


_PREFIX = M.PROBLEM_PREFIX.replace("\n", "' || chr(10) || '")
_Q = f"left('{_PREFIX}' || {_strip(_first('user'))}, 120)"


@query(f"""with r as (select rec_id, c.trust_rank pr, {_Q} k from chat_records join source_catalog c using (source) where {_first('user')} is not null),
f as (select * from r qualify row_number() over (partition by k order by pr, rec_id) = 1)
select rec_id from f where k not in (select left('{_PREFIX}' || {_strip('problem')}, 120) from dpo_pairs where problem is not null)""")
def priority_merge(spark, d):
    ranks = table(spark, d, "source_catalog").select("source", "trust_rank")
    prefixed = lambda c: T.head(F.concat(F.lit(M.PROBLEM_PREFIX), T.strip(c)), 120)
    rows = chat(spark, d).join(ranks, "source").select("rec_id", "trust_rank", prefixed(M.first_content(F.col("messages"), "user")).alias("k")).filter("k is not null")
    existing = table(spark, d, "dpo_pairs").select(prefixed(F.col("problem")).alias("k")).filter("k is not null").distinct()
    return dedup.keep_first(rows.join(existing, "k", "left_anti"), F.col("k"), F.col("trust_rank"), F.col("rec_id")).select("rec_id")


@query(f"select count(distinct {_PROBLEM}) n_problems, count(*) n_records from chat_records")
def count_problems(spark, d):
    return chat(spark, d).select(M.problem_text(F.col("messages")).alias("p")).agg(F.count_distinct("p").alias("n_problems"), F.count("*").alias("n_records"))


@query("select source, url from merge_rows m where url is not null and not exists (select 1 from scrape_pages s where s.url = m.url)")
def urls_not_cached(spark, d):
    return table(spark, d, "merge_rows").select("source", "url").filter("url is not null").join(table(spark, d, "scrape_pages").select("url"), "url", "left_anti").select("source", "url")


@query("select distinct left(messages[1].content, 120) k from chat_records where messages[1].content is not null")
def existing_keys(spark, d):
    return chat(spark, d).select(M.pair_key(F.col("messages")).alias("k")).filter("k is not null").distinct()


@query("select url, count(*) n from (select url from merge_rows union select url from scrape_pages) where url is not null group by url")
def url_union(spark, d):
    urls = table(spark, d, "merge_rows").select("url").union(table(spark, d, "scrape_pages").select("url")).distinct()
    return urls.filter("url is not null").groupBy("url").agg(F.count("*").alias("n"))


# --- audit, routing, scores ------------------------------------------------------------------------

_A = f"coalesce({_first('assistant')}, '')"


def _flags_sql(p: Q.Profile) -> str:
    flags = [("index is null", "MISSING_INDEX")] if p.missing_index else []
    flags += [(f"length(a) < {p.least_chars}", "TOO_SHORT"), (r"not contains(a, '\boxed')", "NO_BOXED"), (_any("lower(a)", p.refuting), "REFUTES_PROBLEM"), (_any("lower(a)", p.doubting), "SELF_DOUBTING")]
    if p.final_marks:
        flags.append((r"len(regexp_extract_all(a, '\\boxed\{')) > 2", "MULTIPLE_ANSWERS"))
        braces = "length(right(a, 120)) - length(replace(right(a, 120), '{0}', ''))"
        flags.append((f"not {_any('a', p.final_marks)} or {braces.format('{')} > {braces.format('}')}", "TRUNCATED"))
    cases = ", ".join(f"case when {c} then '{n}' end" for c, n in flags)
    return f"with t as (select rec_id, index, messages, {_A} a from chat_records), f as (select rec_id, case when messages is null then ['NO_MESSAGES'] else list_filter([{cases}], lambda x: x is not null) end flags from t)"


def audited(spark, d, profile):
    rows = chat(spark, d)
    return rows.select("rec_id", Q.audit_flags(F.col("messages"), profile, F.col("index").isNotNull()).alias("flags"))


_F1, _F2 = _flags_sql(Q.FIRST), _flags_sql(Q.SECOND)


@query(_F1 + " select rec_id, array_to_string(flags, ',') flags from f")
def audit_v1_flags(spark, d):
    return audited(spark, d, Q.FIRST).select("rec_id", F.array_join("flags", ",").alias("flags"))


@query(_F2 + " select rec_id, array_to_string(flags, ',') flags from f")
def audit_v2_flags(spark, d):
    return audited(spark, d, Q.SECOND).select("rec_id", F.array_join("flags", ",").alias("flags"))


@query(_F1 + f" select rec_id, not list_has_any(flags, {list(Q.BLOCKING)}) is_clean, len(flags) > 0 is_flagged from f")
def route_v1(spark, d):
    return audited(spark, d, Q.FIRST).select("rec_id", (~Q.is_blocked(F.col("flags"))).alias("is_clean"), (F.size("flags") > 0).alias("is_flagged"))


@query(_F2 + " select rec_id, case when list_contains(flags, 'TRUNCATED') then 'truncated' when len(list_filter(flags, lambda x: x not in ('NO_BOXED', 'MISSING_INDEX'))) > 0 then 'flagged' else 'clean' end route from f")
def route_v2(spark, d):
    return audited(spark, d, Q.SECOND).select("rec_id", Q.route(F.col("flags")).alias("route"))


@query(_F2 + " select flag, count(*) n, round(count(*) * 100.0 / (select greatest(count(*), 1) from f), 2) percent from (select unnest(flags) flag from f) group by flag")
def flag_histogram(spark, d):
    return Q.flag_histogram(audited(spark, d, Q.SECOND))


@query(f"select cast(sum(length({_A})) // count(*) as bigint) mean_chars, cast(max(length({_A})) as bigint) max_chars, count(*) n from chat_records where messages is not null")
def length_stats(spark, d):
    rows = chat(spark, d).filter("messages is not null").select(F.length(F.coalesce(M.first_content(F.col("messages"), "assistant"), F.lit(""))).alias("n"))
    return rows.agg(F.expr("sum(n) div count(n)").alias("mean_chars"), F.max("n").cast("bigint").alias("max_chars"), F.count("*").alias("n"))


_SCORED = f"""with p0 as (select rec_id ord, source, {_strip(f"coalesce({_first('user')}, '')")} u0, {_strip(f"coalesce({_first('assistant')}, '')")} a0 from chat_records),
p1 as (select ord, source, {_strip(f"regexp_replace(u0, '^(?i:problem):[{_WS}]*', '')")} u, {_strip(f"regexp_replace(a0, '^(?i:solution):[{_WS}]*', '')")} a from p0 where u0 <> '' and a0 <> ''),
p2 as (select *, len(regexp_extract_all(a, '[^{_WS}]+')) wc, contains(a, '\\boxed{{') boxed, {_any("lower(right(a, 300))", Q.ENDINGS)} ends, {_any("lower(right(a, 100))", Q.CUTS)} cut from p1),
s as (select *, case when not cut and ((wc >= 120 and ends) or (wc >= 80 and boxed)) then 'good' else 'broken' end quality, sha256(lower(regexp_replace(u, '[{_WS}]+', ' ', 'g'))) h from p2),
pool as (select * from s qualify row_number() over (partition by h, quality order by wc desc, ord) = 1)
"""


@query(_SCORED + "select ord rec_id, quality, wc word_count, boxed has_boxed, ends has_ending, cut seems_truncated from s")
def score_solution(spark, d):
    return O.scored(chat(spark, d)).select(F.col("ord").alias("rec_id"), "quality", F.col("word_count").cast("bigint").alias("word_count"), "has_boxed", "has_ending", "seems_truncated")


@query(_SCORED + "select h, quality, ord rec_id, wc word_count, source, boxed has_boxed from pool")
def pools_best(spark, d):
    return O.pools(O.best_of_problem(O.scored(chat(spark, d)), "source", "has_boxed")).select("h", "quality", F.col("ord").alias("rec_id"), F.col("word_count").cast("bigint").alias("word_count"), "source", "has_boxed")


@query(_SCORED + "select h, ord rec_id from pool where quality = 'broken' and h not in (select h from pool where quality = 'good')")
def broken_only(spark, d):
    return O.broken_only(O.best_of_problem(O.scored(chat(spark, d)))).select("h", F.col("ord").alias("rec_id"))


@query(_SCORED + "select g.u problem, g.a chosen, b.a rejected, g.source chosen_source, b.source rejected_source from pool g join pool b using (h) where g.quality = 'good' and b.quality = 'broken'")
def dpo_pairs_built(spark, d):
    return O.preference_pairs(O.best_of_problem(O.scored(chat(spark, d)), "user", "assistant", "source"))


@query(_SCORED + "select source source_file, count(*) filter (quality = 'good') good_unique, count(*) filter (quality = 'broken') broken_unique from pool group by source")
def source_report(spark, d):
    return O.source_report(O.pools(O.best_of_problem(O.scored(chat(spark, d)), "source")))


@query(_SCORED + """, n as (select source, count(*) total from chat_records group by source), k as (select source, count(*) filter (quality = 'good') good, count(*) filter (quality = 'broken') broken from s group by source)
select n.source, total, coalesce(good, 0) good, coalesce(broken, 0) broken, total - coalesce(good, 0) - coalesce(broken, 0) skipped, case when good + broken > 0 then round(100.0 * good / (good + broken), 2) end good_percent from n left join k on n.source is not distinct from k.source""")
def file_report(spark, d):
    rows = chat(spark, d)
    return O.file_report(rows, O.scored(rows))


@query("select distinct file_name from raw_lines where not contains(lower(file_name), 'merged') and file_name not in ('larch_0000.jsonl', 'quern_0000.jsonl')")
def file_exclusion(spark, d):
    files = table(spark, d, "raw_lines").select("file_name").distinct()
    return files.filter(O.usable_file(F.col("file_name"), ["larch_0000.jsonl", "quern_0000.jsonl"]))


@query("select r.source, coalesce(c.category, 'unknown') category, count(*) n from chat_records r left join source_catalog c using (source) group by all")
def file_category(spark, d):
    return O.file_category(chat(spark, d).select("source"), table(spark, d, "source_catalog")).groupBy("source", "category").agg(F.count("*").alias("n"))


# --- projections and templates ---------------------------------------------------------------------


@query(f"select rec_id, {_first('user')} first_user, {_last('assistant')} last_assistant, {_strip('messages[1].content')} m0, {_strip('messages[2].content')} m1 from chat_records")
def role_projections(spark, d):
    m = F.col("messages")
    return chat(spark, d).select("rec_id", M.first_content(m, "user").alias("first_user"), M.last_content(m, "assistant").alias("last_assistant"), M.positional(m, 0).alias("m0"), M.positional(m, 1).alias("m1"))


_SYS = M.SYSTEM_PROMPT.replace("'", "''")
_NL = "' || chr(10) || '"
_TRAIN = f"""with t as (select rec_id, messages, {_strip(f"coalesce({_first('user')}, 'None')")} u, {_strip(f"coalesce({_last('assistant')}, 'None')")} a, len(list_filter(messages, lambda m: m.role = 'user')) nu, len(list_filter(messages, lambda m: m.role = 'assistant')) na from chat_records),
c as (select rec_id, u, a, '<|im_start|>system{_NL}{_SYS.replace(chr(10), _NL)}{_NL}<|im_end|>{_NL}<|im_start|>user{_NL}Problem:{_NL}' || u || '{_NL}<|im_end|>{_NL}<|im_start|>assistant{_NL}Solution:{_NL}' || a || '{_NL}<|im_end|>' t from t where len(messages) >= 2 and nu > 0 and na > 0 and u <> '' and a <> '')
"""


@query(_TRAIN + "select rec_id, md5(t) text_md5, length(t) n from c")
def chatml_training(spark, d):
    rows = chat(spark, d).select("rec_id", M.chatml_training(F.col("messages")).alias("t")).filter("t is not null")
    return rows.select("rec_id", T.md5_text(F.col("t")).alias("text_md5"), F.length("t").cast("bigint").alias("n"))


def _part_sql(role: str) -> str:
    return _strip(rf"regexp_extract(t, '(?s)<\|im_start\|>{role}\n(.*?)<\|im_end\|>', 1)")


@query(_TRAIN + f"select rec_id, {_part_sql('system')} system_text, {_part_sql('user')} user_text, md5({_part_sql('assistant')}) assistant_md5 from c")
def chatml_parts(spark, d):
    rows = chat(spark, d).select("rec_id", M.chatml_training(F.col("messages")).alias("t")).filter("t is not null")
    p = M.parts(F.array().cast("array<struct<role:string,content:string>>"), F.col("t"))
    return rows.select("rec_id", p.alias("p")).select("rec_id", F.col("p.system").alias("system_text"), F.col("p.user").alias("user_text"), T.md5_text(F.col("p.assistant")).alias("assistant_md5"))


@query(_TRAIN + f"select rec_id, md5('[gMASK]<sop><|system|>{_NL}' || {_part_sql('system')} || '{_NL}<|user|>{_NL}' || {_part_sql('user')} || '{_NL}<|assistant|>{_NL}Solution:{_NL}' || {_part_sql('assistant')} || '<|endoftext|>') text_md5 from c")
def native_template(spark, d):
    rows = chat(spark, d).select("rec_id", M.chatml_training(F.col("messages")).alias("t")).filter("t is not null")
    return rows.select("rec_id", T.md5_text(M.native_template(F.col("t"))).alias("text_md5"))


@query(f"select rec_id, '{_PREFIX}' || {_strip(_first('user'))} prompt, {_strip(_first('assistant'))} answer from chat_records where {_first('user')} <> '' and length({_first('assistant')}) >= 200 and not (contains({_first('assistant')}, '```python') and contains({_first('assistant')}, 'sympy')) and not contains({_first('assistant')}, 'Traceback') and not contains({_first('assistant')}, 'Error')")
def training_pairs(spark, d):
    m = F.col("messages")
    q, a = M.first_content(m, "user"), M.first_content(m, "assistant")
    rows = chat(spark, d).filter(Q.is_valid(q, a, 200)).select("rec_id", M.training_pair(q, a).alias("pair"))
    return rows.select("rec_id", F.col("pair")[0]["content"].alias("prompt"), F.col("pair")[1]["content"].alias("answer"))


@query("select rec_id from chat_records where contains(lower(source), 'cot_') or contains(lower(source), 'forum')")
def source_filter(spark, d):
    return chat(spark, d).filter(T.any_of(F.lower("source"), ("cot_", "forum"))).select("rec_id")


@query(f"select cot_id, length({_A}) // 4 n_estimated, greatest(800, least(3000, 3800 - length({_A}) // 4)) budget from cot_pairs")
def token_budget(spark, d):
    a = F.coalesce(M.first_content(F.col("messages"), "assistant"), F.lit(""))
    return table(spark, d, "cot_pairs").select("cot_id", T.estimate_tokens(a).cast("bigint").alias("n_estimated"), T.answer_budget(a).cast("bigint").alias("budget"))


# --- order, limits, resuming -----------------------------------------------------------------------


@query("select lang, doc_id from documents qualify row_number() over (partition by lang order by fetched_at, doc_id) <= 10")
def top10_per_group(spark, d):
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("fetched_at", "doc_id"))
    return table(spark, d, "documents").select("lang", "doc_id", "fetched_at").withColumn("nth", nth).filter("nth <= 10").select("lang", "doc_id")


@query("select doc_id from (select doc_id, text from documents qualify row_number() over (partition by left(text, 120) order by doc_id) = 1) where length(text) >= 200 order by doc_id limit 5000")
def limit_after_dedup(spark, d):
    rows = table(spark, d, "documents").select("doc_id", T.head(F.col("text"), 120).alias("k"), F.length("text").alias("n"))
    return dedup.keep_first(rows, F.col("k"), F.col("doc_id"), null_keys="group").filter("n >= 200").select("doc_id").orderBy("doc_id").limit(5000)


@query("select cot_id from cot_pairs where index is null or index not in (select try_cast(index as bigint) from chat_records where try_cast(index as bigint) is not null)")
def checkpoint_resume(spark, d):
    done = chat(spark, d).select(F.col("index").try_cast("bigint").alias("index")).filter("index is not null")
    return incremental.remaining(table(spark, d, "cot_pairs").select("cot_id", "index"), done).select("cot_id")


@query("select page_id, row_number() over (order by page_id) - 1 ordinal from scrape_pages")
def ordinal_index(spark, d):
    return dedup.with_ordinal(table(spark, d, "scrape_pages").select("page_id"), "page_id")


# --- scraping and extraction -----------------------------------------------------------------------


@query("select source contest, y as \"year\", n, 'https://' || source || '.example/' || y || '/p' || n url from source_catalog, (select unnest(range(2010, 2024)) y), (select unnest(range(1, 7)) n)")
def url_grid(spark, d):
    contests = table(spark, d, "source_catalog").select(F.col("source").alias("contest"), F.concat(F.lit("https://"), "source", F.lit(".example/{year}/p{n}")).alias("template"), F.lit("2010-2023").alias("years"), F.lit(6).alias("n_problems"))
    first, last = crawl.year_range(F.col("years"))
    grid = crawl.contest_grid(contests.withColumn("from_year", first).withColumn("to_year", last))
    return grid.select("contest", F.col("year").cast("bigint").alias("year"), F.col("n").cast("bigint").alias("n"), "url")


@query("with u as (select page_id, generate_subscripts(solutions, 1) k, unnest(solutions) s from scrape_pages) select page_id, arg_min(s, (-length(s), k)) solution from u where length(s) > 150 and length(s) < 15000 group by page_id")
def longest_solution(spark, d):
    fit = F.filter("solutions", lambda s: (F.length(s) > 150) & (F.length(s) < 15000))
    return table(spark, d, "scrape_pages").select("page_id", extract.longest(fit).alias("solution")).filter("solution is not null")


@query("select url, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) path, regexp_extract(url, '([^/]*)$', 1) file_name from scrape_pages")
def url_parts(spark, d):
    path = F.parse_url("url", F.lit("PATH"))
    return table(spark, d, "scrape_pages").select("url", path.alias("path"), F.substring_index(path, "/", -1).alias("file_name"))


def _tex_sql(c: str) -> str:
    """The rewriting in the SQL engine, which has no look-ahead: a letter after the macro is captured instead, twice for neighbours."""
    for pattern, replacement in extract.MACROS:
        to = replacement.replace("$1", r"\1")
        if "(?![a-zA-Z])" in pattern:
            pattern, to = pattern.replace("(?![a-zA-Z])", "([^a-zA-Z]|$)"), to + r"\1"
            c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
        quoted = to.replace("\n", "' || chr(10) || '")
        c = f"regexp_replace({c}, '{pattern}', '{quoted}', 'g')"
    return _strip(f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"select page_id, part, {_tex_sql('s')} \"text\" from (select page_id, generate_subscripts(solutions, 1) - 1 part, unnest(solutions) s from scrape_pages)")
def tex_clean(spark, d):
    pages = table(spark, d, "scrape_pages").select("page_id", F.posexplode("solutions").alias("part", "s"))
    return pages.select("page_id", F.col("part").cast("bigint").alias("part"), extract.clean_tex(F.col("s")).alias("text"))


_BEST = "arg_min(s, (-length(s), k))"
_SOLVED = "(select page_id, problem, generate_subscripts(solutions, 1) k, unnest(solutions) s from scrape_pages)"
_PAIR = f"'{_PREFIX}' || {_strip('problem')} prompt"


@query(f"select page_id, {_PAIR}, {_BEST} answer from {_SOLVED} where {_strip('problem')} <> '' group by page_id, problem having length({_BEST}) >= 200")
def scrape_training(spark, d):
    rows = stages.scrape_training(table(spark, d, "scrape_pages"))
    return rows.select("page_id", F.col("messages")[0]["content"].alias("prompt"), F.col("messages")[1]["content"].alias("answer"))


@query(f"""with b as (select page_id, {_strip('problem')} p, {_BEST} answer from {_SOLVED} where length(s) > 150 and length(s) < 15000 group by page_id, problem)
select page_id, '{_PREFIX}' || p prompt, answer from b where p <> '' qualify row_number() over (partition by regexp_replace(lower(left(p, 120)), '[{_WS}]+', ' ', 'g') order by page_id) = 1""")
def scrape_training_distinct(spark, d):
    rows = stages.scrape_training_distinct(table(spark, d, "scrape_pages"), order="page_id")
    return rows.select("page_id", F.col("messages")[0]["content"].alias("prompt"), F.col("messages")[1]["content"].alias("answer"))


_VALID = "q <> '' and length(s) >= 200 and not (contains(s, '```python') and contains(s, 'sympy')) and not contains(s, 'Traceback') and not contains(s, 'Error')"
_NEW = f"""with r as (select rec_id, coalesce(contains(lower(source), 'cot_') or contains(lower(source), 'forum'), false) wanted, {_first('user')} q, {_first('assistant')} s from chat_records),
j as (select *, coalesce({_VALID}, false) valid, left('{_PREFIX}' || {_strip('q')}, 120) k from r),
e as (select left('{_PREFIX}' || {_strip('problem')}, 120) k from dpo_pairs where problem is not null),
f as (select * from j where wanted and valid and k not in (select k from e) qualify row_number() over (partition by k order by rec_id) = 1)
"""


def downloaded(spark, d, most=None):
    m = F.col("messages")
    existing = table(spark, d, "dpo_pairs").filter("problem is not null").select(T.head(F.concat(F.lit(M.PROBLEM_PREFIX), T.strip(F.col("problem"))), 120).alias("k"))
    return stages.new_entries(chat(spark, d), existing, order="rec_id", question=M.first_content(m, "user"), solution=M.first_content(m, "assistant"), source=F.col("source"), sources=("cot_", "forum"), least=200, most=most)


@query(_NEW + "select (select count(*) from f) n_new, count(*) filter (wanted and valid) - (select count(*) from f) n_dupes, count(*) filter (wanted and not valid) n_invalid, count(*) filter (not wanted) n_other from j")
def download_counters(spark, d):
    return downloaded(spark, d)[1]


@query(_NEW + "select rec_id from f order by rec_id limit 5000")
def download_entries(spark, d):
    """At most 5,000 new entries, the stage's own limit."""
    return downloaded(spark, d, 5000)[0].select(F.col("ord").alias("rec_id"))


@query(_SCORED + """, g as (select distinct h from pool where quality = 'good'), b as (select distinct h from pool where quality = 'broken')
select count(*) n_examples, count(*) filter (quality = 'good') n_good, count(*) filter (quality = 'broken') n_broken, (select count(*) from g) n_good_problems,
(select count(*) from b where h not in (select h from g)) n_broken_only, (select count(*) from b where h in (select h from g)) n_pairs from s""")
def organize_counters(spark, d):
    rows = O.scored(chat(spark, d))
    return stages.counters(rows, O.best_of_problem(rows))


@query(_F1 + " select rec_id from f where list_has_any(flags, ['TOO_SHORT', 'REFUTES_PROBLEM'])")
def flag_filter_v1(spark, d):
    return audited(spark, d, Q.FIRST).filter(F.arrays_overlap("flags", F.array(F.lit("TOO_SHORT"), F.lit("REFUTES_PROBLEM")))).select("rec_id")


_PARTIAL = f"regexp_replace(messages[2].content, '[{_WS}]+$', '')"
_LINE = "' || chr(10) || '"


@query(f"""select cot_id, 'Problem:{_LINE}' || messages[1].content || '{_LINE}{_LINE}Original solution:{_LINE}' || messages[2].content restructure,
messages[1].content || '{_LINE}{_LINE}A solution has been partially written below. Continue it seamlessly from exactly where it cuts off. Do NOT repeat anything already written.{_LINE}{_LINE}--- PARTIAL SOLUTION (do not repeat) ---{_LINE}' || {_PARTIAL} continuation from cot_pairs""")
def prompts(spark, d):
    first, second = (F.get("messages", F.lit(i))["content"] for i in (0, 1))
    return table(spark, d, "cot_pairs").select("cot_id", M.restructure_prompt(first, second).alias("restructure"), M.continue_prompt(first, second).alias("continuation"))


@query(f"""with w as (select doc_id, list_transform(regexp_extract_all(text, '[^{_WS}]+'), lambda x: length(x)) ids from documents),
p as (select *, list_max(list_filter(range(1, len(ids)), lambda i: ids[i] = 2 and ids[i + 1] = 3)) place from w),
m as (select doc_id, ids, case when place is null then list_transform(ids, lambda x: -100) else list_transform(ids, lambda x, i: case when i < place + 2 then -100 else x end) end labels from p)
select doc_id, len(ids) n, cast(list_sum(labels) as bigint) label_sum, len(list_filter(labels, lambda x: x <> -100)) trainable from m where len(ids) > 0""")
def completion_mask(spark, d):
    """Masking with the lengths of words as tokens and two of them as the template."""
    ids = F.transform(F.regexp_extract_all("text", F.lit(f"[^{T.WS}]+"), F.lit(0)), F.length)
    rows = table(spark, d, "documents").select("doc_id", ids.alias("ids")).filter("size(ids) > 0").select("doc_id", "ids", M.completion_labels(F.col("ids"), [2, 3]).alias("labels"))
    total = F.aggregate("labels", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n"), total.alias("label_sum"), M.trainable_tokens(F.col("labels")).cast("bigint").alias("trainable"))


_PIECE_SQL = "regexp_replace({}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


@query(f"""with t as (select page_id, {_strip(_PIECE_SQL.format('problem'))} p, list_filter(list_transform(solutions, lambda s: {_strip(_PIECE_SQL.format('s'))}), lambda x: length(x) > 100 and (contains(x, '$') or regexp_matches(lower(x), 'proof|solution'))) ss from scrape_pages)
select cast(page_id as varchar) url, p problem, len(ss) n, md5(array_to_string(ss, chr(1))) text_md5 from t where p <> '' and len(ss) > 0""")
def thread_pairs_rebuilt(spark, d):
    """All scraped pages as thread pages of a forum, and the pairs read back from their markup."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    posts = F.array_join(F.transform(F.coalesce("solutions", F.array().cast("array<string>")), lambda s: F.concat(F.lit('<p>by <b>x</b></p><span class="a post_text">'), escaped(s), F.lit("</span>"))), "")
    page = F.concat(F.lit('<html><div class="cmty-post-body">'), escaped(F.coalesce("problem", F.lit(""))), F.lit("</div>"), posts, F.lit("</html>"))
    pages = table(spark, d, "scrape_pages").select(F.col("page_id").cast("string").alias("url"), page.alias("page"))
    return extract.thread_pairs(pages).select("url", "problem", F.size("solutions").cast("bigint").alias("n"), T.md5_text(F.array_join("solutions", "\x01")).alias("text_md5"))


_CUT_SQL = "regexp_replace(x, '(?s)(\\nSee [Aa]lso\\b|\\n==).*$', '')"


@query(f"""with t as (select page_id, {_strip(_PIECE_SQL.format('problem'))} p, list_filter(list_transform(solutions, lambda s: {_strip(_PIECE_SQL.format('s'))}), lambda x: length(x) > 100) s1 from scrape_pages),
c as (select page_id, p, list_filter(list_transform(s1, lambda x: {_strip(_CUT_SQL)}), lambda x: length(x) > 100) ss from t)
select cast(page_id as varchar) url, p problem, len(ss) n, md5(array_to_string(ss, chr(1))) text_md5 from c where p <> '' and len(ss) > 0""")
def wiki_pairs_rebuilt(spark, d):
    """All scraped pages as wiki pages, and the pairs read back from their markup and headings."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    part = lambda title, c: F.concat(F.lit("<h2>"), title, F.lit("</h2><p>"), escaped(c), F.lit("</p>"))
    given = F.coalesce("solutions", F.array().cast("array<string>"))
    solutions = F.array_join(F.transform(given, lambda s, k: part(F.concat(F.lit("Solution "), (k + 1).cast("string")), s)), "")
    page = F.concat(F.lit('<html><p>no</p><div id="mw-content-text">'), part(F.lit("Problem"), F.coalesce("problem", F.lit(""))), solutions, F.lit("<h2>See also</h2><p>more</p></div></html>"))
    pages = extract.page_texts(table(spark, d, "scrape_pages").select(F.col("page_id").cast("string").alias("url"), page.alias("html")))
    return extract.wiki_pairs(pages).select("url", "problem", F.size("solutions").cast("bigint").alias("n"), T.md5_text(F.array_join("solutions", "\x01")).alias("text_md5"))


_TEX_FILE = r"'x\subsection{P}' || chr(10) || '\begin{problem}' || problem || '\end{problem}' || s || '\newpage more'"
_BOX = r"(?is)\\begin\{problem\}(.*?)\\end\{problem\}"
_END = extract.SOLUTION_END.removeprefix("(?i)")


@query(f"""with f as (select page_id, generate_subscripts(solutions, 1) - 1 part, problem, unnest(solutions) s from scrape_pages),
b as (select page_id, part, unnest(string_split(file, '\\subsection{{')) body, generate_subscripts(string_split(file, '\\subsection{{'), 1) - 1 block from (select page_id, part, {_TEX_FILE} file from f)),
m as (select page_id || '/' || part source, block, regexp_extract(body, '{_BOX}', 1) p, regexp_extract(body, '{_BOX}(.*)$', 2) r from b where block > 0 and regexp_matches(body, '{_BOX}')),
c as (select source, block, {_tex_sql(_strip('p'))} problem, {_tex_sql(f"regexp_replace(r, '(?is)({_END}).*$', '')")} solution from m)
select source, block, '{_PREFIX}' || {_strip('problem')} prompt, {_strip('solution')} answer from c where length(problem) >= 40 and length(solution) >= 80""")
def tex_pairs_rebuilt(spark, d):
    """All scraped solutions as TeX files with a boxed problem, and the training pairs read back from them."""
    each = table(spark, d, "scrape_pages").select("page_id", "problem", F.posexplode("solutions").alias("part", "s"))
    text = F.concat(F.lit("x\\subsection{P}\n\\begin{problem}"), "problem", F.lit("\\end{problem}"), "s", F.lit("\\newpage more"))
    files = each.select(F.concat_ws("/", F.col("page_id").cast("string"), F.col("part").cast("string")).alias("source"), text.alias("text"))
    rows = stages.tex_training(files, with_source=True)
    return rows.select("source", F.col("block").cast("bigint").alias("block"), F.col("messages")[0]["content"].alias("prompt"), F.col("messages")[1]["content"].alias("answer"))


@query(f"select rec_id, source, coalesce(len(messages), -1) n, md5(coalesce({_first('user')}, '')) user_md5 from chat_records")
def jsonl_roundtrip(spark, d):
    """All records written as JSON Lines to the shared folder and read back through the repair ladder."""
    path = f"{shared_folder(spark)}/jsonl-{uuid.uuid4().hex}"
    jsonl.write_jsonl(chat(spark, d).select("rec_id", "source", "messages"), path)
    rows = jsonl.with_record(jsonl.repair_lines(jsonl.read_lines(spark, path))).filter("parse_error is null")
    rec_id = F.try_variant_get(F.try_parse_json("raw"), "$.rec_id", "bigint")
    user = F.coalesce(M.first_content(F.col("messages"), "user"), F.lit(""))
    return rows.select(rec_id.alias("rec_id"), "source", F.coalesce(F.size("messages"), F.lit(-1)).cast("bigint").alias("n"), T.md5_text(user).alias("user_md5"))


@query()
def json_repair(spark, d):
    """The repair ladder over all raw JSON lines: objects and errors."""
    lines = table(spark, d, "raw_lines").filter("fmt = 'jsonl' and trim(line) <> ''").select("line_id", "line")
    return jsonl.with_record(jsonl.repair_lines(lines)).select("line_id", "sub_object", jsonl.index_key(F.col("raw")).alias("index_key"), F.size("messages").alias("n_messages"), "parse_error")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
