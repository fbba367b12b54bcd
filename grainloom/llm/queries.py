"""Queries of the training-text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.llm import canonical, contamination, markup, mixing, pairs, repetition, spans, survivor, truncation
from grainloom.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, _ = truncation.cut_contents(table(spark, sf_dir, "chat_records"))
    return cut.select(F.col("row_id").alias("rec_id")).distinct()


def p1_source_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.source_shares(table(spark, sf_dir, "chat_records"))


def p1_field_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_contents(table(spark, sf_dir, "chat_records"))[1]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = pairs.broken_pairs(table(spark, sf_dir, "cot_pairs"), table(spark, sf_dir, "documents"))
    return broken.withColumnRenamed("row_id", "cot_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = canonical.formatting_duplicates(table(spark, sf_dir, "chat_records"))
    return groups.filter("row_id <> keep_id").select("keep_id", F.col("row_id").alias("copy_id"))


def p4_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = canonical.formatting_duplicates(table(spark, sf_dir, "chat_records"))
    return groups.filter("row_id = keep_id").select(F.col("keep_id").alias("rec_id"), "n_copies")


def generated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = table(spark, sf_dir, "chat_records").select(F.lit("chat_records").alias("tab"), F.col("rec_id").alias("row_id"), F.posexplode("messages").alias("part", "m"))
    chat = chat.filter("m.role = 'assistant'").select("tab", "row_id", "part", F.col("m.content").alias("text"))
    pairs = table(spark, sf_dir, "dpo_pairs").select(F.lit("dpo_pairs").alias("tab"), F.col("pair_id").alias("row_id"), F.lit(0).alias("part"), F.col("chosen").alias("text"))
    return chat.unionByName(pairs)


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = repetition.measure_repetition(generated_texts(spark, sf_dir), keys=("tab", "row_id", "part"))
    return shares.select("tab", "row_id", F.col("part").cast("bigint").alias("part"), "n_words", "n_repeated", F.round("repeated_share", 6).alias("repeated_share"))


def p5_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure_repetition(generated_texts(spark, sf_dir), keys=("tab", "row_id", "part"), banded_only=True)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = p5_bands(spark, sf_dir).filter("band in ('repetitive', 'unsure') and repeated_share >= 0.35")
    return cases.select("tab", "row_id").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.surviving_rows(table(spark, sf_dir, "merge_rows"), table(spark, sf_dir, "source_catalog"), values=False)


def p6_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.survivors(table(spark, sf_dir, "merge_rows"), table(spark, sf_dir, "source_catalog"))


def p6_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.transitions(survivor.url_values(table(spark, sf_dir, "merge_rows")))


def marked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = table(spark, sf_dir, "chat_records").select(F.lit("chat_records").alias("tab"), F.col("rec_id").alias("row_id"), F.col("source").alias("host"), F.posexplode("messages").alias("part", "m"))
    chat = chat.select("tab", "row_id", "part", "host", F.col("m.content").alias("text"))
    pages = table(spark, sf_dir, "scrape_pages").select(F.lit("scrape_pages").alias("tab"), F.col("page_id").alias("row_id"), F.regexp_extract("url", "//([^/]*)", 1).alias("host"), F.posexplode("solutions").alias("part", "text"))
    return chat.unionByName(pages)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds, _ = markup.markup_kinds(marked_texts(spark, sf_dir), keys=("tab", "row_id", "part"))
    return kinds.select("tab", "row_id", F.explode("kinds").alias("kind")).distinct()


def p7_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.wrapper_expressions(markup.markup_kinds(marked_texts(spark, sf_dir), keys=("tab", "row_id", "part"))[1])


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_texts(marked_texts(spark, sf_dir), keys=("tab", "row_id", "part"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = p8_found(spark, sf_dir)
    return found.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("item_id")), ",").alias("items"), F.count_distinct("item_id").alias("n_items"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.reached_shares(p9_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.sharing_pairs(table(spark, sf_dir, "documents"))


def p10_portions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_portions(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


# The canonical text in SQL: RE2 has no look-around, so a mark between digits is set aside as U+0001 and
# U+0002 in two passes (overlapping neighbours), and upper() is applied first for the sharp s.
_CANON = r"""replace(replace(regexp_replace(replace(lower(upper(
regexp_replace(regexp_replace(regexp_replace(regexp_replace({t}, '(\p{Nd})[.](\p{Nd})', '\1' || chr(1) || '\2', 'g'), '(\p{Nd})[.](\p{Nd})', '\1' || chr(1) || '\2', 'g'),
'(\p{Nd}),(\p{Nd})', '\1' || chr(2) || '\2', 'g'), '(\p{Nd}),(\p{Nd})', '\1' || chr(2) || '\2', 'g'))), 'ß', 'ss'),
'[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,;:!?''"“”‘’…–—]', '', 'g'), chr(1), '.'), chr(2), ',')"""

_P4 = f"""with m as (select rec_id, extra, generate_subscripts(messages, 1) k, unnest(messages) u from chat_records where messages is not null),
c as (select rec_id, extra, list(struct_pack(r := u.role, c := {_CANON.replace("{t}", "u.content")}) order by k) parts from m group by rec_id, extra),
e as (select rec_id, parts, (select list(struct_pack(k := key, v := json_extract(extra, '$."' || key || '"')) order by key) from unnest(json_keys(extra)) t(key)) x, extra is null n from c),
g as (select rec_id, min(rec_id) over (partition by parts, x, n) keep_id, count(*) over (partition by parts, x, n) n_copies from e)
"""

_P5 = r"""with t as (select 'chat_records' tab, rec_id row_id, k part, u.content text from (select rec_id, generate_subscripts(messages, 1) - 1 k, unnest(messages) u from chat_records) where u.role = 'assistant'
union all select 'dpo_pairs', pair_id, 0, chosen from dpo_pairs),
w as (select tab, row_id, part, list_filter(regexp_split_to_array(lower(text), '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> '') ws from t),
g as (select tab, row_id, part, i, row_number() over (partition by tab, row_id, part, ws[i:i+5] order by i) > 1 again from (select *, unnest(range(1, len(ws) - 4)) i from w where len(ws) >= 6)),
c as (select tab, row_id, part, count(distinct j) n from (select tab, row_id, part, unnest(range(i, i + 6)) j from g where again) group by all)
"""

_P8 = r"""with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') ws from documents),
i as (select item_id, regexp_extract_all(lower(unnest([question, solution])), '[\p{L}\p{N}]+') ws from eval_items),
pi as (select distinct item_id, ws[k:k+11] g from (select *, unnest(range(1, len(ws) - 10)) k from i where len(ws) >= 12)),
pd as (select doc_id, ws[k:k+11] g from (select *, unnest(range(1, len(ws) - 10)) k from d where len(ws) >= 12))
select distinct item_id, doc_id from pd join pi using (g)"""


_HOLES = "'', " + ", ".join(f"'{p}'" for p in survivor.PLACEHOLDERS)
_P6 = rf"""with r as (select m.*, trim(list_filter(messages, lambda x: x.role = 'assistant')[1].content, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) sol, trim(final_answer) ans, trim(url) u, coalesce(c.trust_rank, 2147483647) trust
from merge_rows m left join source_catalog c using (source) where index in (select index from merge_rows where index is not null group by 1 having count(*) > 1)),
x as (select index, 'solution' field, row_id, sol v, row_number() over (partition by index order by length(sol) desc, row_id) n from r where lower(sol) not in ({_HOLES})
union all select index, 'final_answer', row_id, ans, row_number() over (partition by index order by trust, row_id) from r where lower(ans) not in ({_HOLES})
union all select index, 'url', row_id, u, row_number() over (partition by index order by updated_at desc, row_id) from r where lower(u) not in ({_HOLES}))
"""


_P6_STEPS = rf"""with v as (select index, row_id, updated_at, trim(url) u from merge_rows where index is not null and updated_at is not null and lower(trim(url)) not in ({_HOLES})),
k as (select index, row_id, updated_at, case when regexp_matches(u, '^[a-z]+://[^/?#]') then regexp_extract(u, '^[a-z]+://([^/?#]+)', 1) else regexp_replace(lower(u), '\p{{Nd}}+', '9', 'g') end kind from v),
s as (select kind a, lead(kind) over (partition by index order by updated_at, row_id) b from k),
p as (select least(a, b) x, greatest(a, b) y, sum(case when a < b then 1 else -1 end) ahead from s where a <> b group by all)
select case when ahead > 0 then x else y end before, case when ahead > 0 then y else x end after from p where ahead <> 0"""

# every window of 400 characters of every text, by its hash
_P10 = """with w as (select distinct doc_id, md5_number_lower(text[k:k + 399]) h from (select doc_id, text, unnest(range(1, length(text) - 398)) k from documents where length(text) >= 400)),
h as (select h from w group by h having count(*) > 1), m as (select doc_id, h from w semi join h using (h))
select distinct a.doc_id doc_a, b.doc_id doc_b from m a join m b on a.h = b.h and a.doc_id < b.doc_id"""

_P10_SHARES = """with t as (select "text", min(doc_id) class_id, count(distinct doc_id) n_copies, length("text") size from documents where "text" is not null group by "text"),
w as (select class_id, k, md5_number_lower("text"[k:k + 399]) h from (select class_id, "text", unnest(range(1, size - 398)) k from t where size >= 400)),
s as (select h from w group by h having count(distinct class_id) > 1), m as (select class_id, k from w semi join s using (h)),
l as (select class_id, least(400, coalesce(lead(k) over (partition by class_id order by k) - k, 400)) n from m), c as (select class_id, sum(n) covered from l group by class_id),
r as (select doc_id, class_id, n_copies, size n_chars, cast(case when n_copies > 1 and size >= 400 then size else coalesce(covered, 0) end as bigint) n_shared from documents join t using ("text") left join c using (class_id))
select *, round(n_shared / greatest(n_chars, 1), 6) share from r"""


def oracle_sql() -> dict[str, str]:
    return {
        "p6_found": _P6 + "select index, field, row_id from x where n = 1",
        "p6_survivors": _P6 + "select index, max(v) filter (field = 'solution') solution, max(v) filter (field = 'final_answer') final_answer, max(v) filter (field = 'url') url from x where n = 1 group by index",
        "p6_transitions": _P6_STEPS,
        "p8_documents": f"with f as ({_P8}) select doc_id, string_agg(cast(item_id as varchar), ',' order by item_id) items, count(*) n_items from f group by doc_id",
        "p10_found": _P10,
        "p10_portions": _P10_SHARES,
        "p4_found": _P4 + "select keep_id, rec_id copy_id from g where rec_id <> keep_id",
        "p4_collapsed": _P4 + "select rec_id, n_copies from g where rec_id = keep_id",
        "p5_found": _P5 + "select distinct c.tab, c.row_id from c join w using (tab, row_id, part) where n >= 0.35 * len(ws)",
        "p5_shares": _P5 + ", s as (select w.tab, w.row_id, w.part, coalesce(len(ws), 0) n_words, coalesce(n, 0) n_repeated from w left join c using (tab, row_id, part)) select *, round(n_repeated / greatest(n_words, 1), 6) repeated_share from s",
        "p8_found": _P8,
    }
