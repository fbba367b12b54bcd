"""The pipeline's stages from paths to paths; ``python -m grainloom`` runs them.

Each stage is a lazy plan with its sinks; counters come with the writes, by observation, so no stage reads
its input a second time to count it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grainloom.functions.text import collapse_space, head, strip
from grainloom.operators import dedup, extract, messages as M, quality as Q
from grainloom.plans import organize as O
from grainloom.session import checkpoint
from grainloom.sources import jsonl


def counted(rows: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows, and what is known of them once they are written: ``n`` and the given aggregates."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in counts.items()]), seen


def first_rows(rows: DataFrame, order: str, n: int | None) -> DataFrame:
    """The first ``n`` rows in order; all of them for 0 or None."""
    return rows.orderBy(order).limit(n) if n else rows


# --- loading ----------------------------------------------------------------------------------------


def load_records(spark: SparkSession, path: str | list[str], *, glob: str | None = None, least_messages: int = 2, strict_parts: bool = False) -> tuple[DataFrame, Observation]:
    """Records of JSON Lines files with ``ord, file, raw`` and their fields, and a count of lines, errors and gated rows.

    Lines that cannot be read and records with fewer messages are left out; the counts (``n``, ``n_errors``,
    ``n_short``) are there after an action on the rows.
    """
    rows = jsonl.with_record(jsonl.repair_lines(jsonl.read_lines(spark, path, glob), strict_parts=strict_parts))
    short = F.coalesce(F.size("messages") < least_messages, F.lit(True)) if least_messages > 0 else F.lit(False)
    bad = F.col("parse_error").isNotNull()
    rows, seen = counted(rows, n_errors=F.count_if(bad), n_short=F.count_if(~bad & short))
    return rows.filter(~bad & ~short), seen


def read_folder(spark: SparkSession, folder: str, raw_files: list[str]) -> DataFrame:
    """Lines of the folder's ``*.jsonl`` files (subfolders not) but the merged and the raw ones; the excluded files are not read."""
    lines = jsonl.read_lines(spark, folder, "*.jsonl")
    return lines.filter(O.usable_file(F.col("file"), raw_files))


def union_splits(*splits: DataFrame) -> DataFrame:
    """Several splits as one table; columns that one of them lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), splits)


def new_entries(rows: DataFrame, existing: DataFrame, *, order: str, question: Column, solution: Column, source: Column | None = None, sources: tuple[str, ...] = (), least: int = 100, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Training pairs of a downloaded table that are not among ``existing`` (keys ``k``), and their counters.

    The first result has ``ord, k, pair`` for the first valid row of each new key, ``most`` of them at most; the
    second is one row ``n_new, n_dupes, n_invalid, n_other`` (rows of other sources) over all rows.
    """
    wanted = F.lit(True) if source is None else F.coalesce(reduce(lambda a, b: a | b, [F.contains(F.lower(source), F.lit(s)) for s in sources]), F.lit(False))
    key = head(F.concat(F.lit(M.PROBLEM_PREFIX), strip(question)), 120)
    judged = rows.select(F.col(order).alias("ord"), question.alias("q"), solution.alias("s"), wanted.alias("wanted"), Q.is_valid(question, solution, least).alias("valid"), key.alias("k"))
    good = judged.filter("wanted and valid")
    fresh = dedup.keep_first(good.join(existing.select("k").distinct(), "k", "left_anti"), F.col("k"), F.col("ord"))
    pairs = first_rows(fresh.select("ord", "k", M.training_pair(F.col("q"), F.col("s")).alias("pair")), "ord", most)
    counts = judged.agg(F.count_if(F.expr("wanted and valid")).alias("n_good"), F.count_if(F.expr("wanted and not valid")).alias("n_invalid"), F.count_if(F.expr("not wanted")).alias("n_other"))
    taken = fresh.agg(F.count("*").alias("n_new"))
    # two tables of one row each
    return pairs, counts.join(taken, F.lit(True)).select("n_new", (F.col("n_good") - F.col("n_new")).alias("n_dupes"), "n_invalid", "n_other")


# --- exclusion and repair ---------------------------------------------------------------------------


def exclude(spark: SparkSession, large: str, small: str, output: str) -> dict[str, int]:
    """Records of ``large`` whose problem is not in ``small``, as they were; counts of kept and skipped."""
    big, n_big = load_records(spark, large, least_messages=0)
    few, _ = load_records(spark, small, least_messages=0)
    kept, n_kept = counted(dedup.exclude_by_key(big, few, M.problem_text(F.col("messages"))))
    jsonl.write_raw(kept, output)
    read = n_big.get["n"] - n_big.get["n_errors"]
    return {"kept": n_kept.get["n"], "skipped": read - n_big.get["n_short"] - n_kept.get["n"]}


def has_key(raw: Column, key: str) -> Column:
    """The object has the key; a JSON null counts as there."""
    return F.try_variant_get(F.try_parse_json(raw), f"$.{key}", "variant").isNotNull()


def with_flags(rows: DataFrame, profile: Q.Profile, raw: str = "raw") -> DataFrame:
    """Adds ``flags`` of the audit; the first audit asks whether the record has the key ``index``."""
    return rows.withColumn("flags", Q.audit_flags(F.col("messages"), profile, has_key(F.col(raw), "index")))


def flagged(raw: Column, flags: Column) -> Column:
    """The record with its flags under ``_flags``, the other keys and their order as they were."""
    return F.concat(F.regexp_replace(raw, r"\}\s*\z", ""), F.when(raw.rlike(r"\A\s*\{\s*\}\s*\z"), "").otherwise(", "), F.lit('"_flags": '), F.to_json(flags), F.lit("}"))


def repair(spark: SparkSession, source: str, output: str, *, version: int = 1, flagged_to: str | None = None, flag_filter: list[str] | None = None) -> dict[str, int]:
    """Lines repaired, the first of each ``index`` kept, audited, routed and written.

    Version 1 writes what no severe flag blocks to ``output`` and every flagged record (with one of
    ``flag_filter``, if given) with its ``_flags`` to ``flagged_to``; a record may be in both. Version 2 writes
    the routes ``clean``, ``flagged`` and ``truncated`` below ``output``. Counts of objects, unique and written rows.
    """
    rows, seen = load_records(spark, source, least_messages=0, strict_parts=version == 1)
    unique = dedup.keep_first(rows, jsonl.index_key(F.col("raw")), F.col("ord"))
    profile = Q.FIRST if version == 1 else Q.SECOND
    audited = checkpoint(with_flags(unique, profile).select("ord", "raw", "flags"))  # both sinks and the report read it
    counts = {"objects": seen.get["n"] - seen.get["n_errors"], "errors": seen.get["n_errors"], "unique": audited.count()}
    if version == 1:
        clean, n_clean = counted(audited.filter(~Q.is_blocked(F.col("flags"))))
        jsonl.write_raw(clean, output)
        some = F.size("flags") > 0
        if flag_filter:
            some &= F.arrays_overlap("flags", F.array(*map(F.lit, flag_filter)))
        kept, n_flagged = counted(audited.filter(some).withColumn("raw", flagged(F.col("raw"), F.col("flags"))))
        jsonl.write_raw(kept, flagged_to or output.rstrip("/") + ".flagged.jsonl")
        return counts | {"clean": n_clean.get["n"], "flagged": n_flagged.get["n"]}
    routed = audited.withColumn("route", Q.route(F.col("flags")))
    routed, n = counted(routed, **{r: F.count_if(F.col("route") == r) for r in ("clean", "flagged", "truncated")})
    jsonl.write_routes(routed, output)
    return counts | {k: n.get[k] for k in ("clean", "flagged", "truncated")}


def sorted_histogram(histogram: DataFrame) -> DataFrame:
    return histogram.orderBy(F.desc("n"), "flag")


# --- the flagship -----------------------------------------------------------------------------------


def counters(scored: DataFrame, best: DataFrame) -> DataFrame:
    """One row: examples used, good and broken ones, problems with a good solution, with broken ones only, pairs."""
    used = scored.agg(F.count("*").alias("n_examples"), F.count_if(F.col("quality") == "good").alias("n_good"), F.count_if(F.col("quality") == "broken").alias("n_broken"))
    good, broken = F.col("good").isNotNull(), F.col("broken").isNotNull()
    kept = best.agg(F.count_if(good).alias("n_good_problems"), F.count_if(~good & broken).alias("n_broken_only"), F.count_if(good & broken).alias("n_pairs"))
    return used.join(kept, F.lit(True))  # two tables of one row each


def organize(spark: SparkSession, folder: str, output: str, *, raw_files: list[str] = (), categories: DataFrame | None = None) -> dict[str, int]:
    """A folder of record files to ``good_solutions``, ``broken_only``, ``dpo_pairs``, ``source_report`` and ``file_report`` below ``output``.

    The folder is read once; the best solutions of all problems are written once and the sinks read them.
    ``categories`` (source, category) names the files' categories in the file report.
    """
    every = jsonl.read_lines(spark, folder, "*.jsonl").select("file").distinct()
    files = {r["file"]: r["ok"] for r in every.select("file", O.usable_file(F.col("file"), list(raw_files)).alias("ok")).collect()}  # a name for each file
    rows = jsonl.with_record(jsonl.repair_lines(read_folder(spark, folder, list(raw_files))))
    records, seen = counted(rows.filter("parse_error is null").select("ord", "file", "text", "messages"))
    scored = checkpoint(O.scored(records, source="file", order="ord", text="text"))
    best = checkpoint(O.best_of_problem(scored, "user", "assistant", "source"))
    text = lambda q: O.rendered(F.col(f"{q}.user"), F.col(f"{q}.assistant")).alias("text")
    good, n_good = counted(best.filter("good is not null").select(text("good")))
    jsonl.write_jsonl(good, f"{output}/good_solutions")
    broken, n_broken = counted(best.filter("good is null and broken is not null").select(text("broken")))
    jsonl.write_jsonl(broken, f"{output}/broken_only")
    pairs, n_pairs = counted(O.preference_pairs(best))
    jsonl.write_jsonl(pairs, f"{output}/dpo_pairs")
    jsonl.write_report(O.source_report(O.pools(best)), f"{output}/source_report", "source_file")
    report = O.file_report(records, scored, source="file")
    if categories is not None:
        report = O.file_category(report, categories)
    jsonl.write_report(report, f"{output}/file_report", "source")
    return {
        "files": sum(files.values()), "files_skipped": len(files) - sum(files.values()), "examples": seen.get["n"], "good": n_good.get["n"], "broken_only": n_broken.get["n"], "pairs": n_pairs.get["n"],
    }


# --- scraped and typeset sources --------------------------------------------------------------------


def scraped_pair(problem: Column, solution: Column) -> Column:
    """A training pair of a scrape: the problem is stripped, the solution stays as it is."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(message("user", F.concat(F.lit(M.PROBLEM_PREFIX), strip(problem))), message("assistant", solution))


def scrape_training(pages: DataFrame, *, least: int = 200) -> DataFrame:
    """``messages`` of pages with a problem and a longest solution of at least ``least`` characters; repeated problems stay."""
    best = extract.longest(F.col("solutions"))
    rows = pages.withColumn("best", best).filter((strip(F.col("problem")) != "") & (F.length("best") >= least))
    return rows.withColumn("messages", scraped_pair(F.col("problem"), F.col("best"))).drop("best")


def scrape_training_distinct(pages: DataFrame, *, order: str, least: int = 150, most: int = 15_000) -> DataFrame:
    """The same from solutions between the bounds, one page for each start of a problem: the first in order."""
    fit = F.filter("solutions", lambda s: (F.length(s) > least) & (F.length(s) < most))
    rows = pages.withColumn("best", extract.longest(fit)).withColumn("p", strip(F.col("problem"))).filter("best is not null and p <> ''")
    key = collapse_space(F.lower(head(F.col("p"), 120)))
    kept = dedup.keep_first(rows, key, F.col(order))
    return kept.withColumn("messages", scraped_pair(F.col("p"), F.col("best"))).drop("best", "p")


#: Fixed value: what the files of one scrape begin with.
SCRAPE_PREFIX = "aops_"


def contest_label(file_name: Column, prefix: str = SCRAPE_PREFIX) -> Column:
    """The file's stem without the prefix, in capitals."""
    return F.upper(F.replace(F.regexp_replace(file_name, r"\.[^.]*\z", ""), F.lit(prefix), F.lit("")))


def tex_training(files: DataFrame, *, with_source: bool = False) -> DataFrame:
    """Training pairs of TeX files, with the file's stem as ``source`` if asked for."""
    pairs = extract.tex_pairs(files)
    rows = pairs.select("source", "block", M.training_pair(F.col("problem"), F.col("solution")).alias("messages"))
    return rows if with_source else rows.drop("source")


def format_records(spark: SparkSession, source: str, output: str) -> dict[str, int]:
    """Records as texts of the training template; counts of records read and written."""
    rows, seen = load_records(spark, source, least_messages=0)
    texts, n = counted(rows.select(M.chatml_training(F.col("messages")).alias("text")).filter("text is not null"))
    jsonl.write_jsonl(texts, output)
    return {"read": seen.get["n"] - seen.get["n_errors"], "written": n.get["n"]}
