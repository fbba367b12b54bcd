"""The flagship plan: pools of good and broken solutions, preference pairs, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import once, problem_hash, strip
from grainloom.operators.messages import SYSTEM_PROMPT, chatml, chatml_part, first_content, problem_text, without_label
from grainloom.operators.quality import quality, score_marks, score_texts


def scored(records: DataFrame, *, messages: str = "messages", source: str = "source", order: str = "rec_id", text: str | None = None) -> DataFrame:
    """Key, score and texts of each record with a user and an assistant text: ``ord, source, h, quality .. seems_truncated, user, assistant``.

    With ``text``, a record that has a rendered text is read from that.
    """
    texts = F.col(text) if text else F.lit(None).cast("string")
    rows = records.select(F.col(order).alias("ord"), F.col(source).alias("source"), F.col(messages).alias("ms"), texts.alias("t"))
    u, a = problem_text(F.col("ms")), F.coalesce(strip(first_content(F.col("ms"), "assistant")), F.lit(""))
    if text:
        u, a = (F.when(F.col("t").isNotNull(), chatml_part(F.col("t"), role)).otherwise(c) for role, c in (("user", u), ("assistant", a)))
    split = once(rows, ["ord", "source"], u=u, a=a)
    split = split.filter("u <> '' and a <> ''")
    rows = once(split, ["ord", "source"], user=without_label(F.col("u"), "Problem"), assistant=without_label(F.col("a"), "Solution"))
    judged = once(rows, ["ord", "source", "user", "assistant"], h=problem_hash(F.col("user")), **score_texts(F.col("assistant"))).withColumns(score_marks())
    return judged.select("ord", "source", "h", quality().alias("quality"), "word_count", "has_boxed", "has_ending", "seems_truncated", "user", "assistant")


def rendered(user: Column, assistant: Column) -> Column:
    """The training text of a pool: the fixed system prompt, labelled problem and solution."""
    return chatml(F.lit(SYSTEM_PROMPT), F.concat(F.lit("Problem:\n"), user), F.concat(F.lit("Solution:\n"), assistant))


SIDES = ("good", "broken")


def best_of_problem(rows: DataFrame, *carried: str) -> DataFrame:
    """For each problem its best good and its best broken solution: ``h, good, broken`` (null where there is none).

    The longest solution by words, the earliest on ties; each side is a struct of ``ord, word_count`` and the
    carried columns. One partial aggregate and one shuffle serve both sides, and only what is carried moves.
    """
    value = F.struct("ord", "word_count", *carried)
    rank = F.struct((-F.col("word_count")).alias("n"), F.col("ord"))
    return rows.groupBy("h").agg(*[F.min_by(value, F.when(F.col("quality") == q, rank)).alias(q) for q in SIDES])


def pools(best: DataFrame) -> DataFrame:
    """The members of both pools, one row each: ``h, quality`` and what ``best`` carries."""
    sides = F.array_compact(F.array(*[F.when(F.col(q).isNotNull(), F.struct(F.lit(q).alias("quality"), F.col(q).alias("x"))) for q in SIDES]))
    return best.select("h", F.inline(sides)).select("h", "quality", "x.*")


def preference_pairs(best: DataFrame) -> DataFrame:
    """Problem, chosen (good) and rejected (broken) of problems that are in both pools, read back from the rendered texts.

    ``best`` carries ``user, assistant, source``.
    """
    both = best.filter("good is not null and broken is not null")
    texts = once(both, ["good", "broken"], g=rendered(F.col("good.user"), F.col("good.assistant")), b=rendered(F.col("broken.user"), F.col("broken.assistant")))
    part = lambda c, role, label: without_label(chatml_part(F.col(c), role), label)
    return texts.select(
        part("g", "user", "Problem").alias("problem"), part("g", "assistant", "Solution").alias("chosen"), part("b", "assistant", "Solution").alias("rejected"), F.col("good.source").alias("chosen_source"), F.col("broken.source").alias("rejected_source"),
    )


def broken_only(best: DataFrame) -> DataFrame:
    """The broken solutions of problems without a good one."""
    return best.filter("good is null and broken is not null").select("h", "broken.*")


def source_report(pool: DataFrame) -> DataFrame:
    """Unique good and broken solutions per source."""
    count = lambda q: F.count_if(F.col("quality") == q)
    return pool.groupBy(F.col("source").alias("source_file")).agg(count("good").alias("good_unique"), count("broken").alias("broken_unique"))


def file_report(records: DataFrame, rows: DataFrame, source: str = "source") -> DataFrame:
    """Per source: rows, good, broken, skipped (no user or assistant text) and the percentage of good ones."""
    totals = records.groupBy(F.col(source).alias("f")).agg(F.count("*").alias("total"))
    kept = rows.groupBy(F.col("source").alias("g")).agg(F.count_if(F.col("quality") == "good").alias("good"), F.count_if(F.col("quality") == "broken").alias("broken"))
    joined = totals.join(kept, F.col("f").eqNullSafe(F.col("g")), "left").select("f", "total", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "broken")])
    used = F.col("good") + F.col("broken")
    return joined.select(F.col("f").alias("source"), "total", "good", "broken", (F.col("total") - used).alias("skipped"), F.when(used > 0, F.round(100.0 * F.col("good") / used, 2)).alias("good_percent"))


def usable_file(name: Column, raw_files: list[str]) -> Column:
    """Not a merged file and not one of the raw ones."""
    return ~F.contains(F.lower(name), F.lit("merged")) & ~name.isin(*raw_files)


def file_category(files: DataFrame, categories: DataFrame, name: str = "source") -> DataFrame:
    """The category of each file, ``unknown`` where there is none."""
    known = categories.groupBy(F.col(name).alias("_name")).agg(F.min("category").alias("category"))
    return files.join(known, F.col(name) == F.col("_name"), "left").drop("_name").withColumn("category", F.coalesce("category", F.lit("unknown")))
