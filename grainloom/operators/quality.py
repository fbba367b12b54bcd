"""Content audit, routing and scoring of solutions, as native expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import any_of, count_char, tail, word_count
from grainloom.operators.messages import first_content


@dataclass(frozen=True)
class Profile:
    """Thresholds and phrase lists of one audit."""

    least_chars: int
    refuting: tuple[str, ...]
    doubting: tuple[str, ...]
    final_marks: tuple[str, ...] = ()
    missing_index: bool = False


#: Fixed values of the two audits.
FIRST = Profile(
    300,
    ("the statement is false", "the problem is false", "this is false", "a counterexample", "is incorrect as stated", "as stated is false", "no such", "cannot be proved"),
    ("wait, that's wrong", "actually, i made an error", "let me reconsider", "i was wrong", "this is incorrect"),
    missing_index=True,
)
SECOND = Profile(
    100,
    ("the statement is false", "this is false", "is incorrect as stated", "the problem is incorrect", "no such"),
    ("wait, that's wrong", "actually, i made an error", "[corrected", "corrected to", "i was wrong", "this is incorrect"),
    (
        r"\boxed", r"\blacksquare", r"\square", "**Answer**", "**answer**", "**Conclusion**", "**conclusion**", "the answer is", "thus the answer", "hence the answer", "therefore the answer", "we conclude", "thus we get",
        "hence we get", "the minimum is", "the maximum is", "the largest is", "the smallest is", "in summary", "to summarize", "qed", "q.e.d", "(A)", "(B)", "(C)", "(D)", "(E)", "the answer is (", "∎",
    ),
)
#: Fixed values of the score.
ENDINGS = (r"\boxed{", "therefore", "thus", "hence", "∎", "q.e.d", "the answer is", "the solution is", "we conclude", "finally,", "in conclusion", "answer:")
CUTS = ("...", "… ", "let me", "wait,", "hmm,", "actually,\ni", "i need to reconsider", "i made an error")
BLOCKING = ("REFUTES_PROBLEM", "SELF_DOUBTING", "TOO_SHORT", "NO_MESSAGES")


def audit_flags(messages: Column, profile: Profile, has_index: Column | None = None) -> Column:
    """The flags of a record in their fixed order; without messages only NO_MESSAGES."""
    text = F.coalesce(first_content(messages, "assistant"), F.lit(""))
    low = F.lower(text)
    flag = lambda test, name: F.when(test, F.lit(name))
    flags = []
    if profile.missing_index and has_index is not None:
        flags.append(flag(~has_index, "MISSING_INDEX"))
    flags += [
        flag(F.length(text) < profile.least_chars, "TOO_SHORT"), flag(~F.contains(text, F.lit(r"\boxed")), "NO_BOXED"),
        flag(any_of(low, profile.refuting), "REFUTES_PROBLEM"), flag(any_of(low, profile.doubting), "SELF_DOUBTING"),
    ]
    if profile.final_marks:
        last = tail(text, 120)
        flags.append(flag(F.regexp_count(text, F.lit(r"\\boxed\{")) > 2, "MULTIPLE_ANSWERS"))
        flags.append(flag(~any_of(text, profile.final_marks) | (count_char(last, "{") > count_char(last, "}")), "TRUNCATED"))
    return F.when(messages.isNull(), F.array(F.lit("NO_MESSAGES"))).otherwise(F.array_compact(F.array(*flags)))


def is_blocked(flags: Column) -> Column:
    """First audit: not clean. Its flagged output is every row with a flag, so the two overlap."""
    return F.arrays_overlap(flags, F.array(*map(F.lit, BLOCKING)))


def route(flags: Column) -> Column:
    """Second audit: truncated, else flagged, else clean; disjoint and exhaustive."""
    severe = F.array_except(flags, F.array(F.lit("NO_BOXED"), F.lit("MISSING_INDEX")))
    return F.when(F.array_contains(flags, "TRUNCATED"), "truncated").when(F.size(severe) > 0, "flagged").otherwise("clean")


def score_texts(solution: Column) -> dict[str, Column]:
    """What the score looks at, each to be computed once (``functions.text.once``)."""
    return {"word_count": word_count(solution), "has_boxed": F.contains(solution, F.lit(r"\boxed{")), "last": F.lower(tail(solution, 300)), "close": F.lower(tail(solution, 100))}


def score_marks() -> dict[str, Column]:
    """The marks of the score, from the columns of ``score_texts``."""
    return {"has_ending": any_of(F.col("last"), ENDINGS), "seems_truncated": any_of(F.col("close"), CUTS)}


def quality() -> Column:
    """Good or broken, from the columns of ``score_texts`` and ``score_marks``."""
    long_enough = ((F.col("word_count") >= 120) & F.col("has_ending")) | ((F.col("word_count") >= 80) & F.col("has_boxed"))
    return F.when(~F.col("seems_truncated") & long_enough, "good").otherwise("broken")


def is_valid(question: Column, solution: Column, least: int = 100) -> Column:
    """Both there, the solution long enough, no program and no error output in it."""
    program = F.contains(solution, F.lit("```python")) & F.contains(solution, F.lit("sympy"))
    errors = F.contains(solution, F.lit("Traceback")) | F.contains(solution, F.lit("Error"))
    return F.coalesce((question != "") & (F.length(solution) >= least) & ~program & ~errors, F.lit(False))


def flag_histogram(rows: DataFrame, flags: str = "flags") -> DataFrame:
    """Each flag with its count and percentage of all rows."""
    totals = rows.select(F.explode(F.concat(F.array(F.lit("")), F.col(flags))).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    whole = F.greatest(F.max(F.when(F.col("flag") == "", F.col("n"))).over(Window.partitionBy()), F.lit(1))  # a row per flag
    return totals.withColumn("percent", F.round(F.col("n") * 100.0 / whole, 2)).filter("flag <> ''")
