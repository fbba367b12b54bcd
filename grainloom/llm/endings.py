"""How texts end: shared by the operators for cut records and for broken pairs.

An ending is whole if it closes with a full stop (or its like) and no formula is open. Other endings
are judged by the corpus: the last sentence, with formulas and numbers masked, is whole if it is a
usual way to end a text (an answer line), or if other texts end with the same sentence and a stop.
Counts are of different texts, so that one cut record delivered many times stays one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import WS
from grainloom.session import checkpoint

#: What may follow the last sentence, written backwards, as it is looked for from the end.
CLOSERS = rf"\A(?:[{WS}\"'”’»*_`]|>[^<>]{{0,200}}[A-Za-z]/?<|\}}\*?[a-z]+\{{dne\\|\)(?=[.?!]))++"
#: Signs of a cut, and marks that may stand for a stop, backwards; the sentence before them decides.
SIGNS = rf"(?i)\A(?:[{WS}…;:,–—\x{{FFFD}}]|\.\.+|;?[a-z0-9]{{0,8}}#?&|[\])>](?:…|\.\.\.|detacnurt|tuc|pins|erom|deunitnoc)[\[(<]|\{{?[a-z]+\\)++"
#: The last sentence is looked for in so many characters at the end.
REACH = 400
#: Answer labels in the five languages of the tables.
LABELS = ("answer", "final answer", "respuesta", "respuesta final", "réponse", "réponse finale", "antwort", "endantwort", "ответ", "окончательный ответ")


def bare_end(text: Column) -> Column:
    """The text without closing quotes, markup and white space."""
    return F.reverse(F.regexp_replace(F.reverse(text), CLOSERS, ""))


def dollars(text: Column) -> Column:
    plain = F.replace(text, F.lit("\\$"), F.lit(""))
    return F.length(plain) - F.length(F.replace(plain, F.lit("$"), F.lit("")))


def open_formula(text: Column) -> Column:
    """An odd number of unescaped dollar signs: a formula never closed."""
    return F.pmod(dollars(text), F.lit(2)) == 1


def masked(text: Column) -> Column:
    """Lower case, formulas as F and numbers as 9."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"\$\$?[^$]+\$\$?", "\u0001"), r"\p{Nd}+(?:[.,]\p{Nd}+)*", "9"))


def last_sentence(end: Column, is_open: Column) -> Column:
    """What follows the last stop of a bare end, masked, in single spaces, without a sign of a cut."""
    near = F.right(end, F.lit(REACH))
    # whether the part that is looked at begins within a formula follows from its dollar signs and those of the whole
    inside = (F.pmod(dollars(near), F.lit(2)) == 1) != is_open
    mask = masked(F.when(inside, F.concat(F.lit("$x"), near)).otherwise(near))
    ends = F.translate(F.reverse(F.regexp_replace(F.reverse(mask), SIGNS, "")), ".?!¿¡\r;…—", "\n" * 9)
    tail = F.substring_index(F.reverse(F.regexp_replace(F.reverse(ends), rf"\A[\n{WS}]++", "")), "\n", -1)
    return F.regexp_replace(F.regexp_replace(tail, rf"[{WS}]+", " "), "^ | \\z", "")


def with_endings(texts: DataFrame, text: str = "text") -> DataFrame:
    """The other columns with ``stop`` (the text closes with a stop), ``open`` (in a formula), ``tail`` (the masked
    last sentence, where there is no stop) and ``sample`` (a name of the text that ignores formatting).

    The result is written once, without the texts: the steps that follow read it several times.
    """
    ended = texts.withColumn("end", bare_end(F.col(text))).withColumn("open", open_formula(F.col("end")))
    ended = ended.withColumn("stop", F.col("end").rlike(r"(?<!\.)[.?!。।∎■□]\z") & ~F.col("open"))
    ended = ended.withColumn("tail", last_sentence(F.col("end"), F.col("open")))
    ended = ended.withColumn("sample", F.xxhash64(F.regexp_replace(F.lower(F.right(F.col("end"), F.lit(160))), r"[^\p{L}\p{N}]", "")))
    ended = ended.withColumn("tail_id", F.xxhash64("tail")).withColumn("tail", F.when(~F.col("stop"), F.col("tail")))
    return checkpoint(ended.drop("end", text))


def usual_tails(ended: DataFrame, *, least_texts: int = 3, least_share: float = 0.002) -> DataFrame:
    """Tails without a stop that are whole: ``tail_id``, and ``habit`` (true for a usual answer line).

    A tail is a habit if ``least_share`` of all different texts that end without a stop end so, and at
    least ``least_texts``: a cut leaves any one tail far less often, at every size of the corpus. Other
    tails are whole if some text ends with the same sentence and a stop.
    """
    tails = ended.filter("not open").groupBy("tail_id", "stop", "sample").agg(F.lit(1).alias("one"))
    counts = tails.groupBy("tail_id").agg(F.count_if(~F.col("stop")).alias("bare"), F.count_if(F.col("stop")).alias("stopped"))
    total = tails.agg(F.count_if(~F.col("stop")).alias("total")).first()["total"]
    counts = counts.filter("bare > 0")
    habit = (F.col("bare") >= least_texts) & (F.col("bare") >= least_share * total)
    return counts.select("tail_id", habit.alias("habit"), (F.col("stopped") > 0).alias("elsewhere")).filter("habit or elsewhere")


def whole_by_itself(tail: Column) -> Column:
    """The tail is an answer: a label or nothing, then a formula or a number."""
    labels = "|".join(LABELS)
    return tail.rlike(rf"^(?:(?:{labels})[{WS}]*:[{WS}*]*)?(?:\x{{1}}|-?9%?|\\boxed\{{[^{{}}]*\}})\z")


def judge(ended: DataFrame, *, salts: int = 16, **limits: float) -> DataFrame:
    """All texts, with ``whole``, and ``sure``: whole by a stop, by itself or by habit.

    Only those without a stop look their tail up; the few usual tails are repeated for ``salts`` salts, so
    that one tail of a third of all texts does not meet in one task.
    """
    known = usual_tails(ended, **limits).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = ended.filter("not stop").withColumn("salt", F.pmod("sample", F.lit(salts)).cast("int")).join(known, ["tail_id", "salt"], "left")
    habit, elsewhere = F.coalesce("habit", F.lit(False)), F.coalesce("elsewhere", F.lit(False))
    sure = ~F.col("open") & (habit | whole_by_itself(F.col("tail")))
    asked = asked.withColumn("sure", sure).withColumn("whole", F.col("sure") | (~F.col("open") & elsewhere)).drop("tail_id", "salt", "habit", "elsewhere")
    stopped = ended.filter("stop").drop("tail_id").withColumns({"sure": F.lit(True), "whole": F.lit(True)})
    return asked.unionByName(stopped)
