"""Projections of message lists and chat templates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import WS, head, rstrip, strip

#: Fixed value: the system prompt of the training template.
SYSTEM_PROMPT = """You are a mathematical olympiad solver. Given a problem, produce a complete and rigorous solution.
Rules:
- Be mathematically correct and justify every nontrivial step.
- Do not include failed attempts or self-corrections.
- Use precise mathematical language.
- End with a clearly stated final answer. For numeric answers, use \\boxed{}."""
#: Fixed value: what stands before a problem in a training pair.
PROBLEM_PREFIX = "Solve the following olympiad problem:\n\n"


def of_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def first_content(messages: Column, role: str) -> Column:
    return F.get(of_role(messages, role), F.lit(0))["content"]


def last_content(messages: Column, role: str) -> Column:
    return F.try_element_at(of_role(messages, role), F.lit(-1))["content"]


def problem_text(messages: Column) -> Column:
    """The first user content, stripped; empty if there is none."""
    return F.coalesce(strip(first_content(messages, "user")), F.lit(""))


def positional(messages: Column, n: int) -> Column:
    """The n-th content whatever its role, stripped."""
    return strip(F.get(messages, F.lit(n))["content"])


def training_pair(question: Column, solution: Column) -> Column:
    """A user message with the fixed prefix and an assistant message, both stripped."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(message("user", F.concat(F.lit(PROBLEM_PREFIX), strip(question))), message("assistant", strip(solution)))


def chatml_training(messages: Column) -> Column:
    """Template with the fixed system prompt, first user and last assistant; null unless both are there and not empty.

    A JSON null content is written as ``None``.
    """
    user, assistant = of_role(messages, "user"), of_role(messages, "assistant")
    u = F.coalesce(F.get(user, F.lit(0))["content"], F.lit("None"))
    a = F.coalesce(F.try_element_at(assistant, F.lit(-1))["content"], F.lit("None"))
    u, a = strip(u), strip(a)
    text = F.concat(
        F.lit("<|im_start|>system\n" + SYSTEM_PROMPT + "\n<|im_end|>\n<|im_start|>user\nProblem:\n"), u, F.lit("\n<|im_end|>\n<|im_start|>assistant\nSolution:\n"), a, F.lit("\n<|im_end|>"),
    )
    there = (F.size(messages) >= 2) & (F.size(user) > 0) & (F.size(assistant) > 0) & (u != "") & (a != "")
    return F.when(F.coalesce(there, F.lit(False)), text)


def chatml(system: Column, user: Column, assistant: Column) -> Column:
    """Template with a system block only where there is a system text."""
    block = lambda role, c: F.concat(F.lit(f"<|im_start|>{role}\n"), c, F.lit("<|im_end|>\n"))
    return F.concat(F.when(system != "", block("system", system)).otherwise(""), block("user", user), block("assistant", assistant))


def chatml_part(text: Column, role: str) -> Column:
    """What a rendered text says in this role, up to the first end mark; empty if nothing."""
    return strip(F.regexp_extract(text, rf"(?s)<\|im_start\|>{role}\n(.*?)<\|im_end\|>", 1))


def parts(messages: Column, text: Column | None = None) -> Column:
    """System, user and assistant text, from a rendered text where there is one, else the first of each role."""
    of = {r: F.coalesce(strip(first_content(messages, r)), F.lit("")) for r in ("system", "user", "assistant")}
    if text is not None:
        of = {r: F.when(text.isNotNull(), chatml_part(text, r)).otherwise(c) for r, c in of.items()}
    return F.struct(*[c.alias(r) for r, c in of.items()])


def without_label(c: Column, label: str) -> Column:
    """Without a leading ``Problem:`` or ``Solution:`` (case ignored), stripped."""
    return strip(F.regexp_replace(c, rf"(?iu)\A{label}:[{WS}]*", ""))


#: The marks of the second model family, as they stand in a text.
NATIVE = ("[gMASK]<sop>", "<|system|>\n", "<|user|>\n", "\n<|assistant|>\nSolution:\n", "<|endoftext|>")


def native_template(text: Column) -> Column:
    """A rendered text in the marks of a second model family."""
    system, user, assistant = (chatml_part(text, r) for r in ("system", "user", "assistant"))
    begin, of_system, of_user, of_assistant, end = map(F.lit, NATIVE)
    return F.concat(begin, F.when(system != "", F.concat(of_system, system, F.lit("\n"))).otherwise(""), of_user, user, of_assistant, assistant, end)


def completion(partial: Column, response: Column) -> Column:
    """A partial answer without its trailing white space, and what the model wrote after it."""
    return F.concat(rstrip(partial), response)


def pair_key(messages: Column, n: int = 120) -> Column:
    """The key of the download stage: the first characters of the first content."""
    return head(F.get(messages, F.lit(0))["content"], n)


def last_run(ids: Column, run: list[int]) -> Column:
    """Start of the last place where ``run`` stands in the token array; null if nowhere."""
    m = len(run)
    starts = F.sequence(F.size(ids) - m, F.lit(0), F.lit(-1))
    hit = F.filter(starts, lambda i: F.slice(ids, i + 1, F.lit(m)) == F.array(*map(F.lit, run)))
    return F.when(F.size(ids) >= m, F.get(hit, F.lit(0)))


def completion_labels(ids: Column, run: list[int]) -> Column:
    """Labels for training on the completion only: -100 up to and with the template, all of them if it is missing."""
    start = F.coalesce(last_run(ids, run) + len(run), F.size(ids))
    return F.concat(F.array_repeat(F.lit(-100), start), F.slice(ids, start + 1, F.size(ids)))


def pad(ids: Column, value: int, multiple: int = 8) -> Column:
    """The array filled up to a multiple of ``multiple``."""
    return F.concat(ids, F.array_repeat(F.lit(value), F.pmod(-F.size(ids), F.lit(multiple)).cast("int")))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty, else the last one."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def level_number(level: Column) -> Column:
    """``Level 5`` as ``5``."""
    return strip(F.replace(level, F.lit("Level "), F.lit("")))


def subject_key(subject: Column) -> Column:
    return F.replace(F.lower(subject), F.lit(" "), F.lit("_"))


def hard_problem(level: Column, subject: Column) -> Column:
    """Level 4 or 5 and not precalculus."""
    return level_number(level).isin("4", "5") & (subject_key(subject) != "precalculus")


def trainable_tokens(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != -100))


def checked_labels(labels: Column) -> Column:
    """The labels; the query fails on a row without a token to train on."""
    return F.when(trainable_tokens(labels) > 0, labels).otherwise(F.raise_error(F.lit("no trainable token: the template was not found")).cast("array<int>"))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


#: The prompts of the three generation stages.
RESTRUCTURE = ("Problem:\n", "\n\nOriginal solution:\n")
CONTINUE = "\n\nA solution has been partially written below. Continue it seamlessly from exactly where it cuts off. Do NOT repeat anything already written.\n\n--- PARTIAL SOLUTION (do not repeat) ---\n"


def restructure_prompt(problem: Column, solution: Column, *, end: str = "") -> Column:
    """What a model is asked to write a solution anew; the second provider's prompt ends in a newline (``end``)."""
    return F.concat(F.lit(RESTRUCTURE[0]), problem, F.lit(RESTRUCTURE[1]), solution, F.lit(end))


def continue_prompt(problem: Column, partial: Column) -> Column:
    """What a model is asked to complete a partial solution, which goes without its trailing white space."""
    return F.concat(problem, F.lit(CONTINUE), rstrip(partial))


def restructured(system: str, problem: Column, solution: Column, response: Column, index: Column) -> Column:
    """The record of a rewritten solution: three messages, the original solution and the index."""
    return F.struct(F.array(message("system", F.lit(system)), message("user", problem), message("assistant", response)).alias("messages"), solution.alias("original_solution"), index.alias("index"))


def completed(problem: Column, partial: Column, response: Column, index: Column) -> Column:
    """The record of a completed solution: two messages and the index."""
    return F.struct(F.array(message("user", problem), message("assistant", completion(partial, response))).alias("messages"), index.alias("index"))


def tokenize_and_mask(texts: DataFrame, encode: Callable[[str], list[int]], *, text: str = "text", template: str = "Solution:\n", most: int = 8192) -> DataFrame:
    """Adds ``input_ids, attention_mask, labels``: tokens cut at ``most``, labels -100 up to and with the last template.

    ``encode`` is the tokenizer, as made in the driver; it runs over Arrow batches.
    """
    run = list(encode(template))
    ids = F.pandas_udf(lambda s: s.map(lambda t: list(encode(t or ""))[:most]), "array<int>")
    rows = texts.withColumn("input_ids", ids(F.col(text)))
    return rows.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1))).withColumn("labels", completion_labels(F.col("input_ids"), run))
