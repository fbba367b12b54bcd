"""Broken prompt and response pairs (problem 2).

The words of prompt and response are aligned: shingle containment finds answers that may be the
question again, and the longest common subsequence decides. Refusals are aligned with templates in
the same way; further templates are learned from the corpus: sentences that recur in answers to different
questions which work nothing out and share no shingle with their question, and hardly elsewhere; an answer of such
sentences only declines. The language of both sides comes from a classifier trained here on a bounded sample of
labelled documents; cut answers are judged by their endings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainloom.llm.endings import judge, with_endings
from grainloom.session import checkpoint

#: One defect per pair: the first of these that applies.
DEFECTS = ("empty", "refusal", "copy", "truncated", "language")

#: Headings that are no answer.
HEADINGS = (
    "solution", "proof", "answer", "final answer", "problem", "question", "explanation", "response", "solución", "demostración", "respuesta", "problema", "pregunta", "prueba",
    "lösung", "beweis", "antwort", "aufgabe", "frage", "démonstration", "preuve", "réponse", "problème", "решение", "доказательство", "ответ", "задача", "вопрос",
)
#: Words in place of a missing answer.
PLACEHOLDERS = ("none", "null", "nil", "nan", "n/a", "na", "tbd", "todo", "unknown", "undefined", "missing", "empty", "no answer", "not available", "pending", "xxx")
#: Sentences that decline, by their core.
REFUSALS = (
    "i can't help with this", "i cannot help with this", "i can't assist with this", "i cannot assist with", "i must decline to answer", "i have to decline", "i am not able to provide a solution",
    "i'm not able to provide", "i won't be able to work through this", "something i am unable to solve for you", "i am unable to solve", "i'm unable to help", "i cannot provide an answer", "i can't answer this", "i cannot answer this",
    "answering this falls outside what i can do", "this is beyond what i can do", "it is impossible for me to give a solution", "i am not allowed to answer", "i refuse to answer",
    "no puedo ayudar con este problema", "debo rechazar esta pregunta", "no me es posible dar una solución", "no puedo responder a esta pregunta", "no estoy en condiciones de resolver", "me es imposible dar una solución", "no puedo resolver este problema", "no puedo dar una respuesta", "esto queda fuera de lo que puedo hacer",
    "ich kann bei dieser aufgabe nicht helfen", "eine lösung kann ich hierzu nicht geben", "ich darf diese frage nicht beantworten", "ich muss diese frage ablehnen", "ich kann diese frage nicht beantworten", "es ist mir nicht möglich eine lösung zu geben", "ich bin nicht in der lage", "ich kann diese aufgabe nicht lösen", "das übersteigt meine möglichkeiten",
    "je ne peux pas aider pour ce problème", "je dois refuser cette question", "je dois refuser de répondre", "je ne peux pas répondre à cette question", "il ne m'est pas possible de donner une solution", "je ne suis pas en mesure de donner une solution", "il m'est impossible de donner une solution", "je ne peux pas résoudre ce problème", "je dois décliner cette question", "cela dépasse ce que je peux faire",
    "я не могу помочь с этой задачей", "придётся отказаться от ответа", "я не имею возможности дать решение", "я не могу ответить на этот вопрос", "вынужден отказаться", "я не в состоянии решить", "мне невозможно дать решение", "я не могу решить эту задачу", "это выходит за рамки того что я могу",
)

#: How a writer declines, and the verbs of what is declined; any of the first, then any of the second, within a few words.
DECLINES = (
    "i can't", "i cannot", "i can not", "i won't", "i will not", "i'm not able to", "i am not able to", "i'm unable to", "i am unable to", "i must decline to", "i have to decline to", "i decline to", "i refuse to", "i'd rather not", "i would rather not",
    "i prefer not to", "i'd prefer not to", "i would prefer not to", "i don't want to", "i do not want to", "i do not wish to", "i'm not comfortable", "i am not comfortable", "i don't feel comfortable", "i do not feel comfortable", "i'm not allowed to", "i am not allowed to",
    "i'm not permitted to", "i am not permitted to", "i'm not in a position to", "i am not in a position to", "it is impossible for me to", "it is not possible for me to", "unfortunately i can't", "sorry but i can't",
    "no puedo", "prefiero no", "preferiría no", "no quiero", "no deseo", "no voy a", "me niego a", "no me es posible", "me es imposible", "lamento no poder", "no estoy en condiciones de", "no soy capaz de", "no se me permite", "debo negarme a",
    "ich kann nicht", "ich darf nicht", "ich möchte nicht", "ich will nicht", "ich werde nicht", "ich möchte lieber nicht", "ich kann ihnen nicht", "ich kann dir nicht", "ich bin nicht in der lage", "ich sehe mich nicht in der lage", "es ist mir nicht möglich", "es ist mir unmöglich", "ich kann leider nicht", "ich weigere mich",
    "je ne peux pas", "je ne peux", "je ne saurais", "je préfère ne pas", "je préférerais ne pas", "je ne souhaite pas", "je ne veux pas", "je refuse de", "je me refuse à", "il m'est impossible de", "il ne m'est pas possible de", "je ne suis pas en mesure de", "je ne suis pas capable de", "je ne suis pas autorisé à",
    "я не могу", "я не буду", "я не хочу", "я не стану", "я отказываюсь", "я предпочитаю не", "предпочту не", "я не в состоянии", "я не вправе", "мне нельзя", "мне не разрешено", "к сожалению не могу", "у меня нет возможности",
)
ACTS = frozenset(
    "answer answering help helping assist assisting solve solving provide providing give giving work working comment commenting respond responding discuss discussing complete completing offer offering address addressing engage continue "
    "contestar contestarla responder responderla ayudar ayudarle ayudarte resolver resolverlo dar darle proporcionar ofrecer comentar tratar atender "
    "beantworten antworten helfen lösen geben bearbeiten liefern kommentieren besprechen behilflich weiterhelfen "
    "répondre aider résoudre donner fournir traiter proposer commenter discuter "
    "ответить отвечать помочь помогать решить решать дать давать предоставить комментировать обсуждать рассматривать".split()
)

_WORD = re.compile(r"\w+")
_LETTERS = re.compile(r"[^\W\d_]+")
_FORMULA = re.compile(r"\$\$?[^$]*\$\$?|\\\w+\{[^{}]*\}")
_HEADING = re.compile(rf"\A[\s>*_#]*(?:{'|'.join(HEADINGS)})\s*[.:]?[*_]*\s*[.:]?(?=\s|\Z)", re.I)


def after_heading(text: str) -> str:
    """The text without the headings that it begins with; a heading ends in a colon, a stop or its line."""
    while (m := _HEADING.match(text)) and (m[0].rstrip("*_ \n\t")[-1:] in ".:" or m.end() == len(text) or "\n" in text[m.end() : m.end() + 1] or m[0].lstrip()[:1] in "#*"):
        text = text[m.end() :]
    return text


def is_empty(answer: str | None) -> bool:
    if answer is None:
        return True
    body = after_heading(answer).strip()
    plain = body.strip("[]()<>{}*_\"' .").casefold()
    return not any(c.isalnum() for c in body) or plain in PLACEHOLDERS


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit vectors over the words of a."""
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for word in b:
        hit = row & places.get(word, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def is_copy(question: list[str], answer: list[str], *, n: int = 5, containment: float = 0.8, share: float = 0.9) -> bool:
    """The answer is only the question again, once or several times: shingles of both contain each other, and the words align."""
    if not question or 2 * len(answer) <= len(question):
        return False
    times = max(1, round(len(answer) / len(question)))
    q, a = shingles(question * min(times, 2), n), shingles(answer, n)
    both = len(q & a)
    if both < containment * len(a) or both < containment * len(q):
        return False
    return common(question * times, answer) >= share * max(len(question) * times, len(answer))


_ACT = "<act>"
#: Templates with the share of their words that must align, and how many other words may stand among them.
_TEMPLATES = [(t, set(t), 0.9, 2) for t in ([_ACT if w in ACTS else w for w in _WORD.findall(r)] for r in REFUSALS)] + [(t, set(t), 1.0, 4) for t in ([*_WORD.findall(d), _ACT] for d in DECLINES)]
#: An equation outside of formulas, or a result that is announced.
_RESULT = re.compile(rf"\\boxed|\w\s*[=≤≥≡]\s*[-\w]|(?:^|(?<=[.!?\n]))[\s>*_#]*(?:{'|'.join(HEADINGS)})\s*[*_]*:[*_]*[^\S\n]*\S", re.I)


def own_formulas(question: str, answer: str) -> int:
    """How many formulas of the answer the question has not."""
    asked = "".join(question.split())
    return sum("".join(f.split()).strip("$.,;") not in asked for f in _FORMULA.findall(answer))


def derives(question: str, answer: str) -> bool:
    """The text works something out: it has a formula that the question has not, an equation or a result."""
    return bool(own_formulas(question, answer)) or states_result(answer)


def states_result(answer: str) -> bool:
    return bool(_RESULT.search(_FORMULA.sub(" ", answer.replace("\\boxed", "\\boxed "))))


def is_refusal(question: list[str], answer: str, asked: str = "") -> bool:
    """A template aligns with a place of the answer, and the answer works nothing out.

    ``question`` are the words of the question, ``asked`` is its text. From the aligned place on, nothing may be
    derived beyond what is quoted from the question; before it the problem may be told again, in other words
    too, if that takes no more words than the question and states no result.
    """
    found = list(_WORD.finditer(answer.casefold().replace("’", "'")))
    words, at = [_ACT if m[0] in ACTS else m[0] for m in found], 0
    if question and common([_ACT if w in ACTS else w for w in question], words[: len(question) + 5]) >= 0.9 * len(question):
        at = len(question)
    here = set(words[at:])
    for template, parts, share, gaps in _TEMPLATES:
        if len(parts & here) >= share * len(parts):
            for i in (k for k in range(at, len(words)) if words[k] in parts):
                if common(template, words[i : i + len(template) + gaps]) >= share * len(template):
                    place = min(found[i].start(), len(answer))  # case folding may lengthen a text by a few characters
                    before = answer[:place]
                    told = (i - at <= len(question) or not own_formulas(asked, before)) and not states_result(before)
                    return told and not derives(asked, answer[place:])
    return False


_SENTENCE = re.compile(r"[^.!?…。\n]+[.!?…。\n]+")


def sentence_names(answer: str, *, least_words: int = 4) -> list[int]:
    """64-bit names of the whole sentences, without case, formulas and numbers as one word each."""
    plain = re.sub(r"\d+", "9", _FORMULA.sub(" F ", answer).casefold())
    words = (_WORD.findall(m[0]) for m in _SENTENCE.finditer(plain + ("\n" if plain.rstrip()[-1:] in ")\"'”»" else "")))
    return list({xxhash.xxh64_intdigest(" ".join(w)) - (1 << 63) for w in words if len(w) >= least_words})


def says_nothing(question: str, answer: str, *, n: int = 5) -> bool:
    """The answer works nothing out and shares no shingle of n words with its question."""
    if derives(question, answer):
        return False
    asked, said = _WORD.findall(question.casefold()), _WORD.findall(answer.casefold())
    return len(asked) < n or len(said) < n or not shingles(asked, n) & shingles(said, n)


def learned_refusals(read: DataFrame, *, least_answers: int = 3, others: float = 0.05) -> DataFrame:
    """``row_id, turn`` of answers that say nothing and are made of learned templates only.

    ``read`` has ``row_id, turn, question (a name, or null), quiet, sentences``. A sentence is a template if
    ``least_answers`` quiet answers, to two questions at least, have it, and of all answers with it at most the share
    ``others`` is not quiet. Partial counts move, one row for each sentence and task.
    """
    each = read.select("quiet", "question", F.explode("sentences").alias("sentence"))
    asked = F.when(F.col("quiet"), F.col("question"))
    counts = each.groupBy("sentence").agg(F.count_if("quiet").alias("n"), F.count("*").alias("n_all"), F.min(asked).alias("lo"), F.max(asked).alias("hi"))
    templates = counts.filter((F.col("n") >= least_answers) & (F.col("lo") < F.col("hi")) & (F.col("n_all") - F.col("n") <= others * F.col("n_all"))).select("sentence")
    quiet = read.filter("quiet").select("row_id", "turn", "question", F.size("sentences").alias("size"), F.explode("sentences").alias("sentence"))
    return quiet.join(templates, "sentence").groupBy("row_id", "turn", "question", "size").agg(F.count_distinct("sentence").alias("n")).filter("n = size").select("row_id", "turn")


class Languages:
    """Naive Bayes over words, trained on labelled texts."""

    def __init__(self, labelled: list[tuple[str, str]]):
        counts: dict[str, Counter] = {}
        for lang, text in labelled:
            counts.setdefault(lang, Counter()).update(self.words(text))
        vocabulary = len(set().union(*counts.values())) if counts else 0
        self.logs = {}
        for lang, c in counts.items():
            total = sum(c.values()) + 0.1 * vocabulary
            self.logs[lang] = ({w: math.log((n + 0.1) / total) for w, n in c.items()}, math.log(0.1 / total) if total else 0.0)

    @staticmethod
    def words(text: str) -> list[str]:
        return _LETTERS.findall(_FORMULA.sub(" ", text).casefold())

    def scores(self, words: list[str]) -> dict[str, float]:
        known = [w for w in words if any(w in logs for logs, _ in self.logs.values())]
        return {lang: sum(logs.get(w, rest) for w in known) / max(1, len(known)) for lang, (logs, rest) in self.logs.items()}

    def differ(self, question: str, answer: str, *, margin: float = 0.7, evidence: float = 2.8) -> bool:
        """The answer is in another language than the question: by a margin in log likelihood a word, and by the evidence of all words, on both sides."""
        q, a = self.words(question), self.words(answer)
        if not q or not a or len(self.logs) < 2:
            return False
        sq, sa = self.scores(q), self.scores(a)
        lq, la = max(sq, key=sq.get), max(sa, key=sa.get)
        least = lambda words: max(margin, evidence / len(words))
        return lq != la and sq[lq] - sq[la] > least(q) and sa[la] - sa[lq] > least(a)


def labelled_sample(documents: DataFrame, *, text: str = "text", lang: str = "lang", per_language: int = 200) -> list[tuple[str, str]]:
    """At most ``per_language`` labelled texts of each language, those of the smallest hashes; languages are few."""
    rows = documents.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    kept = rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
    return [(r["lang"], r["text"]) for r in kept.select("lang", "text").collect()]


def question_answer_pairs(records: DataFrame, *, row_id: str = "cot_id", messages: str = "messages") -> DataFrame:
    """Each user message with the message right after it, if that is an assistant's: ``row_id, turn, question, answer``."""
    each = records.filter(F.col(row_id).isNotNull()).select(F.col(row_id).alias("row_id"), F.col(messages).alias("ms"), F.posexplode(messages).alias("turn", "m"))
    after = F.get("ms", F.col("turn") + 1)
    pairs = each.filter("m.role = 'user'").select("row_id", F.col("turn").cast("bigint").alias("turn"), F.col("m.content").alias("question"), F.when(after["role"] == "assistant", after["content"]).alias("answer"))
    return pairs.distinct()


def broken_pairs(records: DataFrame, documents: DataFrame, *, row_id: str = "cot_id", messages: str = "messages", per_language: int = 200) -> DataFrame:
    """Defective pairs: ``row_id, turn, defect`` with the first of DEFECTS that applies.

    ``documents`` (text, lang) trains the language classifier, at most ``per_language`` texts a language.
    Null messages have no pairs; a user message that is last, or not followed by an assistant's, has an
    empty answer; a null question is compared as an empty one and so is never copied; repeated rows give
    one row per (row_id, turn) and defect; an empty table gives no rows; without labelled documents no
    pair is of defect ``language``.
    """
    pairs = question_answer_pairs(records, row_id=row_id, messages=messages)
    languages = records.sparkSession.sparkContext.broadcast(Languages(labelled_sample(documents, per_language=per_language)))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speak = languages.value
        for batch in batches:
            found, quiet, sentences = [], [], []
            for q, a in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                q = q or ""
                if is_empty(a):
                    found.append("empty")
                    quiet.append(False)
                    sentences.append([])
                    continue
                asked, body = _WORD.findall(after_heading(q).casefold()), after_heading(a)
                if is_refusal(asked, body, q):
                    found.append("refusal")
                elif is_copy(asked, _WORD.findall(body.casefold())):
                    found.append("copy")
                else:
                    found.append("language" if speak.differ(q, body) else None)
                quiet.append(says_nothing(q, body))
                sentences.append(sentence_names(body))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(found, pa.string()), pa.array(quiet), pa.array(sentences, pa.list_(pa.int64()))], ["row_id", "turn", "asked", "defect", "quiet", "sentences"])

    kind = pairs.schema["row_id"].dataType.simpleString()
    named = pairs.select("row_id", "turn", "question", "answer", F.when(F.col("question").rlike(r"\w"), F.xxhash64("question")).alias("asked"))
    read = checkpoint(named.mapInArrow(classify, f"row_id {kind}, turn bigint, asked bigint, defect string, quiet boolean, sentences array<bigint>").withColumnRenamed("asked", "question"))
    learned = learned_refusals(read).select("row_id", "turn", F.lit("refusal").alias("defect"))
    read = read.filter("defect is not null").select("row_id", "turn", "defect").unionByName(learned)
    ended = with_endings(pairs.select("row_id", "turn", F.col("answer").alias("text")).filter(F.col("text").rlike(r"\S")))
    cut = judge(ended).filter("not whole").select("row_id", "turn", F.lit("truncated").alias("defect"))
    rank = F.array_position(F.array(*map(F.lit, DEFECTS)), F.col("defect"))
    return read.unionByName(cut).groupBy("row_id", "turn").agg(F.min(F.struct(rank.alias("rank"), "defect")).alias("first")).select("row_id", "turn", "first.defect")
