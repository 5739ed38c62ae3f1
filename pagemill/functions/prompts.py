"""Prompt and answer texts. All wording is a parameter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatWording:
    """The fixed parts of a chat prompt, in the instruction format of the model."""

    open: str = "[INST] <<SYS>>"
    system: str = ("You help people who work with data. You answer questions about programming,"
                   " SQL and data platforms, and politely decline all others.")
    context: str = "\n\n This page may help you to answer: \n\n"
    close: str = "\n\n <</SYS>>"
    instruction: str = ("Answer the question of the user in detail. If you do not know the answer"
                        " or the question is out of place, say so. Add no notes.")
    history: str = "\n\n  Earlier in this conversation:"
    question: str = "\n\n  Question: "
    end: str = "[/INST]"


@dataclass(frozen=True)
class TrainingWording:
    """The fixed parts of the prompts that generate questions and answers."""

    page: str = "This is a page of documentation: "
    ask: str = (" Write one or two questions that the page answers and that its readers may have."
                " Reply with a JSON array of strings and nothing else.")
    context: str = "You help people who write data programs. This page may hold what they need: \n\n"
    question: str = "\n\nAnswer this question: \n\n"


# The form of an answer with its source, and the length of an answer.
LINK = '\nFor more details, <a href="{url}">open the documentation</a>  '
MAX_ANSWER_TOKENS = 500


def chat_prompt(question: Column, document: Column | None = None, history: Column | None = None,
                wording: ChatWording = ChatWording()) -> Column:
    """Prompt for a question, with the document block only where there is one.

    ``history`` is an array of ``struct<role, text>``, oldest first.
    """
    w = wording
    parts = [F.lit(w.open + w.system)]
    if document is not None:
        parts.append(F.when(document.isNotNull(), F.concat(F.lit(w.context), document)).otherwise(""))
    parts.append(F.lit(w.close + w.instruction))
    if history is not None:
        turns = F.transform(history, lambda t: F.concat(F.lit("\n"), t["role"], F.lit(": "), t["text"]))
        parts.append(F.when(F.size(history) > 0, F.concat(F.lit(w.history), F.array_join(turns, "")))
                     .otherwise(""))
    return F.concat(*parts, F.lit(w.question), question, F.lit(w.end))


def question_prompt(document: Column, wording: TrainingWording = TrainingWording()) -> Column:
    return F.concat(F.lit(wording.page), document, F.lit(wording.ask))


def answer_prompt(document: Column, question: Column,
                  wording: TrainingWording = TrainingWording()) -> Column:
    return F.concat(F.lit(wording.context), document, F.lit(wording.question), question)


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def answer_html(text: Column, url: Column, link: str = LINK) -> Column:
    """Answer with the source link where a document was used; newlines -> ``<br/>``."""
    before, after = link.split("{url}")
    linked = F.when(url.isNotNull(), F.concat(text, F.lit(before), url, F.lit(after))).otherwise(text)
    return F.replace(linked, F.lit("\n"), F.lit("<br/>"))


def shown_answer(answer: Column) -> Column:
    return F.replace(F.replace(answer, F.lit("\n"), F.lit("<br/>")), F.lit("Answer: "), F.lit(""))


def shown_prompt(prompt: Column) -> Column:
    return F.replace(prompt, F.lit("\n"), F.lit("<br/>"))
