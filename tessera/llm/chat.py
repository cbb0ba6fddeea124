"""Chat formatting with a grammar round trip: what is rendered is parsed again, and texts that get in the way are escaped.

The grammar of a formatted conversation, in which a turn's role ends with the first line break:

    conversation = { "<|im_start|>" role "\\n" text "<|im_end|>" "\\n" }

A control string inside a role or text would end or begin turns that the source doesn't have. Each turn is therefore rendered
as it is, parsed by the grammar and compared with its source; where they differ, its content is escaped and compared again. An
escape puts one more backslash between ``<`` and ``|`` of every control string, however many there are already; a parser takes
one away, so no text is ambiguous. In roles, line breaks and backslashes are escaped as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, only, out, small_batches

# The template's control strings; the last one ends a document and must not occur inside a turn either.
START, END, CONTROL = "<|im_start|>", "<|im_end|>", ("im_start", "im_end", "endoftext")
ASSISTANT = "assistant"
_NAMES = "|".join(CONTROL)
_CONTROL = re.compile(rf"<\|(?:{_NAMES})\|>")
_ESCAPED = re.compile(rf"<\\(\\*)\|(?=(?:{_NAMES})\|>)")
_ANY = re.compile(rf"<(\\*)\|(?=(?:{_NAMES})\|>)")
#: Characters of a formatted part after which the next turn begins a new one: bounds a row however long a conversation is.
PART = 1 << 22


class Malformed(ValueError):
    """A formatted text that the grammar doesn't derive."""


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<\\" in text else text


def escape(text: str) -> str:
    return _ANY.sub(r"<\\\1|", text)


def _role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


def _escape_role(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|").replace("\n", "\\n")


def render(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn, unescaped, and where its text as written stands. Deterministic: every control
    string is a token, and only one token is allowed at each place."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise Malformed(f"no turn begins at {at}")
        begin = formatted.find("\n", at)
        token = _CONTROL.search(formatted, at + len(START))
        if token is None or begin < 0 or token.start() < begin or token[0] != END or not formatted.startswith("\n", token.end()):
            raise Malformed(f"the turn at {at} does not end")
        yield _role(formatted[at + len(START) : begin]), unescape(formatted[begin + 1 : token.start()]), begin + 1, token.start()
        at = token.end() + 1


def _comes_back(formatted: str, turns: list[tuple[str, str]]) -> bool:
    try:
        return [t[:2] for t in parse(formatted)] == turns
    except Malformed:
        return False


def formatted_turn(role: str, text: str) -> str:
    """A turn as the grammar reads it back: as it is, else with its text escaped, else with its role escaped too."""
    forms = ((lambda: (role, text)), (lambda: (role, escape(text))), (lambda: (_escape_role(role), text)), (lambda: (_escape_role(role), escape(text))))
    for form in forms:
        written = render(*form())
        if _comes_back(written, [(role, text)]):
            return written
    raise Malformed("a turn that no form gives back")  # escaped forms always come back


def ordered(df: DataFrame, *order: str) -> DataFrame:
    """Rows of a conversation together and in order; a task reads them as a stream, so a long conversation needs no memory."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): each conversation as one text, and the spans of it that a model is trained on.

    Turns stand in the order of ``turn`` (null first), then role and text. A null role or text counts as empty, a null conv_id
    as a conversation of its own; repeated rows are repeated turns; an empty table gives no rows. ``loss`` lists begin and end,
    in code points, of every assistant text. Conversations of more than PART characters go on in further parts, numbered from
    0 and cut between turns.
    """
    small_batches(conversations.sparkSession)
    rows = only(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(span))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, turns, written, size, loss, begun = None, 0, [], [], 0, [], False

        def flush():
            whole = "".join(written)
            if not _comes_back(whole, turns):
                raise Malformed(f"conversation {conv} does not come back")
            return out(schema, [conv], [part], [len(turns)], [whole], [loss])

        for b in batches(parts):
            for c, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if not begun or c != conv or size > PART:
                    if begun:
                        yield flush()
                    part = part + 1 if begun and c == conv else 0
                    conv, turns, written, size, loss, begun = c, [], [], 0, [], True
                one = formatted_turn(role, text)
                if role == ASSISTANT:
                    begin, end = next((t[2], t[3]) for t in parse(one))
                    loss.append({"begin": size + begin, "end": size + end})
                turns.append((role, text))
                written.append(one)
                size += len(one)
        if begun:
            yield flush()

    return ordered(rows, "turn", "role", "text").mapInArrow(run, "conv_id bigint, part int, n_turns bigint, formatted string, loss array<struct<begin bigint, end bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row for each conversation of ``format_turns``, from its output alone: digests of the parsed turns and of the text under the loss spans."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun = None, False

        def row():
            return out(schema, [conv], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [length])

        for b in batches(parts):
            for c, text, spans in zip(*(b.column(n).to_pylist() for n in ("conv_id", "formatted", "loss"))):
                if not begun or c != conv:
                    if begun:
                        yield row()
                    conv, begun, n, chars, length, turns, loss = c, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said, *_ in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in spans:
                    said = unescape(text[span["begin"] : span["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                length += len(text)
        if begun:
            yield row()

    result = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered(formatted.select("conv_id", "part", "formatted", "loss"), "part").mapInArrow(run, result)
