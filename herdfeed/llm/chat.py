"""Chat formatting (operator 7): turns rendered by a template, checked by a grammar round trip.

A rendered conversation is ``<s>`` and its turns: ``[INST] text [/INST]`` of a user, a blank,
text and `` </s>`` of an assistant, and ``<<role>>``, line feed, text, line feed, ``<</role>>``,
line feed of any other role (its name percent-encoded; ``system`` is ``SYS``). Each turn says
where it ends, so any order of roles can be read back.

Escaping adds a backslash after every ``<`` and ``[`` and doubles backslashes: no control string
is left in an escaped text. The parser undoes these pairs everywhere. Texts are first rendered
as they are; the rendering is parsed again, and every text that does not come back the same is
escaped, until all turns do.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template's control strings.
BEGIN, END = "<s>", "</s>"
USER_OPEN, USER_CLOSE = "[INST]", "[/INST]"
ROLE_NAMES = {"system": "SYS"}
_CONTROL = re.compile(r"</?s>|\[/?INST\]|<<")
_PAIR = re.compile(r"([<\[\\])\\")
_ROLE_OPEN = re.compile(r"<<([^<>\n]*)>>\n")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return _PAIR.sub(r"\1", text)


def _marks(role: str) -> tuple[str, str]:
    if role == "user":
        return f"{USER_OPEN} ", f" {USER_CLOSE}"
    if role == "assistant":
        return " ", f" {END}"
    name = ROLE_NAMES.get(role) or quote(role, safe="")
    if role not in ROLE_NAMES and name in ROLE_NAMES.values():
        name = "".join(f"%{ord(c):02X}" for c in name)
    return f"<<{name}>>\n", f"\n<</{name}>>\n"


def render(turns: list[tuple[str, str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """Text of ``(role, text, escaped?)`` turns, and the spans of the assistants' texts."""
    out, spans, size = [BEGIN], [], len(BEGIN)
    for role, text, escaped in turns:
        before, after = _marks(role)
        body = escape(text) if escaped else text
        if role == "assistant":
            spans.append((size + len(before), size + len(before) + len(body)))
        out += [before, body, after]
        size += len(before) + len(body) + len(after)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """The turns of a rendered conversation, or None if it doesn't follow the grammar."""
    if not formatted.startswith(BEGIN):
        return None
    at, turns = len(BEGIN), []
    while at < len(formatted):
        if formatted.startswith(f"{USER_OPEN} ", at):
            role, at, close = "user", at + len(USER_OPEN) + 1, f" {USER_CLOSE}"
        elif formatted[at] == " ":
            role, at, close = "assistant", at + 1, f" {END}"
        elif opened := _ROLE_OPEN.match(formatted, at):
            name = opened[1]
            role = next((r for r, n in ROLE_NAMES.items() if n == name), None) or unquote(name)
            at, close = opened.end(), f"\n<</{name}>>\n"
        else:
            return None
        end = formatted.find(close, at)
        if end < 0 or _CONTROL.search(formatted, at, end):
            return None
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(close)
    return turns


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Rendering that parses back to ``turns``, with the assistants' spans."""
    escaped = [False] * len(turns)
    while True:
        formatted, spans = render([(r, t, e) for (r, t), e in zip(turns, escaped)])
        if parse(formatted) == turns:
            return formatted, spans
        # Alone, each text shows whether it comes back the same.
        wrong = [not e and parse(render([(r, t, False)])[0]) != [(r, t)] for (r, t), e in zip(turns, escaped)]
        if not any(wrong):
            raise ValueError("turns can't be rendered reversibly")
        escaped = [e or w for e, w in zip(escaped, wrong)]


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` of each conversation: spans ``(start, end)`` of code
    points of ``formatted`` under the loss mask, one an assistant turn.

    Turns are ordered by ``turn`` (NULL first), ties by role and text. NULL texts and roles are
    empty; repeated rows are turns of their own; rows with a NULL id are one conversation; other
    columns are not read. A conversation is one value, so its turns meet in one row.
    """
    turns = rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")))).alias("turns"))
    turns = turns.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def work(batches):
        for batch in batches:
            done = [format_turns(list(zip(r, t))) for r, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f for f, _ in done], pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "formatted", "loss_spans"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(work, f"conv_id {kind}, formatted string, loss_spans array<struct<start: bigint, end: bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of :func:`format_conversations` rows, from the text and its spans alone."""

    def work(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()
                out.append((len(turns), digest, len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.string() if k in (1, 3) else pa.int64()) for k, c in enumerate(columns)]],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(work, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
