"""Chat formatting with a grammar round trip.

The template gives each turn control strings of its role, the text between
them set off by one space:

    user       [INST] text [/INST]
    assistant  <s> text </s>
    system     <<SYS>> text <</SYS>>
    any other  [ROLE] role [SAY] text [/ROLE]

``parse`` is the deterministic parser of that grammar: it reads control
strings left to right and allows exactly one continuation at each. A turn is
rendered plainly first and parsed again; if the parser fails or the recovered
turn differs from the source, the conflicting strings are escaped and the turn
is parsed once more until both are identical. An escaped control string has a
backslash after its first character; one that already has some gets one more,
so ``unescape`` undoes it for every text.

Since a turn's rendering parses to that turn alone, a conversation's text is
the concatenation of its turns. Turns are rendered where they are read, dealt
out by ranges of (conversation, turn), and packed in order into parts of
bounded size with the loss mask (spans of assistant texts): a conversation
with a third of all rows spreads over many tasks.

Rows of a conversation are ordered by turn (null first), then role and text,
so repeated turns all stay. A null text or role counts as empty; a null
conv_id is a conversation of its own. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import written

MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
ROLE, SAY, END = "[ROLE]", "[SAY]", "[/ROLE]"
LEARNED = "assistant"
PART_CHARS = 1 << 20
_CONTROL = re.compile(r"</?s>|<</?SYS>>|\[/?INST\]|\[/?ROLE\]|\[SAY\]")
_CONFLICT = re.compile(r"<(?=\\*(?:/?s>|</?SYS>>))|\[(?=\\*(?:/?INST\]|/?ROLE\]|SAY\]))")
_ESCAPED = re.compile(r"(<)\\(?=\\*(?:/?s>|</?SYS>>))|(\[)\\(?=\\*(?:/?INST\]|/?ROLE\]|SAY\]))")


def escape(text: str) -> str:
    return _CONFLICT.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or m[2], text)


def template(role: str, text: str) -> str:
    if role in MARKS:
        return f"{MARKS[role][0]} {text} {MARKS[role][1]}"
    return f"{ROLE} {role} {SAY} {text} {END}"


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; start and end enclose the escaped text."""
    opens = {m[0]: role for role, m in MARKS.items()}
    turns, at = [], 0

    def body(mark: str, after: int) -> tuple[int, int, int]:
        """First and end of the text up to ``mark``, the next control string, and the place after it."""
        m = _CONTROL.search(formatted, after)
        if not m or m[0] != mark or m.start() < after + 2 or formatted[after] != " " or formatted[m.start() - 1] != " ":
            raise GrammarError(f"no {mark} after {after}")
        return after + 1, m.start() - 1, m.end()

    while at < len(formatted):
        m = _CONTROL.match(formatted, at)
        if not m or m[0] not in opens and m[0] != ROLE:
            raise GrammarError(f"no turn at {at}")
        if m[0] == ROLE:
            first, end, at = body(SAY, m.end())
            role = unescape(formatted[first:end])
            first, end, at = body(END, at)
        else:
            role = opens[m[0]]
            first, end, at = body(MARKS[role][1], m.end())
        turns.append((role, unescape(formatted[first:end]), first, end))
    return turns


def render(role: str, text: str) -> str:
    """The first rendering, plain or escaped, that parses to exactly this turn."""
    for form in (lambda x: x, escape):
        out = template(role if role in MARKS else form(role), form(text))
        try:
            if [t[:2] for t in parse(out)] == [(role, text)]:
                return out
        except GrammarError:
            continue
    raise GrammarError(f"a turn of role {role!r} does not survive the round trip")


def format_conversations(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Parts of the formatted conversations: conv_id, at and seq (their order), text,
    mask (start, end of each assistant text in ``text``)."""
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def rendered(batches):
        for b in batches:
            out = [render(r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "out"])

    def pack(batches):
        task, seq = TaskContext.get().partitionId(), 0
        conv, held, size, mask = None, [], 0, []

        def part():
            return pa.RecordBatch.from_arrays([
                pa.array([conv], kind), pa.array([task], pa.int32()), pa.array([seq], pa.int64()), pa.array(["".join(held)], pa.string()),
                pa.array([mask], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["conv_id", "at", "seq", "text", "mask"])

        for b in batches:
            kind = b.column("conv_id").type
            for c, role, out in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("out").to_pylist(), strict=True):
                if held and (c != conv or size + len(out) > part_chars):
                    yield part()
                    seq, held, size, mask = seq + 1, [], 0, []
                if role == LEARNED:
                    _, _, first, end = parse(out)[0]
                    mask.append({"start": size + first, "end": size + end})
                conv, size = c, size + len(out)
                held.append(out)
        if held:
            yield part()

    schema = rows.select("conv_id").schema
    kind = schema["conv_id"].dataType.simpleString()
    ready = rows.mapInArrow(rendered, rows.withColumn("out", F.lit("")).schema)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = ready.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "out")
    return dealt.mapInArrow(pack, f"conv_id {kind}, at int, seq long, text string, mask array<struct<start:int,end:int>>")


def read_back(parts: DataFrame) -> DataFrame:
    """Per part, parsed from its text: conv_id, at, seq, n_turns, turns (role, line feed,
    text, line feed of each turn), loss (all text under the mask), chars."""

    def run(batches):
        for b in batches:
            found = [parse(t) for t in b.column("text").to_pylist()]
            loss = ["".join(unescape(t[m["start"]:m["end"]]) for m in mask) for t, mask in zip(b.column("text").to_pylist(), b.column("mask").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column("conv_id"), b.column("at"), b.column("seq"), pa.array([len(x) for x in found], pa.int64()),
                pa.array(["".join(f"{r}\n{t}\n" for r, t, _, _ in x) for x in found], pa.string()), pa.array(loss, pa.string()),
                pa.array([len(t) for t in b.column("text").to_pylist()], pa.int64())], names=["conv_id", "at", "seq", "n_turns", "turns", "loss", "chars"])

    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.mapInArrow(run, f"conv_id {kind}, at int, seq long, n_turns long, turns string, loss string, chars long")


def digest(read: DataFrame) -> DataFrame:
    """One row per conversation. A digest reads its conversation in order, so the parts
    stream through in order, one held at a time."""

    def run(batches):
        conv, state = None, None

        def row():
            n, h, k, g, size = state
            return pa.RecordBatch.from_pydict({"conv_id": pa.array([conv], kind), "n_turns": [n], "turns_sha256": [h.hexdigest()],
                                               "loss_chars": [k], "loss_sha256": [g.hexdigest()], "formatted_chars": [size]})

        for b in batches:
            kind = b.column("conv_id").type
            for c, n, turns, loss, size in zip(*(b.column(x).to_pylist() for x in ("conv_id", "n_turns", "turns", "loss", "chars")), strict=True):
                if state and c != conv:
                    yield row()
                    state = None
                conv, state = c, state or [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += n
                state[1].update(turns.encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += size
        if state:
            yield row()

    kind = read.schema["conv_id"].dataType.simpleString()
    rows = read.repartition("conv_id").sortWithinPartitions("conv_id", "at", "seq")
    return rows.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def round_trip(turns: DataFrame) -> DataFrame:
    """Format into the shared folder, read the parts back and return the digests."""
    return digest(read_back(written(format_conversations(turns), "chat")))
