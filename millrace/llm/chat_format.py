"""Chat formatting: black-box templates, rendered turn by turn to find each turn's span."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that tokenizers and templates give a meaning.
CONTROLS = [
    "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|endoftext|>", "<|role|>", "<|text|>", "<|end|>",
]
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
_HIT = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)")
_ESCAPED = re.compile(r"\\(.)", re.S)

Turn = tuple[str, str]


def escape(text: str) -> str:
    r"""No control string is left: ``\.`` splits each after its first character; ``\`` is doubled."""
    return _HIT.sub(r"\1\\.", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "" if m[1] == "." else m[1], text)


def marked_turns(turns: list[Turn]) -> str:
    """The template of this folder: every turn names its role, then its text, and ends."""
    return "".join(f"{ROLE}{escape(role)}{TEXT}{escape(text)}{END}\n" for role, text in turns)


def spans(turns: list[Turn], render: Callable[[list[Turn]], str]) -> tuple[str, list[tuple[int, int]], bool]:
    """The formatted text, each turn's span in it, and whether the template rewrote its history.

    The template is asked for every prefix of the turns. What a prefix adds to the one before is
    the span of its last turn. If a longer prefix changes what was there, the span begins where
    the two outputs part, earlier spans end there at the latest, and the conversation is marked.
    """
    before, found, rewrites = "", [], False
    for k in range(1, len(turns) + 1):
        after = render(turns[:k])
        start = len(before)
        if not after.startswith(before):
            rewrites = True
            start = _parting(before, after)
            found = [(min(a, start), min(b, start)) for a, b in found]
        found.append((start, len(after)))
        before = after
    return before, found, rewrites


def _parting(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def read_turn(part: str) -> tuple[str, int, int]:
    """Role, and where the text begins and ends, in a span written by ``marked_turns``."""
    role_end = part.index(TEXT)
    return unescape(part[len(ROLE):role_end]), role_end + len(TEXT), part.rindex(END)


def format_conversations(
    rows: DataFrame, render: Callable[[list[Turn]], str] = marked_turns, conv_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (role, start, end), loss (start, end), rewrites.

    Turns stand in order of ``turn`` (null first), ties by role and text; repeated rows are turns
    of their own. Null role or text is empty. ``turns`` are spans of ``formatted`` in code points;
    ``loss`` are the text spans (escaped) of roles in ``learn``. With another template than
    ``marked_turns``, the span of a whole turn is the loss span. Each row without
    a conversation id is a conversation of its own, so such rows meet nowhere. A conversation is rendered in
    one task, whole, however long its texts; its cost grows with the square of its turns. Other columns
    are not read.
    """
    said = rows.select(
        rows[conv_col].cast("long").alias("conv_id"),
        F.struct(
            rows[turn_col].cast("long").alias("turn"), F.coalesce(rows[role_col], F.lit("")).alias("role"),
            F.coalesce(rows[text_col], F.lit("")).alias("text"),
        ).alias("row"),
    )
    turns = said.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows")).unionByName(
        said.where("conv_id is null").select("conv_id", F.array("row").alias("rows"))
    )
    learned = frozenset(learn)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"conv_id": batch.column(0).to_pylist(), "formatted": [], "turns": [], "loss": [], "rewrites": []}
            for members in batch.column(1):
                said = [(r["role"], r["text"]) for r in members.as_py()]
                text, places, rewrites = spans(said, render)
                loss = []
                for (role, _), (a, b) in zip(said, places):
                    if role in learned:
                        if render is marked_turns:
                            _, start, end = read_turn(text[a:b])
                            loss.append((a + start, a + end))
                        else:
                            loss.append((a, b))
                out["formatted"].append(text)
                out["turns"].append([{"role": role, "start": a, "end": b} for (role, _), (a, b) in zip(said, places)])
                out["loss"].append([{"start": a, "end": b} for a, b in loss])
                out["rewrites"].append(rewrites)
            span = [("start", pa.int64()), ("end", pa.int64())]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("conv_id", pa.int64()), ("formatted", pa.string()),
                ("turns", pa.list_(pa.struct([("role", pa.string()), *span]))),
                ("loss", pa.list_(pa.struct(span))), ("rewrites", pa.bool_()),
            ]))

    return turns.mapInArrow(
        formatted,
        "conv_id long, formatted string, turns array<struct<role:string,start:long,end:long>>, "
        "loss array<struct<start:long,end:long>>, rewrites boolean",
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, n_turns, turns_text (role, newline, text, newline per turn), loss_text, read from ``formatted`` alone.

    Works on what ``marked_turns`` wrote: turns are cut at their end marks, which no text can hold.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, losses, counts = [], [], []
            for value, mask in zip(batch.column(1), batch.column(2)):
                text = value.as_py()
                parts = text.split(END + "\n")[:-1]
                said = [tuple(unescape(x) for x in p.removeprefix(ROLE).split(TEXT)) for p in parts]
                turns.append("".join(f"{role}\n{body}\n" for role, body in said))
                losses.append("".join(unescape(text[s["start"]:s["end"]]) for s in mask.as_py()))
                counts.append(len(said))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(turns, pa.string()),
                 pa.array(losses, pa.string()), batch.column(3)],
                ["conv_id", "formatted", "n_turns", "turns_text", "loss_text", "rewrites"],
            )

    return chats.select("conv_id", "formatted", "loss", "rewrites").mapInArrow(
        parsed,
        "conv_id long, formatted string, n_turns long, turns_text string, loss_text string, rewrites boolean",
    )
