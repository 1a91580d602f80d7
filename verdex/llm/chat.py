"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says, for each role, what stands before and after a turn and whether its text is under
the loss. The machine walks the turns of a conversation in order, validates the order of the roles
and emits text segments. Control strings inside texts are escaped so that the output can be parsed
back without loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """`opening` and `closing` mark a turn (`{role}` is the escaped role); `loss_roles` have their
    texts under the loss; `follows` maps a state (the last role, '' at the start) to the roles that
    may come next, `*` standing for any other state."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: Mapping[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    })


CHATML = Template()
SEGMENTS = "conv_id long, turn_no long, part string, text string, loss boolean, in_order boolean"


def escape(text: str) -> str:
    """`<|` becomes `<\\|`, and `<\\|` with any number of backslashes gets one more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def segments(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Segments of every conversation of `turns` (conv_id, turn, role, text), three a turn.

    Columns: conv_id, turn_no (0, 1, ... in the conversation), part (`open`, `text`, `close`), text,
    loss, in_order (whether the machine allows this role here; texts are emitted either way).

    Turns go by `turn`, nulls first; ties by role and text, so repeated rows stay repeated turns in
    a defined order. Null role and null text are empty; a null conv_id is a conversation of its own;
    an empty table gives no segments; other columns are ignored. The rows of a conversation pass
    through one task as a sorted stream of which only one batch is held, since order and digest of
    a conversation are sequential; its rows come back in that order within a partition.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state, no = object(), "", 0
        for batch in batches:
            out = []
            for conv, absent, role, text in zip(batch.conv_id, batch.absent, batch.role, batch.text):
                key = None if absent else conv
                if key != at:
                    at, state, no = key, "", 0
                fine = role in template.follows.get(state, template.follows.get("*", frozenset()))
                out += [
                    (key, no, "open", template.opening.format(role=escape_role(role)), False, fine),
                    (key, no, "text", escape(text), role in template.loss_roles, fine),
                    (key, no, "close", template.closing, False, fine),
                ]
                state, no = role, no + 1
            frame = pd.DataFrame(out, columns=["conv_id", "turn_no", "part", "text", "loss", "in_order"])
            yield frame.astype({"conv_id": "Int64"})

    ordered = (
        turns.select(
            F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv_id"), F.col("conv_id").isNull().alias("absent"),
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id", "absent")
        .sortWithinPartitions("conv_id", "absent", F.col("turn").asc_nulls_first(), "role", "text")
    )
    return ordered.mapInPandas(walk, SEGMENTS)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


def read_back(parts: DataFrame, template: Template = CHATML) -> DataFrame:
    """Parse the formatted text of `segments` back, conversation by conversation.

    `parts` must be the frame `segments` gives, in its order. The running text of a conversation is
    cut at the template's marks; each turn found is unescaped and hashed at once, so no conversation
    is held whole.
    """
    head, tail = template.opening.split("{role}")

    class Reader:
        def __init__(self, conv: object) -> None:
            self.conv, self.rest, self.turns, self.size, self.loss_chars, self.valid = conv, "", 0, 0, 0, True
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def take(self, text: str, loss: bool, fine: bool) -> None:
            self.size += len(text)
            self.valid &= fine
            self.rest += text
            if loss:
                plain = unescape(text)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode("utf-8", "surrogatepass"))
            if not self.rest.endswith(template.closing):
                return
            while (end := self.rest.find(template.closing)) >= 0:
                turn, self.rest = self.rest[:end], self.rest[end + len(template.closing) :]
                role, _, body = turn.removeprefix(head).partition(tail)
                self.turns += 1
                self.all.update(f"{unescape_role(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))

        def row(self) -> tuple:
            return (
                self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.size,
                self.valid,
            )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
        now = None
        for batch in batches:
            done = []
            ids = [None if pd.isna(x) else int(x) for x in batch.conv_id]
            for conv, text, loss, fine in zip(ids, batch.text, batch.loss, batch.in_order):
                if now is None or now.conv != conv:
                    done += [now.row()] if now else []
                    now = Reader(conv)
                now.take(text, loss, fine)
            if done:
                yield frame(done)
        if now:
            yield frame([now.row()])

    return parts.mapInPandas(read, DIGESTS)
