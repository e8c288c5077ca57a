"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names, for each role, the marks around a turn and whether its
text is under the loss; ``order`` holds the machine's transitions. Control
strings inside texts (and the escape sign itself) get the escape sign in
front, so a formatted conversation can be read back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.common import id_text, with_long_id

TEMPLATE = {
    "begin": "<s>",
    "roles": {
        "system": {"open": "[SYS] ", "close": " [/SYS]", "loss": False},
        "user": {"open": "[INST] ", "close": " [/INST]", "loss": False},
        "assistant": {"open": "[ANS] ", "close": "</s>", "loss": True},
    },
    # any other role: its name between these marks, then the text, then close
    "other": {"open": "[ROLE:", "named": "[=]", "close": "[/ROLE]", "loss": False},
    "order": {"": ["system", "user"], "system": ["user"], "user": ["assistant"],
              "assistant": ["user"]},
    "last": ["assistant"],
    "escape": "\\",
}


class Format:
    """The operations of one template."""

    def __init__(self, template: dict = TEMPLATE):
        self.t, self.esc = template, template["escape"]
        other = template["other"]
        marks = {template["begin"], other["open"], other["named"], other["close"]}
        for r in template["roles"].values():
            marks |= {r["open"].strip(), r["close"].strip()}
        self.marks = sorted(marks, key=lambda m: (-len(m), m))
        alt = "|".join(map(re.escape, [self.esc, *self.marks]))
        self._control = re.compile(alt)
        self._escaped = re.compile(re.escape(self.esc) + f"({alt})")
        self._token = re.compile(f"{re.escape(self.esc)}(?:{alt})|({'|'.join(map(re.escape, self.marks))})")

    def escape(self, text: str) -> str:
        return self._control.sub(lambda m: self.esc + m[0], text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def check(self, roles: list[str]) -> str | None:
        """None if the machine accepts the roles, else the first fault."""
        state = ""
        for i, role in enumerate(roles):
            if role not in self.t["order"].get(state, []):
                return f"turn {i}: {role or 'no role'} after {state or 'start'}"
            state = role
        return None if state in self.t["last"] else f"ends with {state or 'no turn'}"

    def segments(self, turns: list[tuple[str, str]]) -> list[tuple[str, bool]]:
        """(text, under the loss) in output order."""
        out = [(self.t["begin"], False)]
        for role, text in turns:
            r = self.t["roles"].get(role)
            if r is None:
                o = self.t["other"]
                r = o | {"open": o["open"] + self.escape(role) + o["named"]}
            out += [(r["open"], False), (self.escape(text), r["loss"]), (r["close"], False)]
        return out

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted conversation."""
        opens = {r["open"].strip(): name for name, r in self.t["roles"].items()}
        other, begin = self.t["other"], self.t["begin"]
        if not formatted.startswith(begin):
            raise ValueError("not a formatted conversation")
        turns: list[tuple[str, str]] = []
        role = close = None
        start = len(begin)
        for m in self._token.finditer(formatted, start):
            mark = m[1]
            if mark is None:
                continue
            if role is None and mark in opens:
                role, close = opens[mark], self.t["roles"][opens[mark]]["close"]
                start = m.start() + len(self.t["roles"][role]["open"])
            elif role is None and mark == other["open"]:
                start, close = m.end(), None
                role = other["open"]
            elif role == other["open"] and close is None and mark == other["named"]:
                role, start, close = ("other", self.unescape(formatted[start:m.start()])), m.end(), other["close"]
            elif close and mark == close.strip():
                end = m.start() - (len(close) - len(close.lstrip()))
                name = role[1] if isinstance(role, tuple) else role
                turns.append((name, self.unescape(formatted[start:end])))
                role = close = None
            else:
                raise ValueError(f"mark {mark} out of place at {m.start()}")
        if role is not None:
            raise ValueError("unfinished turn")
        return turns


def format_conversations(turns: DataFrame, template: dict = TEMPLATE,
                         conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, segments (text, loss), loss_spans
    (start, end in code points of ``formatted``, end exclusive), fault (null if the
    machine accepts the order of roles).

    Turns go by turn number, then role, then text (nulls first), so ties and
    repeated rows have a fixed order and all stay. Null texts and roles count
    as empty. A conversation that breaks the order is still formatted, with
    its fault named. Rows with a null conv_id form one conversation. An empty
    table gives no rows; other columns are not read. A formatted conversation
    is one string, so one conversation must fit in one row.
    """
    rows = turns.groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text")))).alias("turns"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Format(template)
        for b in batches:
            out = []
            for conv, said in zip(b["conv_id"], b["turns"]):
                seg = f.segments([(t["role"], t["text"]) for t in said])
                spans, at = [], 0
                for text, loss in seg:
                    if loss:
                        spans.append({"start": at, "end": at + len(text)})
                    at += len(text)
                out.append((conv, "".join(s for s, _ in seg),
                            [{"text": s, "loss": x} for s, x in seg], spans,
                            f.check([t["role"] for t in said])))
            yield pd.DataFrame(out, columns=["conv_id", "formatted", "segments", "loss_spans",
                                             "fault"])

    return with_long_id(rows.withColumn("conv_id", id_text("conv_id")).mapInPandas(
        run, "conv_id string, formatted string, segments array<struct<text:string,loss:boolean>>, "
             "loss_spans array<struct<start:long,end:long>>, fault string"), "conv_id")
