"""Chat formatting by a declarative template, with a loss flag for each text segment.

A template gives each role the strings before and after its text, whether the text counts
for the loss, and which roles may follow it.  The roles of a conversation run through the
finite-state machine that these make; ``error_turn`` is the first turn it refuses.  Every
conversation is formatted, valid or not, so nothing is lost.

Control strings (all the strings before and after) cannot come from a text: in a run that
would read as one, a backslash is put after its first character, and one more if there are
some already; reading takes one away again.  Other text, backslashes included, stays as it
is.  All of this is Spark SQL expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: role: (before, after, loss, roles that may follow; None is the end)
TEMPLATE = {
    "system": ("<<SYS>>", "<</SYS>>", False, ("user",)),
    "user": ("[INST]", "[/INST]", False, ("assistant",)),
    "assistant": ("<s>", "</s>", True, ("user", None)),
}
START = ("system", "user")
#: Any other role: its name stands between the first two strings.
OTHER = ("<|role|>", "<|text|>", "<|end|>")


class ChatFormat:
    """Formatting and reading back by one template."""

    def __init__(self, template: dict = TEMPLATE, start: tuple = START, other: tuple = OTHER):
        self.template, self.start, self.other = template, start, other
        self.control = [s for before, after, _, _ in template.values() for s in (before, after)] + list(other)
        if len(set(self.control)) != len(self.control) or any(len(s) < 2 for s in self.control):
            raise ValueError("control strings must differ and have two characters at least")
        heads = sorted({s[0] for s in self.control})
        # One alternative for each first character: the places after it, before the rest of a control string.
        parts = [("(?<=" + _quoted(h) + ")", "(?=\\\\*(?:" + "|".join(_quoted(s[1:]) for s in self.control if s[0] == h) + "))") for h in heads]
        self._bare = "|".join(before + after for before, after in parts)
        self._escaped = "|".join(before + "\\\\" + after for before, after in parts)

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self._bare), F.lit("\\\\"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self._escaped), F.lit(""))

    def _by_role(self, role: Column, value, otherwise: Column) -> Column:
        out = None
        for name, parts in self.template.items():
            out = (F if out is None else out).when(role == name, value(parts))
        return out.otherwise(otherwise)

    def segments(self, turns: Column) -> Column:
        """``array<struct<text, loss, kind>>`` of an ordered array of ``struct<role, text>``."""

        def segment(text: Column, loss: Column, kind: str) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"), F.lit(kind).alias("kind"))

        def turn(t: Column) -> Column:
            role = t["role"]
            name = F.concat(F.lit(self.other[0]), self.escape(role), F.lit(self.other[1]))
            return F.array(
                segment(self._by_role(role, lambda p: F.lit(p[0]), name), F.lit(False), "before"),
                segment(self.escape(t["text"]), self._by_role(role, lambda p: F.lit(p[2]), F.lit(False)), "text"),
                segment(self._by_role(role, lambda p: F.lit(p[1]), F.lit(self.other[2])), F.lit(False), "after"),
            )

        return F.flatten(F.transform(turns, turn))

    def error_turn(self, turns: Column) -> Column:
        """The number (from 0) of the first turn out of order, the number of turns if it may not end there, else null.

        The state is the role before; ``start`` and ``refused`` are states of their own.
        """
        allowed = {"start": self.start} | {role: follows for role, (_, _, _, follows) in self.template.items()}

        def step(at: Column, t: Column) -> Column:
            fits = F.lit(False)
            for state, follows in allowed.items():
                names = [r for r in follows if r is not None]
                if names:
                    fits = fits | ((at["state"] == state) & t["role"].isin(names))
            going = at["state"] != "refused"
            return F.struct(
                F.when(going & fits, t["role"]).otherwise(F.lit("refused")).alias("state"),
                (at["turn"] + F.when(going & fits, F.lit(1)).otherwise(F.lit(0))).alias("turn"),
            )

        ends = [role for role, (_, _, _, follows) in self.template.items() if None in follows]
        begin = F.struct(F.lit("start").alias("state"), F.lit(0).alias("turn"))
        return F.aggregate(turns, begin, step, lambda at: F.when(~at["state"].isin(ends), at["turn"]))

    def format(self, conversations: DataFrame) -> DataFrame:
        """``(conv_id, segments, formatted, error_turn)`` of rows ``(conv_id, turn, role, text)``.

        Turns go by ``turn`` (null first), ties by role and text; repeated rows are turns of
        their own.  A null text or role is an empty one; rows without ``conv_id`` make one
        conversation with a null id.  No rows give no rows; other columns are ignored.
        """
        rows = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        turns = conversations.select("conv_id", rows.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
        found = turns.select("conv_id", self.segments(F.col("turns")).alias("segments"), self.error_turn(F.col("turns")).alias("error_turn"))
        return found.select("conv_id", "segments", F.array_join("segments.text", "").alias("formatted"), "error_turn")

    def read(self, formatted: Column) -> Column:
        """``array<struct<role, text>>`` read from a formatted conversation alone."""
        turn = "|".join(f"{_quoted(before)}.*?{_quoted(after)}" for before, after, _, _ in self.template.values())
        first, middle, last = self.other
        pattern = f"(?s){turn}|{_quoted(first)}.*?{_quoted(middle)}.*?{_quoted(last)}"

        def inner(t: Column, before: str, after: str) -> Column:
            return t.substr(F.lit(len(before) + 1), F.length(t) - len(before) - len(after))

        def parsed(t: Column) -> Column:
            cut = inner(t, first, last)
            role = F.substring_index(cut, middle, 1)
            text = cut.substr(F.length(role) + len(middle) + 1, F.length(cut))
            out = F.struct(self.unescape(role).alias("role"), self.unescape(text).alias("text"))
            for name, (before, after, _, _) in self.template.items():
                known = F.struct(F.lit(name).alias("role"), self.unescape(inner(t, before, after)).alias("text"))
                out = F.when(t.startswith(before), known).otherwise(out)
            return out

        return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), 0), parsed)

    def loss_text(self, segments: Column) -> Column:
        """All text under the loss mask, unescaped, one after the other."""
        return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: self.unescape(s["text"])), "")


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)
