r"""Operator 4, chat formatting: a finite-state machine over roles and segments with loss flags.

A template is plain data: a header per role, the text that ends a turn, the
roles whose texts carry loss, and the allowed role transitions. Formatting
writes ``header + escaped text + end`` for every turn. Control strings inside
texts (headers and the end) get a backslash after their first character and
every backslash of a text is doubled, so no control string survives inside a
text and ``\\(.) -> \1`` gives the text back.

``turn_segments`` needs no group in memory: the previous role comes from a
window over the conversation, and every turn yields its own segments.
``formatted`` puts one conversation into one string, which is what a training
sample is; ``read_back`` parses such strings again. DataFrame functions only.

Defined results: NULL text is empty, NULL role the empty role; a role without a
header gets a generic one that carries its (escaped) name and no loss; rows
without turn number come first, ties are ordered by role and text; invalid
orders are formatted as they are and flagged with the first bad turn; an empty
table gives no conversation; extra columns are ignored. A formatted string is
one value and so bound by Spark's 2 GB limit on a value.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = "<start>"


@dataclass(frozen=True)
class Template:
    headers: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: str = "### Role "            # + escaped role + ": " for roles without a header
    end: str = "</turn>"
    between: str = "\n"                 # after every end
    loss_roles: tuple[str, ...] = ("assistant",)
    #: role automaton: state (last role) -> roles that may follow
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("user", "assistant")

    def __post_init__(self):
        """A control string must be breakable by one backslash, and an end must be found where it stands."""
        for c in self.controls():
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"control string {c!r}: at least two characters, no backslash")
        heads = [self.other, *self.headers.values()]
        if any(a.startswith(b) for i, a in enumerate(heads) for j, b in enumerate(heads) if i != j):
            raise ValueError("a header begins with another one")
        if any(self.end.endswith(self.end[:k]) for k in range(1, len(self.end))):
            raise ValueError(f"end {self.end!r} begins as it ends")
        if "\\" in self.between:
            raise ValueError("no backslash between turns")

    def controls(self) -> list[str]:
        return [self.end, self.other.rstrip(), *(h.rstrip() for h in self.headers.values())]


def escape(text: Column, t: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in t.controls():
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column, t: Template) -> Column:
    return F.replace(escape(role, t), F.lit(":"), F.lit("\\:"))


def _header(role: Column, t: Template) -> Column:
    out = F.concat(F.lit(t.other), _escaped_role(role, t), F.lit(": "))
    for name, head in t.headers.items():
        out = F.when(role == name, F.lit(head)).otherwise(out)
    return out


def _allowed(state: Column, role: Column, t: Template) -> Column:
    out = F.lit(False)
    for before, after in t.follows.items():
        out = F.when(state == before, role.isin(*after)).otherwise(out)
    return out


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def turn_segments(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: ``conv_id, turn, role, valid`` (does the automaton allow
    it) and ``segments``, an array of (text, loss) that concatenates to the turn."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = _turns(conversations)
    state = F.lag("role", 1, START).over(order)
    return turns.withColumn("valid", _allowed(state, F.col("role"), template)) \
        .select("conv_id", "turn", "role", "valid", _segments(F.col("role"), F.col("text"), template).alias("segments"))


def _segments(role: Column, text: Column, t: Template) -> Column:
    return F.array(
        F.struct(_header(role, t).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(text, t).alias("text"), role.isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(t.end + t.between).alias("text"), F.lit(False).alias("loss")))


def formatted(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, valid, first_bad``.

    ``segments`` are the (text, loss) pieces in order, ``formatted`` their
    concatenation, ``first_bad`` the 0-based place of the first turn that the
    automaton refuses (NULL if none); ``valid`` also asks for a final state."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    conv = _turns(conversations).groupBy("conv_id").agg(turns.alias("turns"))
    follow = F.transform("turns", lambda x, i: _allowed(
        F.when(i == 0, F.lit(START)).otherwise(F.get("turns", i - 1)["role"]), x["role"], template))
    bad = F.array_position(follow, False)
    conv = conv.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda x: _segments(x["role"], x["text"], template))).alias("segments"),
        F.when(bad > 0, (bad - 1).cast("int")).alias("first_bad"),
        F.element_at("turns", -1)["role"].isin(*template.final).alias("ends"))
    return conv.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                       (F.col("first_bad").isNull() & F.col("ends")).alias("valid"), "first_bad")


def read_back(formatted_text: Column, template: Template = Template()) -> Column:
    """The turns, array of (role, text), that a formatted string holds."""
    pieces = F.split(formatted_text, rf"\Q{template.end + template.between}\E", -1)  # the end escapes to something else inside texts

    def turn(p: Column) -> Column:
        # generic header: up to the first ": " whose colon is not escaped
        rest = F.substring(p, F.lit(len(template.other) + 1), F.length(p))
        role = unescape(F.regexp_extract(rest, r"(?s)^((?:[^\\:]|\\.)*+): ", 1))
        text = F.regexp_replace(rest, r"(?s)^(?:[^\\:]|\\.)*+: ", "")
        out = F.struct(role.alias("role"), unescape(text).alias("text"))
        for name, head in template.headers.items():
            body = F.substring(p, F.lit(len(head) + 1), F.length(p))
            out = F.when(F.startswith(p, F.lit(head)), F.struct(F.lit(name).alias("role"), unescape(body).alias("text"))).otherwise(out)
        return out
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def digests(conv: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of what ``formatted`` wrote, taken from its strings and segments."""
    turns = read_back(F.col("formatted"), template)
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return conv.withColumn("turns", turns).withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '<start>') AS before,
    replace(replace(replace(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### Role', '#\## Role'),
      '### System:', '#\## System:'), '### User:', '#\## User:'), '### Assistant:', '#\## Assistant:') AS escaped,
    CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' WHEN 'assistant' THEN '### Assistant: '
      ELSE '### Role ' || replace(replace(role, '\', '\\'), ':', '\:') || ': ' END AS head
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length(head) + length(escaped) + 8)::BIGINT AS formatted_chars,
  bool_and((before, role) IN (('<start>', 'system'), ('<start>', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
    AND arg_max(role, (turn, role, text)) IN ('user', 'assistant') AS valid
FROM e GROUP BY conv_id
"""
