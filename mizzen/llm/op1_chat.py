"""Chat formatting: a state machine over roles, a declarative template, segments with loss flags.

A template says how a turn opens and closes, which roles bear loss, and which role may follow
which. Every turn becomes three segments: the opening mark with the role, the text, the closing
mark; only the text of a role that bears loss has the loss flag. The formatted conversation is the
segments joined.

Control strings inside roles and texts are made harmless reversibly: every backslash is doubled, then
a backslash is put after the first character of each control string. An escaped text holds no
control string, so the marks in the output are the template's own, and ``read_turns`` gets roles
and texts back from the output alone.

Turn order: the machine starts in ``start``; a turn whose role is not among the state's successors
makes the conversation invalid from there. Invalid conversations are formatted all the same, with
``valid`` false and the number of the first bad turn.

Main path: DataFrame operations; one group is one conversation, whose output is one row.

Defined results: null text and null role are empty; rows with equal turn numbers are ordered by role
and text; a null conv_id is a conversation of its own; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import let


@dataclass(frozen=True)
class Template:
    """How a conversation is written down."""

    begin: str = "<s>"
    open: str = "<|"
    opened: str = "|>\n"
    close: str = "</s>\n"
    loss_roles: Sequence[str] = ("assistant",)
    #: State to the roles that may come next; a role leads to the state of its own name.
    order: dict[str, Sequence[str]] = field(default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    #: Strings that must not occur in a text as they stand.
    control: Sequence[str] = ("<s>", "</s>", "<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column, template: Template) -> Column:
    """``text`` without any control string, reversibly."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.control:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _bad_turn(turns: Column, template: Template) -> Column:
    """Number, from 0, of the first turn out of order; -1 if there is none."""
    follow = F.lit(False)
    states = {state: F.array(*[F.lit(r) for r in roles]) for state, roles in template.order.items()}

    def step(s: Column, turn: Column) -> Column:
        allowed = follow
        for state, roles in states.items():
            allowed = allowed | ((s["state"] == state) & F.array_contains(roles, turn["role"]))
        bad = F.when(s["bad"] >= 0, s["bad"]).when(allowed, F.lit(-1)).otherwise(s["at"])
        return F.struct(turn["role"].alias("state"), (s["at"] + 1).alias("at"), bad.alias("bad"))

    begin = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))
    return F.aggregate(turns, begin, step, lambda s: s["bad"])


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted, valid, bad_turn."""
    for a in (template.open, template.opened.strip(), template.close.strip(), template.begin):
        if a not in template.control:
            raise ValueError(f"{a!r} marks turns but is not a control string")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", role.alias("role"), text.alias("text"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    loss = F.array(*[F.lit(r) for r in template.loss_roles])

    def segments(t: Column) -> Column:
        mark = F.concat(F.lit(template.open), escape(t["role"], template), F.lit(template.opened))
        plain = lambda x: F.struct(x.alias("text"), F.lit(False).alias("loss"))
        return F.array(plain(mark), F.struct(escape(t["text"], template).alias("text"), F.array_contains(loss, t["role"]).alias("loss")), plain(F.lit(template.close)))

    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    made = grouped.withColumn("segments", F.concat(begin, F.flatten(F.transform("turns", segments))))
    bad = _bad_turn(F.col("turns"), template)
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return made.select("conv_id", "segments", formatted.alias("formatted"), (bad < 0).alias("valid"), bad.alias("bad_turn"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    parts = F.split(body, "\\Q" + template.close + "\\E")

    def turn(part: Column) -> Column:
        at = F.instr(part, template.opened)
        role = F.substring(part, F.lit(len(template.open) + 1), at - len(template.open) - 1)
        text = F.substring(part, at + len(template.opened), F.lit(2**31 - 1))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return let(parts, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), turn))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    made = format_conversations(rows.unionByName(extra))
    turns = read_turns(F.col("formatted"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    out = made.withColumn("turns", turns).withColumn("loss", loss)
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
        F.col("bad_turn").cast("bigint").alias("bad_turn"),
    )


_ESCAPED = "replace(x, '\\', '\\\\')"
for _mark in Template().control:
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark[0]}\\{_mark[1:]}')"
SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER w - 1 AS i, lag(role) OVER w AS before,
         length({_ESCAPED.replace("x", "text", 1)}) + length({_ESCAPED.replace("x", "role", 1)}) + {len("<||>") + 1 + len("</s>") + 1} AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), b AS (
  SELECT conv_id, min(i) AS bad FROM n
  WHERE NOT CASE WHEN i = 0 THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user' WHEN before = 'user' THEN role = 'assistant' ELSE false END
  GROUP BY conv_id
), g AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss, (sum(chars) + 3)::BIGINT AS formatted_chars
  FROM n GROUP BY conv_id
)
SELECT g.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
       bad IS NULL AS valid, coalesce(bad, -1)::BIGINT AS bad_turn
FROM g LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM g.conv_id
"""
