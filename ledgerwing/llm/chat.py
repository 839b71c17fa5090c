"""Chat formatting: a finite-state machine over roles and marked-up text with loss flags.

A :class:`Template` states the control strings, the roles that are learned and which
role may follow which. Everything here is DataFrame functions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Turn numbers that are formatted together; a longer conversation is dealt out in such chunks.
CHUNK_TURNS = 1024
#: Stands for a line feed in a role.
LINE_FEED = "<|lf|>"


class Template(NamedTuple):
    """How a turn is written: ``start role \\n text end \\n``.

    ``moves`` gives, for each state, the roles that may follow and the state that they
    lead to; ``accepts`` the states that a complete conversation ends in. Control
    strings start with ``<|``, which escaped texts never hold.
    """

    start: str
    end: str
    learned: tuple[str, ...]
    first: str
    moves: dict[str, dict[str, str]]
    accepts: tuple[str, ...]


CHATML = Template(
    start="<|im_start|>",
    end="<|im_end|>",
    learned=("assistant",),
    first="begin",
    moves={
        "begin": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    accepts=("answered",),
)


def escape(text: Column) -> Column:
    """Text without ``<|``: one more backslash in each ``<``, backslashes, ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


class Machine:
    """The states of a template as numbers; one more number stands for a forbidden order."""

    def __init__(self, template: Template):
        self.names = [template.first, *(s for s in template.moves if s != template.first)]
        self.names += sorted(
            {s for to in template.moves.values() for s in to.values()} - set(self.names)
        )
        self.rejected = len(self.names)
        number = {s: i for i, s in enumerate(self.names)}
        self.accepts = [number[s] for s in template.accepts]
        self.by_role = {
            role: [
                number[template.moves[s][role]] if role in template.moves.get(s, {}) else self.rejected
                for s in self.names
            ]
            + [self.rejected]
            for role in sorted({r for to in template.moves.values() for r in to})
        }

    def run(self, roles: Column) -> Column:
        """The state that a row of roles leads to, from each state (so that runs can be chained)."""

        def numbers(states: list[int]) -> Column:
            return F.array(*[F.lit(s) for s in states])

        nowhere = numbers([self.rejected] * (self.rejected + 1))
        if not self.by_role:
            return F.when(F.size(roles) > 0, nowhere).otherwise(numbers([*range(self.rejected + 1)]))
        moves = F.create_map(*[x for r, to in self.by_role.items() for x in (F.lit(r), numbers(to))])

        def step(states: Column, role: Column) -> Column:
            to = F.coalesce(F.try_element_at(moves, role), nowhere)
            return F.transform(states, lambda s: F.get(to, s))

        return F.aggregate(roles, numbers([*range(self.rejected + 1)]), step)

    def chain(self, runs: Column) -> Column:
        """The state after several runs, from the first state on."""
        return F.aggregate(runs, F.lit(0), lambda state, run: F.get(run, state))

    def name(self, state: Column) -> Column:
        return F.get(F.array(*[F.lit(s) for s in self.names]), state)


def format_chunks(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation and ``CHUNK_TURNS`` turn numbers: its text, segments and state moves.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. Columns: ``conv_id``,
    ``chunk``, ``n_turns``, ``formatted``, ``segments`` (text and whether it is learned),
    ``moves`` (state reached from each state). Chunks in order make up a conversation,
    so one with any number of turns is dealt over many tasks.
    """
    if not (template.start.startswith("<|") and template.end.startswith("<|")):
        raise ValueError("control strings start with <|")
    machine = Machine(template)
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = turns.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-(1 << 62))).alias("chunk"),
        F.struct(F.col("turn"), role.alias("role"), text.alias("text")).alias("t"),
    )
    grouped = kept.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    in_role = F.lit(template.start)

    def parts(t: Column) -> Column:
        name = F.replace(escape(t["role"]), F.lit("\n"), F.lit(LINE_FEED))
        return F.array(
            F.struct(F.concat(in_role, name, F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(
                escape(t["text"]).alias("text"), t["role"].isin(*template.learned).alias("loss")
            ),
            F.struct(F.lit(template.end + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    cut = grouped.select(
        "conv_id",
        "chunk",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
        machine.run(F.transform("turns", lambda t: t["role"])).alias("moves"),
    )
    return cut.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted``, ``segments``, ``state``, ``valid``, ``complete``.

    Turns are in the order of their number; turns of one number in the order of role,
    then text, and repeated rows are turns of their own. A NULL text or role is empty, a
    NULL number comes first, NULL ``conv_id`` is one conversation. Forbidden orders and
    unknown roles are formatted like others and get ``valid`` false and no ``state``;
    ``complete`` means that the last state accepts. Other columns of ``turns`` are
    ignored; no rows give no rows. A conversation becomes one cell (2 GB at most); use
    :func:`format_chunks` where that is too small.
    """
    machine = Machine(template)
    chunks = written(format_chunks(turns, template), "chat-chunks")
    # Nearly all conversations are one chunk: only the longer ones are shuffled again.
    numbers = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_chunks")).where("n_chunks > 1")
    longer = numbers.select(F.col("conv_id").alias("long_id"))
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    whole = chunks.join(longer, same, "left_anti").select(
        "conv_id", "n_turns", "formatted", "segments", machine.chain(F.array("moves")).alias("at")
    )
    pieces = F.sort_array(F.collect_list(F.struct("chunk", "n_turns", "formatted", "segments", "moves")))
    joined = (
        chunks.join(longer, same, "left_semi")
        .groupBy("conv_id")
        .agg(pieces.alias("p"))
        .select(
            "conv_id",
            F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["n_turns"]).alias("n_turns"),
            F.array_join(F.col("p.formatted"), "").alias("formatted"),
            F.flatten(F.col("p.segments")).alias("segments"),
            machine.chain(F.col("p.moves")).alias("at"),
        )
    )
    return whole.unionByName(joined).select(
        "conv_id",
        "n_turns",
        "formatted",
        "segments",
        machine.name(F.col("at")).alias("state"),
        (F.col("at") != machine.rejected).alias("valid"),
        F.col("at").isin(*machine.accepts).alias("complete"),
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (``role``, ``text``) that a formatted conversation was made from."""
    parts = F.split(formatted, rf"\Q{template.start}\E")
    tail = len(template.end) + 1

    def turn(part: Column) -> Column:
        name = F.substring_index(part, "\n", 1)
        taken = F.length(name) + 1
        body = F.substr(part, taken + 1, F.length(part) - taken - tail)
        return F.struct(
            unescape(F.replace(name, F.lit(LINE_FEED), F.lit("\n"))).alias("role"),
            unescape(body).alias("text"),
        )

    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def learned_texts(segments: Column) -> Column:
    """The texts under the loss mask, as they were before escaping."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
