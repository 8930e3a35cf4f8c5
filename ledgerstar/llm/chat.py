"""Dialogues rendered from the perspective of each participant. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.ranks import ranked
from ledgerstar.session import materialize

#: Turns of a dialogue that are rendered together; longer ones come in several parts.
PART_TURNS = 64

SYSTEM = "system"
END = "<|end|>\n"


def _header(turn: Column, speaker: Column) -> Column:
    return (
        F.when(turn["name"] == SYSTEM, F.lit("<|system|>\n"))
        .when(turn["name"] == speaker, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), turn["name"], F.lit("|>\n")))
    )


def _name(role: Column) -> Column:
    """A role as a header spells it; different roles, null too, never get the same name.

    ``|`` and line breaks would end a header. They become ``_p``, ``_r`` and ``_l``, an
    underscore two of them, and a null role ``_none``, which no other role gives.
    """
    for mark, spelled in (("_", "__"), ("|", "_p"), ("\r", "_r"), ("\n", "_l")):
        role = F.replace(role, F.lit(mark), F.lit(spelled))
    return F.coalesce(role, F.lit("_none"))


def perspectives(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Rotate each dialogue: one rendering per participant, who is the assistant in it.

    Columns ``conv_id, turn, role, text``. A participant is any role but ``system``, which
    stays system everywhere; the other participants are users with their names, spelled so that
    no two are alike (see ``_name``). Turns follow ``turn`` (null first), ties by role and text. A turn is a header line, the text, and an end
    mark; ``<|`` in a text is written ``< |``, so that no text can pass for a mark. The mask
    ``spans`` are the character ranges [start, end) of ``text`` that the assistant is to learn:
    its texts with their end marks, never headers.

    Returns ``conv_id, speaker, part, first_turn, n_turns, text, spans``: dialogues longer than
    ``part_turns`` turns come in parts, in order, so that no task renders an unbounded one. The
    text of a whole dialogue is that of its parts one after another. ``speaker`` is the role as
    it is in the table. A null role is a participant of its own, a null text is empty; a null
    ``conv_id`` is a dialogue of its own. A dialogue of system turns alone has no participant
    and no row. Repeated rows are turns each.

    Speakers meet the parts of their dialogue by narrow rows first, so the texts of a dialogue
    with very many turns are joined part by part and never come together in one task.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    turns = ranked(turns, "conv_id", ["turn", "role", "text"], "turns")
    turns = turns.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("unnamed"),
        F.floor(F.col("rank") / part_turns).cast("int").alias("part"),
        "rank",
        "role",
        _name(F.col("role")).alias("name"),
        "text",
    )
    turns = materialize(turns, "ranked")
    dialogue, part = ["conv", "unnamed"], ["conv", "unnamed", "part"]
    speakers = turns.filter(F.col("name") != SYSTEM).select(
        *dialogue, F.col("name").alias("speaker"), F.col("role").alias("who")
    )
    places = turns.select(*part).distinct().join(speakers.distinct(), dialogue)
    parts = turns.groupBy(*part).agg(
        F.min("rank").alias("first_turn"),
        F.array_sort(F.collect_list(F.struct("rank", "name", "text"))).alias("turns"),
    )
    rotated = parts.join(places, part)

    speaker = F.col("speaker")
    rendered = F.transform(
        "turns",
        lambda t: F.struct(
            _header(t, speaker).alias("header"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            (t["name"] == speaker).alias("learn"),
        ),
    )
    # The end of each turn so far: a running sum of lengths over a bounded number of turns.
    sizes = F.transform(
        "rendered", lambda r: F.char_length(r["header"]) + F.char_length(r["body"])
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.size("sizes")),
        lambda n: F.aggregate(F.slice("sizes", F.lit(1), n), F.lit(0), lambda a, x: a + x),
    )
    spans = F.transform(
        F.filter(F.arrays_zip("rendered", "ends"), lambda z: z["rendered"]["learn"]),
        lambda z: F.struct(
            (z["ends"] - F.char_length(z["rendered"]["body"])).alias("start"),
            z["ends"].alias("end"),
        ),
    )
    text = F.array_join(
        F.transform("rendered", lambda r: F.concat(r["header"], r["body"])), ""
    )
    return (
        rotated.withColumn("rendered", rendered)
        .withColumn("sizes", sizes)
        .withColumn("ends", ends)
        .select(
            F.when(~F.col("unnamed"), F.col("conv")).alias("conv_id"),
            F.col("who").alias("speaker"),
            "part",
            "first_turn",
            F.size("turns").alias("n_turns"),
            text.alias("text"),
            spans.alias("spans"),
        )
    )
