r"""Conversations as training text: turn-aligned windows of bounded size, with repeated context and a loss mask.

A turn is written ``<|role|>text</s>``. Control strings inside texts and roles are escaped reversibly: after the
first character of ``<|``, ``<s>``, ``</s>``, ``[INST]`` or ``[/INST]``, with any number of backslashes behind that
character, one more backslash is put; a role's ``|>`` is treated alike. Reading takes one backslash away. So no text
holds a control string, and every text comes back as it was.

Sizes are counted in words plus ``MARKS`` for a turn's marks. Prefix sums of these sizes, one running sum for each
conversation, choose the windows: a window takes the longest run of next turns that fits what ``budget`` leaves
beside the system turn and the history, and always at least one. A first turn by ``system`` opens every window. From
the second window on, the last turns before the run are repeated: at most ``repeats``, of at most ``history``
together. The mask holds the texts of assistant turns (start and length in code points) where they are new; repeated
ones are left out, so each is learnt once. A window passes the budget only where one turn, with the system turn,
passes it alone; no turn is cut.

``read_back`` parses windows, drops what each repeats, and gives the conversations again.

Nulls: turns are ordered by turn, null first, repeated numbers by role and text; null roles and texts are empty; rows
without conv_id are one conversation of their own. An empty table has an empty result; extra columns are not read.
A conversation's turns have to fit into one row, since its digest is over all of them. All work is done by DataFrame
functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORDS = r"[^ \t-\r]+"
MARKS = 2
END = "</s>"

_TAIL = r"(/?s>|/?INST\]|\|)"
_ESCAPES = (rf"([<\[])(\\*){_TAIL}", r"$1\\$2$3"), (r"(\|)(\\*)>", r"$1\\$2>")
_READS = (rf"([<\[])\\(\\*){_TAIL}", "$1$2$3"), (r"(\|)\\(\\*)>", "$1$2>")


@dataclass(frozen=True)
class Budget:
    """Sizes in words and marks: of a window, and of the turns that it repeats, which are at most ``repeats``."""

    budget: int = 1024
    history: int = 256
    repeats: int = 4


def escaped(text: Column, role: bool = False) -> Column:
    for pattern, by in _ESCAPES[:1 + role]:
        text = F.regexp_replace(text, pattern, by)
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    for pattern, by in reversed(_READS[:1 + role]):
        text = F.regexp_replace(text, pattern, by)
    return text


def _turns(rows: DataFrame) -> DataFrame:
    """Turns in order (``i`` from 1), as written, with sizes and running sums before each."""
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sized = rows.select(
        "conv_id", "turn", "role", "text", F.concat(F.lit("<|"), escaped(F.col("role"), True), F.lit("|>")).alias("head"),
        escaped(F.col("text")).alias("body"), (F.regexp_count("text", F.lit(WORDS)) + MARKS).cast("long").alias("size"))
    sized = sized.withColumn("chars", (F.length("head") + F.length("body") + len(END)).cast("long"))
    return sized.select(
        "conv_id", F.row_number().over(order).alias("i"), "role", "head", "body", "size", "chars",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("at"))


def windows(rows: DataFrame, how: Budget = Budget()) -> DataFrame:
    """``(conv_id, window, first_turn, n_turns, n_repeated, n_tokens, text, mask)``; ``first_turn`` is the first new one, from 1."""
    whole = _turns(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", "role", "head", "body", "size", "chars", "ahead", "at"))).alias("t"))
    lead = F.when(F.col("t")[0]["role"] == "system", F.slice("t", 1, 1)).otherwise(F.slice("t", 1, 0))
    whole = whole.withColumn("lead", lead).withColumn("s", F.size("lead")).withColumn(
        "lead_size", F.coalesce(F.get("lead", F.lit(0))["size"], F.lit(0))).withColumn("lead_chars", F.coalesce(F.get("lead", F.lit(0))["chars"], F.lit(0)))

    # The first turn of each window: one pass over the prefix sums.
    room = F.lit(how.budget) - F.col("lead_size")
    start = F.struct(F.array(F.col("s") + 1).alias("starts"), F.col("lead_size").alias("origin"))

    def step(now: Column, x: Column) -> Column:
        left = F.when(F.size(now["starts"]) == 1, room).otherwise(F.greatest(room - how.history, F.lit(1)))
        over = (x["ahead"] + x["size"] - now["origin"] > left) & (x["ahead"] > now["origin"])
        return F.when(over, F.struct(F.concat(now["starts"], F.array(x["i"])).alias("starts"), x["ahead"].alias("origin"))).otherwise(now)

    starts = F.aggregate(F.slice("t", F.col("s") + 1, F.size("t")), start, step, lambda x: x["starts"])
    whole = whole.withColumn("starts", starts)

    def window(first: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("starts", k + 1), F.size("t") + 1)
        new = F.slice(F.col("t"), first, stop - first)
        oldest = F.greatest(F.col("s") + 1, first - how.repeats)
        held = F.get(F.col("t"), first - 1)["ahead"]
        past = F.filter(F.slice(F.col("t"), oldest, first - oldest), lambda y: held - y["ahead"] <= how.history)
        past = F.when(k > 0, past).otherwise(F.slice("t", 1, 0))
        return F.struct(k.alias("window"), first.alias("first_turn"), past.alias("past"), new.alias("new"))

    each = whole.select("conv_id", "lead", "s", "lead_chars", F.explode(F.transform("starts", window)).alias("w")).select(
        "conv_id", "lead", "s", "lead_chars", "w.*").withColumn("run", F.concat("past", "new"))
    shown = F.concat("lead", "run")
    # Within a window the run is contiguous in the conversation, so running sums of characters place its texts.
    origin = F.coalesce(F.get("run", F.lit(0))["at"], F.lit(0))
    places = F.transform(F.filter("new", lambda y: y["role"] == "assistant"), lambda y: F.struct(
        (F.col("lead_chars") + y["at"] - origin + F.length(y["head"])).cast("long").alias("start"), F.length(y["body"]).cast("long").alias("length")))
    return each.select(
        "conv_id", "window", "first_turn", F.size(shown).alias("n_turns"), (F.when(F.col("window") > 0, F.col("s")).otherwise(0) + F.size("past")).alias("n_repeated"),
        F.aggregate(shown, F.lit(0).cast("long"), lambda a, y: a + y["size"]).alias("n_tokens"),
        F.array_join(F.transform(shown, lambda y: F.concat(y["head"], y["body"], F.lit(END))), "").alias("text"), places.alias("mask"))


def read_back(parts: DataFrame) -> DataFrame:
    """``(conv_id, turns, loss, formatted_chars)`` from windows: new turns in order, the texts under the mask, the length of all text."""
    def turn(piece: Column) -> Column:
        bar = F.call_function("locate", F.lit("|>"), piece, F.lit(3))
        return F.struct(unescaped(F.substring(piece, F.lit(3), bar - 3), True).alias("role"), unescaped(F.substring(piece, bar + 2, F.length(piece))).alias("text"))

    pieces = F.split("text", END, -1)
    new = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    loss = F.transform("mask", lambda m: unescaped(F.substring(F.col("text"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    part = F.struct("window", F.transform(new, turn).alias("turns"), loss.alias("loss"), F.length("text").alias("chars"))
    return parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("p")).select(
        "conv_id", F.flatten("p.turns").alias("turns"), F.flatten("p.loss").alias("loss"),
        F.aggregate("p.chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("formatted_chars"))


def digests(conversations: DataFrame) -> DataFrame:
    """What was read back, as counts and digests."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return conversations.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                                F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
