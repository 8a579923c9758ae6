"""Chat formatting in budgeted windows. Built-in functions only.

Each turn has a number of tokens; prefix sums place the turns on a line. Windows are runs of whole turns: a window takes
new turns while they fit in what the budget leaves beside the system turn and the history, and at least one. Every
window starts with the system turn; later ones repeat the last turns before their first new one, as many as fit in the
history's share. Repeated turns are masked: the loss covers the text of each assistant turn once, where it is new.

A conversation may hold a large part of all rows, so no step needs all its turns in one task. Prefix sums are made
within runs of ``RUN`` turn numbers and then over runs. Windows are chosen within segments of the line, each as
long as ``SEGMENT`` windows and so of a bounded number of turns; a window never crosses a segment's end.
Texts are shuffled once to be put in order and once to be joined into windows: the choice of windows uses numbers only,
and the partitioning by conversation and segment serves the windows in it.

The template writes ``<|im_start|>role\\ntext<|im_end|>\\n``. Strings that mark control tokens of this or other
templates get a backslash after their first character (one more if they have some), which ``unescaped`` takes away again.
In roles, line ends and percent signs are percent-encoded.

Defined results: NULL roles and texts are empty. Turns are ordered by number (NULL first), then role, then text; repeated
rows are repeated turns. Turns of one conversation that share a number are put in order in one task. A NULL id is a
conversation of its own. The system turn is the first turn if its role is ``system``; system turns elsewhere are
ordinary ones. A turn longer than the budget stands alone, uncut, and its window is longer than the budget. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pyspark.sql import Window as W

from tidemark.llm.common import col, written

#: Tokens of a window, of which repeated history may take so many.
BUDGET, HISTORY = 1024, 128
#: Tokens that the marks of a turn count.
MARKS = 4
#: Turn numbers in a run of the prefix sums; windows in a segment.
RUN, SEGMENT = 1024, 64

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings without their first character, < or [.
_CONTROL = r"(/?s>|/?INST\]|</?SYS>>|\|\w+\|>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turn_tokens(text: Column) -> Column:
    """Words, digits and marks: a count near to that of usual vocabularies, made without leaving the JVM."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]")) + MARKS


def _key(conv: Column) -> Column:
    """The id as a text that is never NULL, so that one partitioning serves every step on a conversation."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def in_order(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, key, pos, role, text, tokens, upto): position and tokens up to and with each turn."""
    turns = rows.select(col(conv_col).alias("conv"), _key(col(conv_col)).alias("key"),
                        col(turn_col).cast("long").alias("turn"), F.coalesce(col(role_col), F.lit("")).alias("role"),
                        F.coalesce(col(text_col), F.lit("")).alias("text"))
    turns = turns.withColumn("tokens", turn_tokens(F.col("text")).cast("long")).withColumn(
        "run", F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 62))))  # turns without a number come first
    sums = turns.groupBy("key", "run").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    earlier = W.partitionBy("key").orderBy("run").rowsBetween(W.unboundedPreceding, -1)  # one row per run
    offsets = sums.select("key", "run", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    within = W.partitionBy("key", "run").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    counted = turns.withColumn("t", F.sum("tokens").over(within)).withColumn("n", F.count("*").over(within))
    return counted.join(offsets, ["key", "run"]).select(
        "conv", "key", (F.col("n0") + F.col("n") - 1).alias("pos"), "role", "text", "tokens",
        (F.col("t0") + F.col("t")).alias("upto"))


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id",
            turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv, first (position of its first new turn), n_turns, n_repeated, tokens, formatted,
    loss_spans (start and length in characters of the formatted text)."""
    turns = written(in_order(rows, conv_col, turn_col, role_col, text_col), "chat-turns")
    head = turns.filter((F.col("pos") == 0) & (F.col("role") == "system")).select(
        "key", F.col("text").alias("system_text"), F.col("tokens").alias("system_tokens"))
    room = F.greatest(F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)), F.lit(max(history, 16)))
    # the line starts behind the system turn, which itself has no length
    end = F.greatest(F.lit(0), F.col("upto") - F.coalesce("system_tokens", F.lit(0)))
    is_system = F.col("system_tokens").isNotNull() & (F.col("pos") == 0)

    def placed(df):
        length = F.col("room") * SEGMENT
        return (df.join(head.select("key", "system_tokens"), "key", "left").withColumn("room", room).withColumn("end", end)
                .withColumn("begin", F.when(is_system, 0).otherwise(F.col("end") - F.col("tokens")))
                .withColumn("segment", F.floor(F.col("begin") / length)))

    # first turns of the windows of a segment, greedily; numbers only
    line = F.sort_array(F.collect_list(F.struct("pos", "begin", "end")))
    empty = F.array().cast("array<struct<pos:bigint,begin:bigint>>")
    starts = placed(turns.drop("text", "role", "conv")).groupBy("key", "segment", "room").agg(line.alias("line")).select(
        "key", F.col("segment").alias("at"), F.aggregate("line", empty, lambda acc, t: F.when(
            (F.size(acc) == 0) | (t["end"] - F.element_at(acc, -1)["begin"] > F.col("room")),
            F.concat(acc, F.array(F.struct(t["pos"].alias("pos"), t["begin"].alias("begin"))))).otherwise(acc)
        ).alias("starts"))
    starts = written(starts, "chat-starts")

    # a turn near the end of its segment may be history in the next one
    spill = ~is_system & (F.col("begin") + history >= (F.col("segment") + 1) * F.col("room") * SEGMENT)
    reach = placed(turns).withColumn("at", F.explode(F.when(spill, F.array(F.col("segment"), F.col("segment") + 1))
                                                     .otherwise(F.array("segment"))))
    known = reach.join(starts, ["key", "at"])
    own = F.when(F.col("at") == F.col("segment"), F.element_at(F.filter("starts", lambda s: s["pos"] <= F.col("pos")), -1))
    later = F.filter("starts", lambda s: (s["pos"] > F.col("pos")) & (F.col("begin") >= s["begin"] - history) & ~is_system)
    first = F.concat(F.when(own.isNotNull(), F.array(F.struct(own["pos"].alias("first"), F.lit(True).alias("new"))))
                     .otherwise(F.array().cast("array<struct<first:bigint,new:boolean>>")),
                     F.transform(later, lambda s: F.struct(s["pos"].alias("first"), F.lit(False).alias("new"))))

    def part(role, text, pos, new, tokens):
        mark, body = F.concat(F.lit(START), _role_out(role), F.lit("\n")), escaped(text)
        return F.struct(pos.alias("pos"), new.alias("new"), tokens.alias("tokens"), F.char_length(mark).alias("mark"),
                        F.char_length(body).alias("size"), (role == "assistant").alias("spoken"),
                        F.concat(mark, body, F.lit(END)).alias("text")).alias("part")

    new_and_old = known.select("conv", "key", "at", "pos", "tokens", "role", "text", F.explode(first).alias("w")).select(
        "conv", "key", "at", F.col("w.first").alias("first"),
        part(F.col("role"), F.col("text"), F.col("pos"), F.col("w.new"), F.col("tokens")))
    # the system turn stands before every later window, as a repeated turn of position -1
    repeated = (starts.select("key", "at", F.explode("starts").alias("s")).filter("s.pos > 0")
                .join(head, "key").select("key", "at", F.col("s.pos").alias("first"), part(
                    F.lit("system"), F.col("system_text"), F.lit(-1).cast("long"), F.lit(False), F.col("system_tokens"))))
    packed = (new_and_old.unionByName(repeated, allowMissingColumns=True).groupBy("key", "at", "first")
              .agg(F.max("conv").alias("conv"), F.sort_array(F.collect_list("part")).alias("parts")))
    spans = F.aggregate(
        "parts", F.struct(F.lit(0).cast("long").alias("at"),
                          F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["mark"] + p["size"] + len(END)).cast("long").alias("at"),
            F.when(p["new"] & p["spoken"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + p["mark"]).cast("long").alias("start"), p["size"].cast("long").alias("length")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return packed.select(
        "conv", "first", F.size("parts").alias("n_turns"), F.size(F.filter("parts", lambda p: ~p["new"])).alias("n_repeated"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("tokens"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows say, per conversation: n_turns, digest of the turns, loss text, and size.

    Only the formatted texts, their masks and the number of repeated turns are read. A digest is sequential, so this
    report (not the formatting) brings a conversation's text together.
    """
    turns = F.slice(F.split("formatted", r"<\|im_end\|>\n", -1), F.col("n_repeated") + 1,
                    F.col("n_turns") - F.col("n_repeated"))

    def spoken(turn):
        line = F.substring_index(turn, "\n", 1)
        role = line.substr(F.lit(len(START) + 1), F.char_length(line))
        text = turn.substr(F.char_length(line) + 2, F.char_length(turn))
        return F.concat(_role_in(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.col("formatted").substr((s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    pieces = formatted.select("conv", F.struct(
        "first", F.size(turns).alias("n"), F.array_join(F.transform(turns, spoken), "").alias("turns"),
        loss.alias("loss"), F.char_length("formatted").alias("size")).alias("piece"))
    whole = pieces.groupBy("conv").agg(F.sort_array(F.collect_list("piece")).alias("p"))

    def joined(field):
        return F.array_join(F.transform("p", lambda x: x[field]), "")

    def total(field):
        return F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x[field])

    return whole.select(F.col("conv").alias("conv_id"), total("n").alias("n_turns"),
                        F.sha2(joined("turns"), 256).alias("turns_sha256"),
                        F.char_length(joined("loss")).cast("long").alias("loss_chars"),
                        F.sha2(joined("loss"), 256).alias("loss_sha256"), total("size").alias("formatted_chars"))
