"""Chat formatting with Spark expressions: turns of a conversation to one marked string with a loss mask, and back.

The turns of a conversation are collected as structs and sorted; runs of adjacent turns of one role are cut out of the
array and become one marked turn whose texts are parted by `PART`. The result holds the string and its segments, text and
whether it is under the loss, whose concatenation is that string. Only the words of assistants are under the loss.

Control strings inside texts and roles get one more backslash behind their first character, `</s>` becomes `<\\/s>` and
`<\\/s>` becomes `<\\\\/s>`, so that no text holds a control string and reading takes the backslash away again.

Edge cases: turns are ordered by turn (null first), role, text; a null text or role is empty; rows whose conversation is
null form one conversation, whose id is null; repeated rows are turns of their own; an empty table gives an empty result;
other columns are not read. A conversation is one string, so its rows meet in one task, as the result does.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"
# The strings that texts must not hold: the template's own and those of common templates.
CONTROL = r"<(\\*)(\|(?:turn|text|part|end|endoftext|im_start|im_end)\||/?s)>"
CONTROL_SQUARE = r"\[(\\*)(/?INST)\]"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    text = F.regexp_replace(text, CONTROL, r"<\\$1$2>")
    return F.regexp_replace(text, CONTROL_SQUARE, r"[\\$1$2]")


def unescaped(text: Column) -> Column:
    text = F.regexp_replace(text, CONTROL.replace(r"(\\*)", r"\\(\\*)"), "<$1$2>")
    return F.regexp_replace(text, CONTROL_SQUARE.replace(r"(\\*)", r"\\(\\*)"), "[$1$2]")


def collected(turns: DataFrame) -> DataFrame:
    """conv_id, turns: sorted array of (turn, role, text)."""
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))


def merged(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, texts), where adjacent turns of one role are one."""
    n = F.size("turns")
    role = lambda i: F.get("turns", i)["role"]
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role(i) != role(F.greatest(i - 1, F.lit(0)))))
    df = conversations.withColumn("_starts", starts)
    ends = F.concat(F.slice("_starts", 2, F.size("_starts")), F.array(n))
    df = df.withColumn("_runs", F.zip_with("_starts", ends, lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    texts = lambda r: F.transform(F.slice("turns", r["a"] + 1, r["b"] - r["a"]), lambda t: t["text"])
    made = F.transform("_runs", lambda r: F.struct(role(r["a"]).alias("role"), texts(r).alias("texts")))
    return df.select("conv_id", made.alias("turns"))


def formatted(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, formatted, segments: array of (text, loss), one row per conversation."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    off = F.lit(False)

    def of_turn(t: Column) -> Column:
        head = F.array(piece(F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT)), off))
        body = F.transform(
            t["texts"],
            lambda x, i: F.array(piece(F.when(i > 0, F.lit(PART)).otherwise(F.lit("")), off), piece(escaped(x), t["role"] == loss_role)),
        )
        return F.concat(head, F.flatten(body), F.array(piece(F.lit(END), off)))

    segments = F.filter(F.flatten(F.transform("turns", of_turn)), lambda s: s["text"] != "")
    df = merged(collected(turns)).select("conv_id", segments.alias("segments"))
    return df.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parsed(texts: DataFrame) -> DataFrame:
    """The turns read back from `formatted`: conv_id, turns: array of (role, text), every text a turn of its own."""
    cut = lambda text, mark: F.split(text, F.lit("\\Q" + mark + "\\E"), -1)
    marked = F.filter(cut(F.col("formatted"), END), lambda t: t != "")

    def of_turn(t: Column) -> Column:
        role = unescaped(F.substring_index(F.substring(t, F.lit(len(TURN) + 1), F.length(t)), TEXT, 1))
        body = F.substring(t, F.locate(TEXT, t) + len(TEXT), F.length(t))
        return F.transform(cut(body, PART), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    return texts.select("conv_id", F.flatten(F.transform(marked, of_turn)).alias("turns"))


def digests(formatted_: DataFrame) -> DataFrame:
    """What the output holds: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = parsed(formatted_.select("conv_id", "formatted", "segments").withColumn("conv_id", F.struct("conv_id", "formatted", "segments")))
    read = read.select(F.col("conv_id.conv_id").alias("conv_id"), F.col("conv_id.formatted").alias("formatted"), F.col("conv_id.segments").alias("segments"), "turns")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    df = read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                     under.alias("_under"), F.length("formatted").cast("long").alias("formatted_chars"))
    return df.select("conv_id", "n_turns", "turns_sha256", F.length("_under").cast("long").alias("loss_chars"),
                     F.sha2("_under", 256).alias("loss_sha256"), "formatted_chars")
