"""Chat formatting in budgeted windows, in DataFrame functions only.

The turns of a conversation are cut into windows by prefix sums of their tokens.
A window holds the system turn, at most ``history`` tokens of the turns before
it, repeated, and new turns up to the rest of ``budget``; turns are never cut,
and a new turn too long for a window stands alone in one. The loss mask covers
the assistant texts of new turns, so each is a target once.

Template: ``<|turn|>role<|text|>text<|end|>``, with ``<|again|>`` in place of
``<|turn|>`` on repeated turns. Inside roles and texts ``<`` becomes ``<~``, so
no control string can occur there and the original can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 128
TURN, AGAIN, TEXT, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"
TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def escape(c: Column) -> Column:
    return F.replace(c, F.lit("<"), F.lit("<~"))


def unescape(c: Column) -> Column:
    return F.replace(c, F.lit("<~"), F.lit("<"))


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, loss_spans array<struct<from,upto>>, n_tokens): code-point spans, ends exclusive.

    Turns are in the order of (turn, role, text), so ties and repeated rows have
    a place; a null turn comes first, null role and text are empty, a null
    conv_id is a conversation. Other columns are not read. A conversation is one
    row here, as its digests need; conversations are otherwise independent.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", (F.regexp_count("text", F.lit(TOKEN)) + 1).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("place", F.row_number().over(order))
    t = F.col("t")
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text", "tokens", "upto"))).alias("t"))
    first = F.when(F.get(t, F.lit(0))["role"] == "system", F.lit(1)).otherwise(F.lit(0))
    convs = convs.withColumn("first", first).withColumn("room", F.greatest(F.lit(1).cast("long"), F.lit(budget - history) - F.col("first") * F.get(t, F.lit(0))["tokens"]))
    # a new window starts where the prefix sum passes the room left since the last start
    state = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("base"))

    def step(s: Column, i: Column) -> Column:
        turn = F.get(t, i)
        fresh = (F.size(s["starts"]) == 0) | (turn["upto"] - s["base"] > F.col("room"))
        return F.when(fresh, F.struct(F.concat(s["starts"], F.array(i)).alias("starts"), (turn["upto"] - turn["tokens"]).alias("base"))).otherwise(s)

    starts = F.aggregate(F.when(F.size(t) > F.col("first"), F.sequence(F.col("first"), F.size(t) - 1)).otherwise(F.array().cast("array<int>")), state, step, lambda s: F.when(F.size(s["starts"]) > 0, s["starts"]).otherwise(F.array(F.col("first"))))
    convs = convs.withColumn("starts", starts)

    def window(k: Column) -> Column:
        frm = F.get("starts", k)
        upto = F.coalesce(F.get("starts", k + 1), F.size(t))
        before = F.when((frm > F.col("first")) & F.lit(history > 0), F.sequence(F.greatest(F.col("first"), frm - max(history, 1)), frm - 1)).otherwise(F.array().cast("array<int>"))
        told = F.get(t, frm - 1)["upto"]
        n = F.size(F.filter(before, lambda j: told - F.get(t, j)["upto"] + F.get(t, j)["tokens"] <= history))
        turns = F.concat(F.when(F.col("first") == 1, F.slice(t, 1, 1)).otherwise(F.slice(t, 1, 0)), F.slice(t, frm - n + 1, upto - frm + n))
        return F.struct(k.alias("window"), turns.alias("turns"), F.when(k == 0, F.lit(0)).otherwise(F.col("first") + n).alias("again"))

    wins = convs.select("conv_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("starts") - 1), window)).alias("x")).select("conv_id", "x.window", "x.turns", "x.again")
    head = lambda r, i: F.concat(F.when(i < F.col("again"), F.lit(AGAIN)).otherwise(F.lit(TURN)), escape(r["role"]), F.lit(TEXT))
    parts = F.transform("turns", lambda r, i: F.struct(head(r, i).alias("head"), escape(r["text"]).alias("body"), ((r["role"] == "assistant") & (i >= F.col("again"))).alias("target"), r["tokens"].alias("tokens")))
    wins = wins.select("conv_id", "window", parts.alias("parts"))
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,upto:int>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(END)).alias("at"),
            F.when(p["target"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.char_length(p["head"])).alias("from"), (s["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("upto"))))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return wins.select("conv_id", "window", formatted.alias("formatted"), spans.alias("loss_spans"), F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["tokens"]).alias("n_tokens"))


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted windows alone."""
    cut = F.split("formatted", r"<\|end\|>", -1)
    new = F.filter(F.slice(cut, F.lit(1), F.size(cut) - 1), lambda x: x.startswith(TURN))
    halves = F.transform(new, lambda x: F.split(F.substr(x, F.lit(len(TURN) + 1)), r"<\|text\|>", 2))
    turns = F.array_join(F.transform(halves, lambda h: F.concat(unescape(h[0]), F.lit("\n"), unescape(h[1]), F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["from"] + 1, s["upto"] - s["from"]))), "")
    each = windows.select("conv_id", "window", F.size(new).cast("long").alias("n"), turns.alias("turns"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("chars"))
    of = each.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    whole = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    of = of.select("conv_id", "n_turns", whole("turns").alias("turns"), whole("loss").alias("loss"), "formatted_chars")
    return of.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
