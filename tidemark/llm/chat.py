r"""Chat formatting into budgeted windows, in built-in expressions only.

Turns are rendered as ``<|turn|>role<|text|>text<|end|>``.  Roles and texts are escaped: a backslash becomes two,
and behind each ``<`` and ``[`` comes a backslash, so no control string of this or another template survives inside
a text, and removing the backslashes gives the text back.  A window is a span of turns with the conversation's system
turn and the last turns before the span, as many as a limited history holds, or the turn before alone if that is longer
and the budget holds it; the span takes turns while all of this fits the budget, so a turn stands alone
only where its neighbours don't fit.  Turns that another window owns are repeated for context only, and the loss mask
covers own assistant texts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marks of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Tokens of a window, and of the turns repeated from before it; tokens that the marks of a turn count as.
BUDGET, HISTORY, MARKS = 1024, 256, 3
#: What counts as a token: a run of word characters, or another visible character.
TOKEN = r"\w+|[^\w\s]"
#: Turn numbers that are summed in one task before blocks of turns are; turns behind which a span ends in any case, so
#: that one task needn't follow a conversation of any length.
BLOCK, LEAP = 512, 8192


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\|\\(\\)", "$1$2")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def placed(turns: DataFrame) -> DataFrame:
    """Each turn with its position, the tokens of its conversation before it, and those of the conversation's system turn.

    Prefix sums run over blocks of turns first, so a conversation of any length is spread over tasks.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK)).withColumn("tokens", (F.regexp_count("text", F.lit(TOKEN)) + MARKS).cast("long"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("pos", F.count("*").over(inside)).withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    # The first row of the lowest block may be the conversation's system turn, which stands outside the sums.
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("tokens").alias("sum"), F.count("*").alias("n"), F.min(F.struct("turn", "role", "text", "tokens")).alias("first"))
    along = Window.partitionBy("conv_id").orderBy("block")
    past, every = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv_id")
    heads = blocks.withColumns({
        "pos0": F.coalesce(F.sum("n").over(past), F.lit(0)), "before0": F.coalesce(F.sum("sum").over(past), F.lit(0)),
        "opening": F.min(F.struct("block", "first")).over(every)["first"],
    }).withColumn("system", F.when(F.col("opening.role") == "system", F.col("opening.tokens")).otherwise(F.lit(0)).cast("long"))
    heads = heads.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "pos0", "before0", "system")
    at = numbered.join(heads, _same("conv_id", "_c") & (F.col("block") == F.col("_b"))).withColumn("pos", F.col("pos") + F.col("pos0"))
    at = at.withColumn("is_system", (F.col("pos") == 0) & (F.col("system") > 0)).withColumn("before", F.when(F.col("is_system"), 0).otherwise(F.col("before") + F.col("before0") - F.col("system")))
    return at.select("conv_id", "pos", "role", "text", "tokens", "before", "is_system", "system")


def spans(at: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, from, start, end) of ``placed`` turns: a span owns positions start to end, its history begins at from."""
    # A turn has MARKS tokens at least: no more turns than these are history, and a conversation that fits has no leap.
    leap, reach = max(LEAP, budget, history), max(history, 0) // MARKS + 1
    k = F.floor(F.col("pos") / leap)
    rows = at.where("not is_system").withColumn("leap", F.explode(F.when(F.col("pos") % leap >= leap - reach, F.array(k, k + 1)).otherwise(F.array(k))))
    per = rows.groupBy("conv_id", "leap").agg(F.sort_array(F.collect_list(F.struct("pos", "tokens", "before"))).alias("t"), F.first("system").alias("system"))
    room, first = F.lit(budget) - F.col("system"), F.col("t")[0]["pos"]

    def opened(acc, x):
        earlier = F.slice("t", F.greatest(F.lit(1), x["pos"] - first - reach + 1).cast("int"), F.least(F.lit(reach), x["pos"] - first).cast("int"))
        back = lambda y: x["before"] - y["before"]
        kept = F.filter(earlier, lambda y: (F.lit(history) > 0) & (back(y) <= room - x["tokens"]) & ((back(y) <= history) | (y["pos"] == x["pos"] - 1)))
        made = F.transform(F.array(F.get(kept, F.lit(0))), lambda y: F.struct(
            (x["tokens"] + F.coalesce(back(y), F.lit(0))).alias("used"),
            F.concat(acc["spans"], F.array(F.struct(F.coalesce(y["pos"], x["pos"]).alias("from"), x["pos"].alias("start")))).alias("spans"),
        ))
        return made[0]

    def step(acc, x):
        used = acc["used"] + x["tokens"]
        fits = (F.size(acc["spans"]) > 0) & (used <= room)
        return F.when(x["pos"] < F.col("leap") * leap, acc).when(fits, F.struct(used.alias("used"), acc["spans"].alias("spans"))).otherwise(opened(acc, x))

    none = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<struct<from:long,start:long>>").alias("spans"))
    found = per.select("conv_id", "system", F.element_at("t", -1)["pos"].alias("last"), F.aggregate("t", none, step)["spans"].alias("s"))
    found = found.select("conv_id", "system", F.explode(F.transform("s", lambda x, n: F.struct(x["from"].alias("from"), x["start"].alias("start"), F.coalesce(F.get("s", n + 1)["start"] - 1, F.col("last")).alias("end")))).alias("x"))
    return found.select("conv_id", (F.col("x.start") - (F.col("system") > 0).cast("long")).alias("window"), "x.from", "x.start", "x.end")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, n_tokens, n_repeated, formatted, loss_spans) for each window of each conversation.

    window is the place of its span's first turn (from 0, the system turn not counted), n_repeated how many of its turns, all at its start,
    are context from before it; loss_spans are the [start, end) code points of formatted under the loss mask.  A
    window keeps to the budget unless one turn with the system turn is longer than that.  Null roles and texts are empty, a
    null conv_id is a conversation, null turn numbers come first, equal numbers go by role and text, repeated rows
    each stay.  An empty table gives an empty result; other columns are not read.
    """
    at = placed(turns)
    found = spans(at, budget, history).withColumnRenamed("conv_id", "_c")
    shown_in = found.select("_c", "window", "start", F.explode(F.sequence("from", "end")).alias("_p"))
    turns_ = at.where("not is_system").join(shown_in, _same("conv_id", "_c") & (F.col("pos") == F.col("_p"))).withColumn("again", F.col("pos") < F.col("start"))
    systems = at.where("is_system")
    repeated = systems.join(found.where("window > 0"), _same("conv_id", "_c")).withColumn("again", F.lit(True))
    systems = systems.withColumns({"window": F.lit(0).cast("long"), "again": F.lit(False)})
    piece = lambda df: df.select("conv_id", "window", "pos", "again", "role", "text", "tokens")
    pieces = piece(turns_).unionAll(piece(systems)).unionAll(piece(repeated))
    made = pieces.groupBy("conv_id", "window").agg(F.sum("tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("pos", "again", "role", "text"))).alias("turns"))
    shown = F.transform("turns", lambda t: F.struct(F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"), (~t["again"] & (t["role"] == "assistant")).alias("target")))
    made = made.withColumn("shown", shown).withColumn("n_repeated", F.size(F.filter("turns", lambda t: t["again"])))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        from_ = acc["at"] + F.length(t["head"])
        to = from_ + F.length(t["body"])
        return F.struct((to + F.lit(len(END))).alias("at"), F.when(t["target"], F.concat(acc["spans"], F.array(F.struct(from_.alias("start"), to.alias("end"))))).otherwise(acc["spans"]).alias("spans"))

    formatted = F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return made.select("conv_id", "window", "n_tokens", "n_repeated", formatted.alias("formatted"), F.aggregate("shown", start, step)["spans"].alias("loss_spans"))


def parsed(output: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss_text, formatted_chars) of ``windows`` output: the turns each window owns and the text under its loss mask, unescaped."""
    bodies = F.split("formatted", r"<\|end\|>")
    own = F.slice(bodies, F.col("n_repeated") + 1, F.greatest(F.lit(0), F.size(bodies) - 1 - F.col("n_repeated")))
    cut = F.transform(own, lambda b: F.struct(
        unescape(F.substring_index(F.substring(b, F.lit(len(TURN) + 1), F.length(b)), TEXT, 1)).alias("role"),
        unescape(F.substring_index(b, TEXT, -1)).alias("text"),
    ))
    masked = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return output.select("conv_id", "window", cut.alias("turns"), masked.alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))


def conversation_digests(output: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows) read from ``windows`` output."""
    per = parsed(output).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "loss_text", "formatted_chars"))).alias("w"))
    text = F.array_join(F.transform("w", lambda w: F.array_join(F.transform(w["turns"], lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")), "")
    loss = F.array_join(F.transform("w", lambda w: w["loss_text"]), "")
    total = lambda f: F.aggregate("w", F.lit(0).cast("long"), lambda a, w: a + f(w))
    return per.select(
        "conv_id", total(lambda w: F.size(w["turns"])).alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), total(lambda w: w["formatted_chars"]).alias("formatted_chars"), F.size("w").cast("long").alias("n_windows"),
    )
