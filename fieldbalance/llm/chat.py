"""Chat formatting in budgeted windows; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbalance.llm.common import table, word_count

HEAD, MID, END = "### ", ": ", "</turn>"
BUDGET = 512
HISTORY = 2


def escape(text: Column) -> Column:
    """Backslash, head and end of a turn as two characters each; reversible."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit(HEAD), F.lit("\\h"))
    return F.replace(out, F.lit(END), F.lit("\\e"))


def unescape(text: Column) -> Column:
    """From left to right: escaped backslashes split the text, the rest cannot overlap."""
    pieces = F.split(text, r"\\\\", -1)
    plain = F.transform(pieces, lambda p: F.replace(F.replace(F.replace(
        p, F.lit("\\h"), F.lit(HEAD)), F.lit("\\e"), F.lit(END)), F.lit("\\m"), F.lit(MID)))
    return F.array_join(plain, "\\")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, n_system, n_repeated, n_words, loss (start, length in code points).

    Prefix sums of the turns' words choose the windows: each takes turns while the system
    turn, what is repeated and its own turns stay within the budget. Every later window
    repeats the system turn, if there is one, and as many of the last `history` turns before
    its own as leave room for its first own turn; only assistant texts of its own turns are
    under the loss mask. Only a window of one own turn, which does not fit with the system
    turn, exceeds the budget; the first window also holds the system turn itself.
    A null text is empty, a null role is "unknown", rows with a null conv_id are one
    conversation, a null turn counts as 0; rows that share a turn number are ordered by role
    and text, and repeated rows stay. Roles are escaped like texts. Long texts and long
    conversations are formatted whole. Other columns are not read, an empty table gives no rows.
    """
    t = turns.select("conv_id", F.coalesce("turn", F.lit(0)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"), word_count(F.col("text")).alias("words"))
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("sum", F.sum("words").over(so_far))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "sum"))).alias("turns"))
    c = c.withColumn("n_first", (F.element_at("turns", 1)["role"] == "system").cast("int"))
    c = c.withColumn("sums", F.concat(F.array(F.lit(0).cast("long")), F.transform("turns", lambda t: t["sum"])))

    def words(low, high):
        """Words of the turns from low to high, and of the system turn if it stands before them."""
        return F.get("sums", high) - F.get("sums", low) + F.when(low > 0, F.get("sums", F.col("n_first"))).otherwise(F.lit(0))

    def reach(at):
        """The first turn that a window opening at `at` repeats."""
        return at - F.size(F.filter(F.sequence(F.lit(1), F.lit(max(1, history))), lambda h: (
            (h <= history) & (h <= at - F.col("n_first")) & (words(at - h, at + 1) <= budget))))

    def step(acc, at):
        opens = (at > F.col("n_first")) & (words(acc["reach"], at + 1) > budget)
        back = reach(at)
        return F.struct(F.when(opens, back).otherwise(acc["reach"]).alias("reach"), F.when(opens, F.array_append(
            acc["cuts"], F.struct(at.alias("at"), back.alias("reach")))).otherwise(acc["cuts"]).alias("cuts"))

    none = F.struct(F.lit(0).alias("reach"), F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("reach"))).alias("cuts"))
    c = c.withColumn("cuts", F.aggregate(F.sequence(F.lit(0), F.size("turns") - 1), none, step, lambda acc: acc["cuts"]))

    def item(t):
        head = F.concat(F.lit(HEAD), F.replace(escape(t["role"]), F.lit(MID), F.lit("\\m")), F.lit(MID))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("answer"))

    c = c.withColumn("items", F.transform("turns", item))
    end = lambda i: F.coalesce(F.get("cuts", i + 1)["at"], F.size("turns"))
    c = c.select("conv_id", "n_first", F.inline(F.transform("cuts", lambda w, i: F.struct(
        i.cast("long").alias("window"), F.when(w["at"] > 0, F.slice("items", 1, F.col("n_first"))).otherwise(
            F.slice("items", 1, 0)).alias("opening"),
        F.slice("items", w["reach"] + 1, w["at"] - w["reach"]).alias("past"),
        F.slice("items", w["at"] + 1, end(i) - w["at"]).alias("own"), words(w["reach"], end(i)).alias("n_words")))))
    form = lambda items: F.array_join(F.transform(items, lambda i: F.concat(
        i["head"], i["body"], F.lit(END + "\n"))), "")
    c = c.withColumn("lead", form(F.concat("opening", "past")))
    first = F.struct(F.length("lead").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    loss = F.aggregate("own", first, lambda acc, i: F.struct(
        (acc["at"] + F.length(i["head"]) + F.length(i["body"]) + len(END) + 1).alias("at"),
        F.when(i["answer"], F.array_append(acc["spans"], F.struct(
            (acc["at"] + F.length(i["head"])).alias("start"), F.length(i["body"]).alias("length")))).otherwise(
                acc["spans"]).alias("spans")), lambda acc: acc["spans"])
    return c.select("conv_id", "window", F.concat("lead", form(F.col("own"))).alias("text"), F.size("opening").alias("n_system"),
                    (F.size("opening") + F.size("past")).alias("n_repeated"), "n_words", loss.alias("loss"))


def read_turns(windows_: DataFrame) -> DataFrame:
    """conv_id, window, chars, turns (role, text) of each window's own turns, losses (their loss texts).

    The inverse of `windows`: repeated turns are left out, escapes undone. Needs its columns
    conv_id, window, text, n_repeated and loss; others are not read. No windows give no rows.
    """
    parts = F.split("text", END + "\n", -1)
    parts = F.slice(parts, F.col("n_repeated") + 1, F.greatest(F.lit(0), F.size(parts) - 1 - F.col("n_repeated")))
    role = lambda p: F.substring_index(F.substr(p, F.lit(len(HEAD) + 1)), MID, 1)
    turns = F.transform(parts, lambda p: F.struct(
        unescape(role(p)).alias("role"),
        unescape(F.substr(p, F.length(role(p)) + len(HEAD) + len(MID) + 1)).alias("text")))
    losses = F.transform("loss", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"])))
    return windows_.select("conv_id", "window", F.length("text").alias("chars"), turns.alias("turns"), losses.alias("losses"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = read_turns(windows(turns))
    whole = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "losses"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    all_turns = F.flatten(F.transform("w", lambda x: x["turns"]))
    said = F.array_join(F.transform(all_turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.flatten(F.transform("w", lambda x: x["losses"])), "")
    return whole.select("conv_id", F.size(all_turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.col("formatted_chars").cast("long").alias("formatted_chars"))
