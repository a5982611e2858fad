"""Chat formatting over reply trees, in DataFrame operations only.

Messages form reply trees: each names its parent.  A branch is the path from a
root to a leaf.  ``format_branches`` ranks a conversation's branches by the sum
of their messages' scores and formats the best ones, each as one conversation.

* Paths come from self-joins that double their reach in each round: the table of
  round k holds every message's ancestor 2^k levels up and the score gathered on
  the way, so a tree of depth d takes log2(d) rounds.  The rounds carry ids and
  scores only; texts join once, for the chosen branches.
* The template writes a turn as ``<|start|>role<|text|>text<|end|>``.  Inside
  roles and texts a backslash goes before every backslash and into every control
  string (those of the template and ``<s> </s> [INST] [/INST] <<SYS>> <</SYS>>``),
  so no control string is left and removing one backslash from each pair or
  mark gives the text back.
* ``loss_mask`` has the code-point start and length of each assistant text.

Defined results: a null role or text is empty; a null or unknown parent, and a
parent that doesn't sort before its reply, makes a root (so there are no cycles);
a null conversation id is a conversation of its own; rows with the same id in a
conversation are kept, in the order of role and text, as replies to one another;
ties in the score go to the smallest leaf id; no rows give no rows.  Columns
beyond the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import Workspace, table

START, SEP, END = "<|start|>", "<|text|>", "<|end|>"
#: Where a backslash goes: into a control string after its first character, and before a backslash.
ESCAPE = r"(?<=<)(?=\||/?s>|</?SYS>>)|(?<=\[)(?=/?INST\])|(?=\\)"


def escape(col):
    return F.regexp_replace(col, ESCAPE, "\\\\")


def unescape(col):
    return F.regexp_replace(col, r"(?s)\\(.)", "$1")


def link_turns(rows: DataFrame) -> DataFrame:
    """Messages of linear conversations: each row replies to the one before it by ``turn``."""
    w = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    seq = rows.select("conv_id", F.row_number().over(w).cast("long").alias("msg_id"), "role", "text")
    return seq.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
                      "role", "text", F.lit(0.0).alias("score"))


def _numbered(messages: DataFrame) -> DataFrame:
    """Columns c (conversation key), m and p (position of the message and its parent), role, text, score.

    Rows with one id follow each other; replies to that id hang from the last of them.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    w = Window.partitionBy("c").orderBy(F.col("msg_id").asc_nulls_first(), "role", "text", F.col("score").asc_nulls_first())
    rows = messages.select(
        "conv_id", key.alias("c"), "msg_id", "parent_id", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    rows = rows.withColumn("m", F.row_number().over(w).cast("long")).withColumn(
        "again", F.lag("msg_id").over(w).eqNullSafe(F.col("msg_id")) & F.col("msg_id").isNotNull())
    ids = rows.where("msg_id IS NOT NULL").groupBy("c", F.col("msg_id").alias("parent_id")).agg(F.max("m").alias("p"))
    rows = rows.join(ids, ["c", "parent_id"], "left")
    parent = F.when(F.col("again"), F.col("m") - 1).when(F.col("p") < F.col("m"), F.col("p"))
    return rows.select("conv_id", "c", "m", parent.alias("p"), "role", "text", "score")


def format_branches(spark: SparkSession, messages: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best branches of each conversation, one formatted row each.

    ``messages``: conv_id, msg_id, parent_id, role, text, score.  Returns conv_id,
    branch (from 1), branch_score, n_turns, formatted and loss_mask
    (array of struct(start, length) in code points).
    """
    ws = Workspace(spark, "chat")
    rows = ws.keep(_numbered(messages), "messages")
    up = ws.keep(rows.select("c", "m", F.col("p").alias("a"), F.col("score").alias("s")), "up0")
    jumps = [up]
    while not up.where("a IS NOT NULL").isEmpty():
        # the ancestor's own jump, appended to the jump that leads to it
        far = up.select("c", F.col("m").alias("a"), F.col("a").alias("b"), F.col("s").alias("t"))
        moved = up.where("a IS NOT NULL").join(far, ["c", "a"]).select(
            "c", "m", F.col("b").alias("a"), (F.col("s") + F.col("t")).alias("s"))
        up = ws.keep(moved.unionByName(up.where("a IS NULL")), f"up{len(jumps)}")
        jumps.append(up)
    # a leaf is nobody's parent; the last round has the score of its whole path
    leaves = up.select("c", "m", "s").join(
        jumps[0].where("a IS NOT NULL").select("c", F.col("a").alias("m")), ["c", "m"], "left_anti")
    rank = Window.partitionBy("c").orderBy(F.desc("s"), "m")
    chosen = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= branches)
    paths = ws.keep(chosen.select("c", "m", "branch", F.col("s").alias("branch_score")), "leaves")
    for k, jump in reversed(list(enumerate(jumps[:-1]))):
        step = paths.join(jump.where("a IS NOT NULL").select("c", "m", "a"), ["c", "m"])
        paths = ws.keep(paths.unionByName(step.select("c", F.col("a").alias("m"), "branch", "branch_score")), f"paths{k}")
    turns = paths.join(rows, ["c", "m"]).select(
        "conv_id", "c", "branch", "branch_score", "m", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"))
    one = turns.groupBy("c", "branch").agg(
        F.first("conv_id").alias("conv_id"), F.first("branch_score").alias("branch_score"),
        F.sort_array(F.collect_list(F.struct("m", "head", "body", "learn"))).alias("turns"))
    # running lengths give the mask; the fold carries (position, spans)
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(t["learn"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))))
            .otherwise(acc["spans"]).alias("spans")))
    return one.select(
        "conv_id", "branch", "branch_score", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        spans["spans"].alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations: adds turns (array of role and text) and loss_texts (array of texts under the mask)."""
    pieces = F.split(F.col("formatted"), r"<\|end\|>", -1)
    turn = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda x: F.struct(
        unescape(F.substring_index(F.substr(x, F.lit(len(START) + 1)), SEP, 1)).alias("role"),
        unescape(F.substr(x, F.instr(x, SEP) + len(SEP))).alias("text")))
    under = F.transform("loss_mask", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.withColumn("turns", turn).withColumn("loss_texts", under)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the control-string conversation -7, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = read_back(format_branches(spark, link_turns(rows.unionByName(hard))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_ESC = "coalesce({0}, '')"
for _find, _put in (("\\", "\\\\"), ("<|", "<\\|"), ("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("<<SYS>>", "<\\<SYS>>"),
                    ("<</SYS>>", "<\\</SYS>>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")):
    _ESC = f"replace({_ESC}, '{_find}', '{_put}')"
_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' {_ORDER})) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN coalesce(text, '') END, '' {_ORDER}), '')) AS loss_sha256,
  CAST(sum({len(START + SEP + END)} + length({_ESC.format('role')}) + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""
