"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A conversation is written as turns one after the other, each

    ### role: text</turn>\n

so the text up to the end of any turn is a prefix of the whole.  Every assistant turn is a training example
of its own: the context is all that precedes, and only that reply is trainable.  Because an example is a
prefix, it is kept as offsets (``prompt_end``, ``loss_start``, ``loss_end``) and no text is stored more than
once, however long a conversation is; :func:`materialise` writes the examples out where a consumer wants them.

Inside roles and texts the control strings and the escape sign are replaced, so that what a user types can
never end a turn or open one:  ``\\`` is written ``\\b``, ``###`` is ``\\h``, ``</turn>`` is ``\\t`` and, in roles,
``:`` is ``\\c``.  No escaped text has a control string, so reading back is exact.

Null texts and roles count as empty.  Turns are put in order of ``turn``, then role, then text, nulls first;
repeated rows are repeated turns.  Rows without ``conv_id`` form one conversation.  An empty table gives no
rows.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
#: What is replaced, and by what; the escape sign itself comes first, and last on the way back.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
TRAINED_ROLE = "assistant"


def escape(c: Column) -> Column:
    for plain, written in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape(c: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\c"), F.lit(":")))


def format_turns(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per turn: conv_id, seq (from 0), formatted, start, end and, for trained turns, loss_start and loss_end.

    Offsets are code points of the formatted conversation, end exclusive.  The example of a trained turn is the
    conversation up to ``end``, with the loss mask on ``[loss_start, loss_end)``.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    head = F.concat(F.lit(OPEN), _escape_role(role), F.lit(MIDDLE))
    turns = conversations.select(
        "conv_id", "turn", "role", "text",
        F.concat(head, escape(text), F.lit(CLOSE)).alias("formatted"),
        F.length(head).cast("long").alias("head_chars"),
        (role == trained_role).alias("trained"),
    ).withColumns({
        "seq": F.row_number().over(order) - 1,
        "end": F.sum(F.length("formatted").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    start = F.col("end") - F.length("formatted")
    return turns.select(
        "conv_id", "seq", "formatted", start.alias("start"), "end",
        F.when(F.col("trained"), start + F.col("head_chars")).alias("loss_start"),
        F.when(F.col("trained"), F.col("end") - len(CLOSE)).alias("loss_end"),
    )


def joined(turns: DataFrame) -> DataFrame:
    """conv_id, text and examples: each formatted conversation in one piece, and the offsets of each trained turn, in order."""
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seq", "formatted", "loss_start", "loss_end", "end"))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: x["formatted"]), "")
    one = lambda x: F.struct(x["seq"].alias("target_seq"), x["loss_start"].alias("prompt_end"), x["loss_start"].alias("loss_start"), x["loss_end"].alias("loss_end"), x["end"].alias("chars"))
    return whole.select("conv_id", text.alias("text"), F.transform(F.filter("t", lambda x: x["loss_start"].isNotNull()), one).alias("examples"))


def expand(whole: DataFrame, *keep: str) -> DataFrame:
    """Prefix-target expansion of :func:`joined`: a row per trained turn with target_seq, prompt_end, loss_start, loss_end, chars and ``text``.

    The example is the first ``chars`` code points of ``text``, trained on ``[loss_start, loss_end)``, which end it but
    for the closing sign; ``text`` is the conversation itself, not a copy per example.  A conversation without trained
    turns gives one row of nulls, so that it isn't lost.
    """
    return whole.select("conv_id", *keep, "text", F.explode_outer("examples").alias("x")).select("conv_id", *keep, "x.*", "text")


def examples(turns: DataFrame) -> DataFrame:
    """One row per trained turn of :func:`format_turns`: which prefix is the example and which span is trained."""
    return expand(joined(turns)).where(F.col("target_seq").isNotNull()).drop("text")


def _span(start: str, end: str) -> Column:
    return F.substring("text", (F.col(start) + 1).cast("int"), (F.col(end) - F.col(start)).cast("int"))


def materialise(turns: DataFrame) -> DataFrame:
    """The examples with their texts: conv_id, target_seq, prompt, completion.

    Texts grow with the square of a conversation's length, as is in the nature of this expansion; keep offsets
    where conversations are long.
    """
    rows = expand(joined(turns)).where(F.col("target_seq").isNotNull())
    return rows.select("conv_id", "target_seq", F.substring("text", F.lit(1), F.col("prompt_end").cast("int")).alias("prompt"), _span("loss_start", "loss_end").alias("completion"))


def read_back(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation or prefix, told from its control strings alone."""

    def turn(piece):
        body = F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece))
        cut = F.instr(body, MIDDLE)
        return F.struct(_unescape_role(F.substring(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substring(body, cut + len(MIDDLE), F.length(body))).alias("text"))

    pieces = F.split(text, CLOSE)  # has no sign that is special in a pattern; what follows the last one is empty
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def digest(turns: DataFrame) -> DataFrame:
    """What was written, told from the output alone: a row per conversation.

    Turns are read back from the joined text; what is learnt comes from the examples, one row per trained turn, each
    cut out of its prefix by its loss mask and put together in order.
    """
    whole = joined(turns).withColumn("t", read_back(F.col("text"))).select(
        "conv_id", "text", "examples",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )
    told = ("n_turns", "turns_sha256", "formatted_chars")
    replies = expand(whole, *told).select("conv_id", *told, "target_seq", unescape(_span("loss_start", "loss_end")).alias("reply"))
    learnt = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("target_seq").isNotNull(), F.struct("target_seq", "reply")))), lambda x: x["reply"]), "")
    return replies.groupBy("conv_id", *told).agg(learnt.alias("learnt")).select(
        "conv_id", "n_turns", "turns_sha256", F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars"
    )
