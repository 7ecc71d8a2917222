"""Chat formatting by event-sourced reconstruction. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of this template and of other common ones, in three parts: what opens, what names, what closes.
_CONTROL = r"(<\|/?|<</?|</?|\[/?)(\\{at_least})((?:im_start|im_end|endoftext)\|>|SYS>>|s>|INST\])"


def escape(text: Column) -> Column:
    """Put one more backslash into every control string, also into one that holds backslashes there already."""
    return F.regexp_replace(text, _CONTROL.format(at_least="*"), r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Undo escape: take one backslash out of every control string that holds one."""
    return F.regexp_replace(text, _CONTROL.format(at_least="+").replace(r"(\\+)", r"\\(\\*)"), "$1$2$3")


def _role(role: Column) -> Column:
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _read_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv, message, role, text) of an event log (conv, message, seq, op, role, text).

    By message, in order of seq: 'start' and 'edit' set the text, 'regenerate' drops what was said and starts from the
    event's text, 'delta' appends, 'delete' removes the message; any other op is an error. So the final text is that of
    the last setting event and of the deltas after it: deltas before it are dropped ahead of the fold. A message that
    has deltas only starts empty. The role is the last one given.
    Ties of seq are ordered by op, role and text, so a repeated delta is appended as often as it occurs. Null text is
    empty, a null seq comes first, a null op is 'start'. A message whose last setting event is 'delete' is left out.
    """
    op = F.coalesce("op", F.lit("start"))
    kind = F.when(op == "delta", 1).when(op.isin("start", "edit", "regenerate", "delete"), 0).otherwise(
        F.raise_error(F.concat(F.lit("unknown event "), op)))
    rows = events.select("conv", "message", F.struct(F.col("seq"), kind.alias("late"), op.alias("op"), F.col("role"), F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    # Partial results: the last setting event of each message is found without gathering its log.
    last = rows.groupBy("conv", "message").agg(
        F.max(F.when(F.col("e.late") == 0, F.col("e"))).alias("base"), F.max(F.when(F.col("e.role").isNotNull(), F.col("e"))).alias("named"),
        F.sum("e.late").alias("deltas"))
    plain = last.where("deltas = 0").select("conv", "message", "named.role", "base.text", "base.op")
    streamed = last.where("deltas > 0").select(F.col("conv").alias("_c"), F.col("message").alias("_m"), "base", "named")
    told = rows.where("e.late = 1").join(streamed, F.col("conv").eqNullSafe(F.col("_c")) & F.col("message").eqNullSafe(F.col("_m")))
    after = F.col("base").isNull() | (F.col("e") > F.col("base"))
    # What is gathered is one message's final text.
    text = F.array_sort(F.collect_list(F.when(after, F.col("e"))))
    built = told.groupBy("conv", "message", "named", "base").agg(text.alias("parts")).select(
        "conv", "message", "named.role", F.concat(F.coalesce("base.text", F.lit("")), F.array_join(F.transform(
            "parts", lambda p: p["text"]), "")).alias("text"), "base.op")
    return plain.unionByName(built).where("op is null or op <> 'delete'").drop("op")


def render(messages: DataFrame) -> DataFrame:
    """conv, formatted and mask of each conversation from its messages (conv, message, role, text) in order of message.

    mask: structs (start, end), code points of formatted under the loss: the assistant texts, as escaped. Equal message
    numbers are ordered by role and text; null roles are ''. One row is one conversation's whole text.
    """
    turn = F.struct(F.col("message"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), _role(F.col("role")), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    parts = messages.select("conv", F.struct(turn.alias("turn"), F.length(head).alias("head"), F.length(body).alias("body"), (
        F.coalesce("role", F.lit("")) == "assistant").alias("loss"), F.concat(head, body, F.lit(END + "\n")).alias("out")).alias("p"))
    each = parts.groupBy("conv").agg(F.array_sort(F.collect_list("p")).alias("p"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("mask"))

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + p["head"]
        end = start + p["body"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"), F.when(p["loss"], F.concat(s["mask"], span)).otherwise(s["mask"]).alias("mask"))

    return each.select("conv", F.array_join(F.transform("p", lambda p: p["out"]), "").alias("formatted"),
                       F.aggregate("p", zero, step)["mask"].alias("mask"))


def read_back(rendered: DataFrame) -> DataFrame:
    """rendered plus turns (role, text) and loss (texts under the mask), read from the formatted text alone."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))

    def turn(b: Column) -> Column:
        return F.struct(_read_role(F.substring_index(b, "\n", 1)).alias("role"),
                        unescape(F.substring(b, F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b))).alias("text"))

    loss = F.transform("mask", lambda m: unescape(F.substring("formatted", m["start"] + 1, m["end"] - m["start"])))
    return rendered.withColumns({"turns": F.transform(bodies, turn), "loss": loss})


def as_events(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversation rows as events: each row starts a message of its own, also where a turn number occurs twice."""
    rank = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("nr"))
    return conversations.select(F.col(conv_col).alias("conv"), rank.alias("message"), F.col(turn_col).cast("long").alias("seq"), F.lit("start").alias("op"),
                                F.col(role_col).alias("role"), F.col(text_col).alias("text"))


def as_log(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversation rows as a log that folds back to them: by hash, a message is said at once, streamed, drafted and edited, or
    streamed, regenerated and streamed again; every message that is said at once was said before and deleted."""
    text = F.coalesce("text", F.lit(""))
    cuts = F.lit(1), (F.length(text) / 3).cast("int") + 1, (F.length(text) / 2).cast("int") + 1, F.length(text) + 1
    parts = [F.substring(text, lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]
    none = F.lit(None).cast("string")

    def told(*events: tuple[str, Column]) -> Column:
        """The role comes with the first event only."""
        return F.array(*[F.struct(F.lit(k).cast("long").alias("seq"), F.lit(op).alias("op"), (F.col("role") if k == 0 else none).alias("role"), t.alias("text"))
                         for k, (op, t) in enumerate(events)])

    streamed = [("delta", p) for p in parts]
    way = F.pmod(F.xxhash64("conv", "message.turn"), F.lit(4))
    log = (F.when(way == 0, told(("start", text))).when(way == 1, told(("start", F.lit("")), *streamed))
           .when(way == 2, told(("start", F.reverse(text)), ("delta", F.lit(" draft")), ("edit", text)))
           .otherwise(told(("start", F.lit("draft ")), streamed[2], ("regenerate", parts[0]), *streamed[1:])))
    rows = as_events(conversations, conv_col, turn_col, role_col, text_col)
    withdrawn = rows.where(way == 0).withColumn("message", F.struct(  # a message of its own
        "message.turn", "message.role", "message.text", (-1 - F.col("message.nr")).alias("nr")))
    withdrawn = withdrawn.select("conv", "message", F.explode(told(("start", text), ("delete", none))).alias("e"))
    return rows.select("conv", "message", F.explode(log).alias("e")).unionByName(withdrawn).select("conv", "message", "e.*")


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """conv, formatted, mask, turns and loss of every conversation of a table with a row for each turn.

    A null conversation id is a conversation of its own; repeated rows are repeated turns; an empty table gives an empty
    result; further columns are not read.
    """
    return read_back(render(fold(as_events(conversations, conv_col, turn_col, role_col, text_col))))
