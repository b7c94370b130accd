"""Chat turns as one training text per conversation, with the spans that carry loss.

A run of turns of one role is one block: ``<|im_start|>role\\n`` text ``<|im_sep|>`` text ...
``<|im_end|>\\n``. Control strings inside roles and texts get a backslash after their first
character, and so does what already looks like an escaped one, so that removing one backslash
restores every text. Spark expressions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Starts of control strings of this template and of the common [INST] template.
CONTROL = r"([<\[])(\\*)(\||/s>|/?INST\])"
ESCAPED = r"([<\[])(\\*)\\(\||/s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _any_lines(role: Column) -> Column:
    parts = F.split(role, r"\\\\")  # between doubled backslashes every \n stands for a line end
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_spans of ``turns`` (conv_id, turn, role, text).

    loss_spans are (start, length) in code points of ``formatted``, one for each turn of a loss
    role, in order. Turns are sorted by turn; equal ones by role and text, and a repeated row is a
    turn of its own. Null texts and roles are empty strings; a null turn comes first; rows without
    conv_id are one conversation. A conversation has to fit into one string.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_ = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    n = F.size("turns")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("turns", i).role != F.get("turns", F.greatest(i - 1, F.lit(0))).role))
    runs = F.transform("starts", lambda s, k: F.slice("turns", s + 1, F.coalesce(F.get("starts", (k + 1).cast("int")), F.size("turns")) - s))

    def block(run: Column) -> Column:
        """Alternating plain and text pieces of a run; a text piece carries loss or not."""
        role = F.get(run, F.lit(0)).role
        head = F.concat(F.lit(START), _one_line(escape(role)), F.lit("\n"))
        return F.transform(run, lambda t, j: F.struct(
            F.when(j == 0, head).otherwise(F.lit(SEPARATOR)).alias("before"), escape(t.text).alias("text"),
            F.when(j == F.size(run) - 1, F.lit(END)).otherwise(F.lit("")).alias("after"), role.isin(*loss_roles).alias("loss")))

    pieces = sorted_.withColumn("starts", starts).select("conv_id", F.flatten(F.transform(runs, block)).alias("pieces"))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")

    def add(acc: Column, p: Column) -> Column:
        start = acc.at + F.length(p.before)
        span = F.array(F.struct(start.cast("long").alias("start"), F.length(p.text).cast("long").alias("length")))
        return F.struct((start + F.length(p.text) + F.length(p.after)).cast("long").alias("at"),
                        F.when(p.loss, F.concat(acc.spans, span)).otherwise(acc.spans).alias("spans"))

    spans = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add, lambda acc: acc.spans)
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p.before, p.text, p.after)), "")
    return pieces.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), one per turn, from a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(b: Column) -> Column:
        body = F.substring(b, F.lit(len(START) + 1), F.length(b))
        head = F.substring_index(body, "\n", 1)
        texts = F.split(F.substring(body, F.length(head) + 2, F.length(body)), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(unescape(_any_lines(head)).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss spans, as they were before they were escaped."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s.start + 1).cast("int"), s.length.cast("int"))))
