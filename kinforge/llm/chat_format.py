"""Chat formatting with a grammar round trip; DataFrame functions only.

The grammar: a turn is ``<|im_start|>`` role newline text ``<|im_end|>`` newline. The parser cuts at each
``<|im_start|>``, takes the role up to the first newline, drops the closing mark and unescapes: a ``<``, some
backslashes and a ``|`` lose one backslash, and in roles ``<|n|>`` is a newline. Each turn is first rendered as
it is, reparsed and compared with its source; only where the two differ is its content escaped (one more
backslash in each ``<`` backslashes ``|``), reparsed and compared again. Escaped content holds no ``<|`` at all,
so the second rendering is always identical; ``round_trip`` reports the comparison for the whole conversation.

Defined results: null texts and roles are empty; turns are ordered by turn (nulls first), then role, then
text; rows that repeat are turns that repeat; an empty table gives no conversations; other columns are ignored.
One conversation is one output string, so it must fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|n|>"


def escape(s: Column) -> Column:
    return F.regexp_replace(s, r"<(\\*)\|", r"<\\$1|")


def unescape(s: Column) -> Column:
    return F.regexp_replace(s, r"<\\(\\*)\|", r"<$1|")


def escape_role(s: Column) -> Column:
    return F.replace(escape(s), F.lit("\n"), F.lit(BREAK))


def unescape_role(s: Column) -> Column:
    return unescape(F.replace(s, F.lit(BREAK), F.lit("\n")))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def parse(rendered: Column) -> Column:
    """The turns of a rendered conversation: array<struct<role, text>>; null text where the grammar fails."""
    bodies = F.split(rendered, r"<\|im_start\|>")
    bodies = F.slice(bodies, F.lit(2), F.greatest(F.size(bodies) - 1, F.lit(0)))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        rest = F.substring(body, F.length(role) + 2, F.length(body))
        text = F.when(F.instr(rest, END.rstrip("\n")) == F.length(rest) - len(END) + 1, F.substring(rest, F.lit(1), F.length(rest) - len(END)))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(bodies, turn)


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """A row for each conversation: conv_id, formatted, loss_spans (start and length in code points of the
    learnt role's texts within formatted), n_escaped, round_trip."""
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    same = F.to_json(parse(render(F.col("role"), F.col("text")))) == F.to_json(F.array(F.struct("role", "text")))
    rows = rows.withColumn("escaped", ~F.coalesce(same, F.lit(False)))
    shown = F.struct(
        "turn", "role", "text", F.col("escaped"),
        F.when(F.col("escaped"), escape_role(F.col("role"))).otherwise(F.col("role")).alias("out_role"),
        F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text")).alias("out_text"),
    )
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(shown)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: render(t["out_role"], t["out_text"])), "")

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + len(START) + F.length(t["out_role"]) + 1
        size = F.length(t["out_text"]).cast("long")
        spans = F.when(t["role"] == learn, F.concat(state["spans"], F.array(F.struct(begin.alias("start"), size.alias("length"))))).otherwise(state["spans"])
        return F.struct((begin + size + len(END)).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("spans"))
    convs = convs.select("conv_id", "turns", formatted.alias("formatted"), F.aggregate("turns", first, step, lambda s: s["spans"]).alias("loss_spans"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return convs.select("conv_id", "formatted", "loss_spans", F.size(F.filter("turns", lambda t: t["escaped"])).cast("long").alias("n_escaped"), (F.to_json(parse(F.col("formatted"))) == F.to_json(source)).alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted strings hold: turns and the unescaped text under the loss mask."""
    text = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.select("conv_id", "formatted", "n_escaped", "round_trip", parse(F.col("formatted")).alias("turns"), text.alias("loss_text"))
