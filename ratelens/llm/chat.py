"""Chat formatting that is proved by reading it back.

A conversation is rendered turn by turn with a template, the rendered text is parsed again by a deterministic parser, and
the turns found are compared with the source. If they differ, or if a control string stands anywhere but where the template
put it, the turns that hold one are rendered again with their content escaped, and the result is parsed and compared once
more; should that ever differ, the query fails rather than return a wrong text.

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n              a turn
    <|im_start|>ROLE<|esc|>\\nTEXT<|im_end|>\\n       a turn whose text is escaped

Escaping doubles backslashes and puts one after the first character of each control string; unescaping drops a backslash and
keeps the character after it. Roles are always escaped, and a line end in them is written as backslash and n.

Null roles and texts are empty ones. Turns go in order of turn (null first), role and text; repeated rows are turns of their
own. Other columns are ignored. A conversation is one rendered text, so one task holds it whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strings with a meaning in chat templates and vocabularies.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|esc|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
START, END, ESCAPED = "<|im_start|>", "<|im_end|>\n", "<|esc|>"
_ANY = "|".join(re.escape(c).replace("/", "/") for c in CONTROL)
_INSIDE = r"([<\[])(?=" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(_INSIDE), F.lit(r"$1\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, F.lit(r"(?<!\\)((?:\\\\)*)\\n"), F.lit("$1\n")))


def holds_control(text: Column) -> Column:
    return text.rlike(_ANY)


def render(turns: Column, escaping: bool) -> Column:
    """Text of a conversation. escaping: turns that hold a control string are escaped, else none."""

    def turn(t: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(t["role"]))
        plain = F.concat(head, F.lit("\n"), t["text"], F.lit(END))
        if not escaping:
            return plain
        return F.when(holds_control(t["text"]), F.concat(head, F.lit(f"{ESCAPED}\n"), escape(t["text"]), F.lit(END))).otherwise(plain)

    return F.array_join(F.transform(turns, turn), "")


def parse(formatted: Column) -> Column:
    """Turns of a rendered text, as (role, text, start, length): where the text's characters stand, from 0."""
    parts = F.split(formatted, F.lit(re.escape(END)))
    whole = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))  # what follows the last end mark is no turn

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(head) + 2, F.length(part))
        escaped = head.endswith(ESCAPED)
        role = F.substring(head, F.lit(len(START) + 1), F.length(head) - len(START) - F.when(escaped, len(ESCAPED)).otherwise(0))
        return F.struct(
            unescape_role(role).alias("role"), F.when(escaped, unescape(body)).otherwise(body).alias("text"),
            (F.length(head) + 1).alias("before"), F.length(body).alias("length"), F.length(part).alias("size"), escaped.alias("escaped"),
        )

    def placed(done: Column, t: Column) -> Column:
        start = done["at"] + t["before"]
        row = F.struct(t["role"].alias("role"), t["text"].alias("text"), start.alias("start"), t["length"].alias("length"), t["escaped"].alias("escaped"))
        return F.struct((done["at"] + t["size"] + len(END)).alias("at"), F.concat(done["turns"], F.array(row)).alias("turns"))

    none = F.array().cast("array<struct<role:string,text:string,start:int,length:int,escaped:boolean>>")
    return F.aggregate(F.transform(whole, turn), F.struct(F.lit(0).alias("at"), none.alias("turns")), placed)["turns"]


def _same(parsed: Column, turns: Column) -> Column:
    said = F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return said == F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted text and the turns read back from it (role, text, start, length, escaped) for each conversation."""
    said = rows.select(
        "conv_id", F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("said"),
    )
    turns = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    clean = ~F.exists("turns", lambda t: holds_control(t["text"]))
    first = turns.withColumn("plain", render(F.col("turns"), escaping=False))
    first = first.withColumn("fits", clean & _same(parse(F.col("plain")), F.col("turns")))
    second = first.withColumn("formatted", F.when(F.col("fits"), F.col("plain")).otherwise(render(F.col("turns"), escaping=True)))
    second = second.select("conv_id", "turns", "formatted", parse(F.col("formatted")).alias("parsed"))
    proved = F.when(_same(F.col("parsed"), F.col("turns")), F.col("parsed")).otherwise(F.raise_error(F.lit("a conversation does not read back")))
    return second.select("conv_id", "formatted", proved.alias("turns"))


def loss_mask(turns: Column, role: str = "assistant") -> Column:
    """Spans (start, length, escaped) of the formatted text that count for the loss: the texts of one role."""
    spans = F.filter(turns, lambda t: t["role"] == role)
    return F.transform(spans, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"), t["escaped"].alias("escaped")))


def under_mask(formatted: Column, spans: Column) -> Column:
    """Text under the spans, unescaped, one after the other."""

    def piece(s: Column) -> Column:
        raw = F.substring(formatted, s["start"] + 1, s["length"])
        return F.when(s["escaped"], unescape(raw)).otherwise(raw)

    return F.array_join(F.transform(spans, piece), "")
