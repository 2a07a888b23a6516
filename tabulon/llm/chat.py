"""Chat formatting in budgeted windows, as DataFrame functions only.

A conversation's turns are written as ``<turn ROLE>TEXT</turn>`` and a
newline; ``&``, ``<`` and ``>`` inside roles and texts are escaped
reversibly, so no text can open or close a turn. Prefix sums of turn tokens
cut the conversation into windows that begin and end at turns: a window takes
turns until the next one would exceed the room for new turns (budget less
system turn less history). Every window after the first repeats the leading
system turn and as many whole turns just before it as fit ``history`` tokens.
The loss mask is a list of (start, length) spans in code points over the
texts of new assistant turns; repeated turns are masked, so each assistant
text is a target exactly once. A single turn larger than the room gets a
window of its own and is never cut. A system turn that leaves less than a
quarter of the budget beside the history shortens the history, down to none,
and then the room, down to one new turn: a window exceeds its budget only
where the system turn and one new turn alone do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import let

BUDGET = 1024      # tokens of a window
HISTORY = 256      # tokens of repeated turns before it
TURN_TOKENS = 4    # what a turn's marks count
TURN = r"<turn ([^>]*)>([^<]*)</turn>"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"


def escape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def count_tokens(text: Column) -> Column:
    """Runs of letters and digits, and every other visible character."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def _starts(sums: Column, room: Column) -> Column:
    """First turn of each window; ``sums[i]`` are the tokens before turn i."""
    zero = F.struct(F.array(F.lit(0)).alias("at"), F.lit(0).cast("bigint").alias("base"))

    def step(a, i):
        over = (i > F.element_at(a["at"], -1)) & (F.get(sums, i + 1) - a["base"] > room)
        return F.when(over, F.struct(F.concat(a["at"], F.array(i)).alias("at"), F.get(sums, i).alias("base"))).otherwise(a)
    return F.aggregate(F.sequence(F.lit(0), F.size(sums) - 2), zero, step, lambda a: a["at"])


def _window(turns: Column, sums: Column, starts: Column, k: Column, has_system: Column, history: Column) -> Column:
    """Window ``k``: repeated turns, then its new ones, formatted."""
    first = F.get(starts, k)
    last = F.coalesce(F.get(starts, k + 1), F.size(turns))
    back = F.size(F.filter(F.sequence(F.lit(0), first), lambda i: (i < first) & (i >= has_system) & (F.get(sums, first) - F.get(sums, i) <= history)))
    system = F.when(first > 0, has_system).otherwise(0)
    shown = F.concat(F.slice(turns, 1, system), F.slice(turns, first - back + 1, last - first + back))

    def write(repeated):
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.array().cast("array<struct<start:int,len:int>>").alias("loss"))

        def step(a, t):
            begin = a["at"] + F.char_length(F.concat(F.lit("<turn "), t["role"], F.lit(">")))
            size = F.char_length(t["body"])
            target = (a["n"] >= repeated) & (t["own"] == TARGET_ROLE) & (size > 0)
            span = F.array(F.struct(begin.alias("start"), size.alias("len")))
            return F.struct((a["n"] + 1).alias("n"), (begin + size + len("</turn>\n")).alias("at"),
                            F.when(target, F.concat(a["loss"], span)).otherwise(a["loss"]).alias("loss"))
        return let(shown, lambda w: F.struct(
            k.alias("window"), repeated.alias("n_repeated"), F.size(w).alias("n_turns"),
            F.aggregate(w, F.lit(0).cast("bigint"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
            F.array_join(F.transform(w, lambda t: F.concat(F.lit("<turn "), t["role"], F.lit(">"), t["body"], F.lit("</turn>\n"))), "").alias("formatted"),
            F.aggregate(w, zero, step, lambda a: a["loss"]).alias("loss")))
    return let(system + back, write)


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, n_turns, n_tokens,
    formatted and loss (array of start, len).

    Null texts and roles count as empty; turns go by number (null first),
    then role, then text, and repeated rows are repeated turns; a null
    conversation id is a conversation of its own; an empty table gives an
    empty one. A conversation is the record of the output: its rows meet in
    one task, and only its."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), r.alias("own"), escape(r).alias("role"), escape(t).alias("body"),
        (count_tokens(t) + TURN_TOKENS).cast("bigint").alias("tokens")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def cut_up(ts):
        sums = F.aggregate(ts, F.array(F.lit(0).cast("bigint")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["tokens"])))
        has_system = F.when(F.element_at(ts, 1)["own"] == SYSTEM_ROLE, 1).otherwise(0)
        system = F.when(has_system == 1, F.element_at(ts, 1)["tokens"]).otherwise(0)
        back = F.greatest(F.least(F.lit(history), F.lit(budget - budget // 4) - system), F.lit(0))
        room = F.greatest(F.lit(budget) - back - system, F.lit(1))
        return let(sums, lambda s: let(_starts(s, room), lambda at: F.transform(
            F.sequence(F.lit(0), F.size(at) - 1), lambda k: _window(ts, s, at, k, has_system, back))))
    out = whole.select("conv_id", F.explode(let(F.col("turns"), cut_up)).alias("w"))
    return out.select("conv_id", "w.*")


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, turns array of role and text, loss text, formatted_chars),
    parsed from the formatted windows: repeated turns are skipped, texts
    unescaped, and the loss text cut out by the mask."""
    def cut_out(f, spans):
        return F.array_join(F.transform(spans, lambda s: unescape(F.substring(f, s["start"] + 1, s["len"]))), "")
    roles = F.slice(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1)), F.col("n_repeated") + 1, F.col("n_turns"))
    texts = F.slice(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2)), F.col("n_repeated") + 1, F.col("n_turns"))
    parsed = F.zip_with(roles, texts, lambda a, b: F.struct(unescape(a).alias("role"), unescape(b).alias("text")))
    each = windows.select("conv_id", F.struct("window", parsed.alias("turns"), cut_out(F.col("formatted"), F.col("loss")).alias("loss"),
                                              F.char_length("formatted").cast("bigint").alias("chars")).alias("w"))
    ws = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    return ws.select("conv_id", F.flatten(F.transform("ws", lambda w: w["turns"])).alias("turns"),
                     F.array_join(F.transform("ws", lambda w: w["loss"]), "").alias("loss"),
                     F.aggregate("ws", F.lit(0).cast("bigint"), lambda a, w: a + w["chars"]).alias("formatted_chars"))
