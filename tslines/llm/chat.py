"""Chat formatting by relational expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role are
merged by an array aggregation; marks and escaped texts are concatenated. A mark cannot
occur inside a text, because escaping takes away the two characters every mark begins with.
The loss mask is a list of spans of the formatted text, one for each assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import let, whole_text

# The template. A turn is START role SEP part (PART part)* END; parts are the texts of
# neighbouring turns of one role.
START, SEP, PART, END = "[INST]", "[/INST]", "<part>", "</s>"
#: Characters taken out of texts and roles, each with what stands for it. The first is the
#: escape itself.
ESCAPES = (("&", "&a"), ("<", "&l"), ("[", "&b"))
#: The role whose texts are learned.
LEARNED = "assistant"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """Exact: in escaped text the escape is always followed by its letter."""
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


#: Steps of a running sum over an array: more than an array can hold.
DOUBLINGS = [1 << k for k in range(31)]
#: Code points of the pieces a formatted text is cut into for reading spans from it.
CUT = 1024


def _merged(turns: Column) -> Column:
    """Neighbouring structs (role, text) of one role as one struct (role, parts). A run goes
    from its first place to the next one's, so every turn is copied once."""

    def run(starts: Column) -> Column:
        end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(turns))
        part = lambda s, k: F.slice(turns, s + 1, end(k) - s)
        return F.transform(starts, lambda s, k: F.struct(F.get(turns, s)["role"].alias("role"), F.transform(part(s, k), lambda t: t["text"]).alias("parts")))

    places = F.transform(turns, lambda t, i: i)
    return let(F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])), run)


def _running_sums(numbers: Column) -> Column:
    """Sums of the first, the first two, and so on, by doubling: after a step every place
    holds the sum of twice as many numbers up to it, so n numbers take n log n."""

    def step(sums: Column, width: Column) -> Column:
        before = F.slice(F.concat(F.array_repeat(F.lit(0).cast("long"), width), sums), F.lit(1), F.size(sums))
        return F.zip_with(sums, before, lambda a, b: a + b)

    widths = F.filter(F.array(*map(F.lit, DOUBLINGS)), lambda w: w < F.size(numbers))
    return F.aggregate(widths, numbers, step)


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The conversation id, `formatted` and `loss_spans`: (start, length) in code points of
    every assistant text, as it stands in the formatted text.

    Turns are sorted by number, nulls first; equal numbers by role, then text; repeated rows
    are turns of their own. A null text or role is empty. Rows with a null conversation id
    are one conversation. An empty table gives no rows; other columns are not read. One
    shuffle, by conversation, each of which becomes one row as it has to; its turns take
    n log n steps.
    """
    rows = df.select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), whole_text(text).alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    coded = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))

    def pieces(turns: Column) -> Column:
        # every text with the marks before it and whether it is learned
        def lead(t: Column, k: Column, i: Column) -> Column:
            opened = F.concat(F.when(k > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START), t["role"], F.lit(SEP))
            return F.when(i > 0, F.lit(PART)).otherwise(opened)

        def of_turn(t: Column, k: Column) -> Column:
            return F.transform(t["parts"], lambda p, i: F.struct(lead(t, k, i).alias("lead"), p.alias("text"), (t["role"] == LEARNED).alias("learned")))

        return F.flatten(F.transform(turns, of_turn))

    def laid(p: Column) -> Column:
        whole = F.concat(F.array_join(F.transform(p, lambda x: F.concat(x["lead"], x["text"])), ""), F.lit(END))
        ends = _running_sums(F.transform(p, lambda x: (F.length(x["lead"]) + F.length(x["text"])).cast("long")))
        length = lambda x: F.length(x["text"]).cast("long")
        span = lambda x, e: F.when(x["learned"], F.struct((e - length(x)).alias("start"), length(x).alias("length")))
        spans = F.filter(F.zip_with(p, ends, span), lambda s: s.isNotNull())
        return F.struct(whole.alias("formatted"), spans.alias("loss_spans"))

    done = sorted_.select("conv", let(let(let(coded, _merged), pieces), laid).alias("done"))
    return done.select(F.col("conv").alias(conv), "done.formatted", "done.loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as structs (role, text), merged ones apart again."""
    turns = F.filter(F.split(formatted, _literal(START), -1), lambda t: t != "")

    def texts(t: Column) -> Column:
        # marks cannot occur in a role or text, so the first SEP ends the role
        role = F.substring_index(t, SEP, 1)
        rest = t.substr(F.length(role) + F.lit(len(SEP) + 1), F.length(t) - F.length(role) - F.lit(len(SEP) + len(END)))
        parts = F.split(rest, _literal(PART), -1)
        return F.transform(parts, lambda p: F.struct(unescape(role).alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(turns, texts))


def _literal(mark: str) -> str:
    """A mark as a regular expression for itself."""
    return rf"\Q{mark}\E"


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask. The text is cut into pieces of `CUT` code
    points first, so that a span is not looked for from the beginning of the whole text."""

    def read(pieces: Column) -> Column:
        def text(s: Column) -> Column:
            first = F.floor(s["start"] / CUT).cast("int")
            last = F.floor((s["start"] + s["length"]) / CUT).cast("int")
            near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
            return unescape(near.substr((s["start"] - first * CUT).cast("int") + 1, s["length"].cast("int")))

        return F.transform(spans, text)

    return let(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)), read)
