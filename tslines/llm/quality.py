"""Quality rules as a short-circuit cascade of SQL expressions.

Every rule is a condition on counts that are themselves expressions over the text. A sample
tells what each rule costs and which rows it rejects; rules are then chained so that the
next one rejects the most of what is left per second. A CASE stops at the first rule that
rejects, so costly counts are made only for rows that cheap rules let pass. The order
changes the time, never the verdict.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import SPACES, let, whole_text, words
from tslines.session import staged

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: Rows of the sample that costs and rejections are estimated on.
SAMPLE_ROWS = 2000
#: How long all rules together should run on the repeated sample, so that the start of a job
#: does not count as a rule's cost, and how often it is repeated at most.
TIMED_SECONDS, MOST_COPIES = 0.3, 4096
#: Rows of the sample that are timed.
TIMED_ROWS = 256


@dataclass(frozen=True)
class Rule:
    """`rejects` makes the condition from a function that gives a count's column by name;
    `base` rules are those of the contract."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]
    base: bool = False


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACES}]"))


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a window of eight words found twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes. Texts without a hash twice,
    nearly all, end there; else windows are sorted by hash, the places of those next to an
    equal one are sorted, and each place covers its window up to the next place.
    """

    def windows(h: Column) -> Column:
        # of two, four, then eight words, each from the windows before
        twos = F.zip_with(h, F.slice(h, F.lit(2), F.size(h)), lambda a, b: F.xxhash64(a, b))
        fours = F.zip_with(twos, F.slice(twos, F.lit(3), F.size(h)), lambda a, b: F.xxhash64(a, b))
        eights = F.zip_with(fours, F.slice(fours, F.lit(5), F.size(h)), lambda a, b: F.xxhash64(a, b))
        return F.slice(eights, F.lit(1), F.size(h) - (WINDOW - 1))

    def places(s: Column) -> Column:
        twice = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        return F.array_sort(F.transform(F.filter(s, lambda x, k: F.coalesce(twice(x, k), F.lit(False))), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def repeated(eights: Column) -> Column:
        placed = F.array_sort(F.transform(eights, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        none = F.size(F.array_distinct(eights)) == F.size(eights)
        return F.when(none, F.lit(0)).otherwise(let(placed, lambda s: let(places(s), covered)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(let(hashes, windows), repeated)).cast("long")


#: Every count from the text and its words.
COUNTS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words: F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
    "n_lines": lambda text, words: F.size(_lines(text)).cast("long"),
    "n_dup_lines": lambda text, words: let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda text, words: n_repeat_words(words),
}

RULES = (
    Rule("few_words", lambda c: c("n_words") < 20, base=True),
    Rule("repeated_words", lambda c: 100 * c("n_repeat_words") > 30 * c("n_words"), base=True),
    Rule("symbols", lambda c: 10 * c("n_symbols") > c("n_words")),
    Rule("repeated_lines", lambda c: 2 * c("n_dup_lines") > c("n_lines")),
    Rule("word_length", lambda c: (2 * c("word_chars") < 5 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
)


def _made(text: Column, words: Column) -> Callable[[str], Column]:
    """Counts as expressions over a text and its words."""
    return lambda name: COUNTS[name](text, words)


def estimate(sample: DataFrame, rules: tuple[Rule, ...], seconds: float = TIMED_SECONDS) -> tuple[dict[str, float], dict[tuple[str, ...], int]]:
    """Seconds each rule takes on the sample (`text`, `words`), and the number of rows by the
    set of rules that reject them: at most two to the number of rules rows reach the driver.

    Rejections are counted on the whole sample. `TIMED_ROWS` of it are repeated until all rules together take `seconds` longer than a job that
    only reads it; a rule's cost is the median of three runs, less such a job's median.
    Words are split in the sample, as the cascade splits them once for all rules.
    """
    count = _made(F.col("text"), F.col("words"))

    def timed(condition: Column, copies: int, runs: int = 3) -> float:
        repeated = sample.limit(TIMED_ROWS).select(F.explode(F.sequence(F.lit(1), F.lit(copies))), "text", "words")
        took = []
        for _ in range(runs):
            # a new query each time: the same one would keep what its shuffle wrote
            start = time.perf_counter()
            repeated.agg(F.count_if(condition)).collect()
            took.append(time.perf_counter() - start)
        return statistics.median(took)

    nothing = (F.size("words") < 0) | (F.length("text") < 0)
    every = reduce(lambda a, b: a + b, [rule.rejects(count).cast("int") for rule in rules]) < 0
    timed(every, 1, 1), timed(nothing, 1, 1)  # compile
    copies = 1
    while copies < MOST_COPIES and timed(every, copies, 1) - timed(nothing, copies, 1) < seconds:
        copies *= 4
    idle = timed(nothing, copies)
    cost = {rule.name: max(timed(rule.rejects(count), copies) - idle, 1e-6) / copies for rule in rules}
    flags = [rule.rejects(count).alias(rule.name) for rule in rules]
    sets = sample.select(*flags).groupBy(*[r.name for r in rules]).count().collect()
    return cost, {tuple(r.name for r in rules if row[r.name]): row["count"] for row in sets}


def ordered(rules: tuple[Rule, ...], cost: dict[str, float], sets: dict[tuple[str, ...], int]) -> list[Rule]:
    """Rules by rejected rows per second, each counted on what the earlier ones let pass."""
    left, chain, rows = list(rules), [], dict(sets)
    while left:
        gain = {r.name: sum(n for s, n in rows.items() if r.name in s) / cost[r.name] for r in left}
        best = max(left, key=lambda r: (gain[r.name], -cost[r.name]))
        chain.append(best)
        left.remove(best)
        rows = {s: n for s, n in rows.items() if best.name not in s}
    return chain


def cascade(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The order of the rules for `df`, from about `sample_rows` rows drawn evenly from all of
    it, which are all that leaves the tasks. The sample only steers the order."""
    drawn = df.select(whole_text(text).alias("text")).sample(min(1.0, sample_rows / max(df.count(), 1)), seed=6)
    sample = staged(drawn.repartition(1).select("text", words(F.col("text")).alias("words")), "sample")
    return ordered(rules, *estimate(sample, rules))


def rejected(chain: list[Rule], count: Callable[[str], Column]) -> Column:
    """Whether some rule rejects: a CASE that stops at the first."""
    verdict = F.when(chain[0].rejects(count), F.lit(True))
    for rule in chain[1:]:
        verdict = verdict.when(rule.rejects(count), F.lit(True))
    return verdict.otherwise(F.lit(False))


def passing(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `df` that no rule rejects, columns as they are. Null counts as empty and
    is rejected for its few words. Rows are independent, so ties, repeated rows and ids do
    not matter; an empty table stays empty. No shuffle and no Python."""
    chain = cascade(df, text, rules)
    whole = whole_text(text)
    # words are bound inside the condition: as a column of their own they would be put into
    # every rule when the filter moves below the projection
    return df.where(~let(words(whole), lambda w: rejected(chain, _made(whole, w))))


def quality(df: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The id, all counts, `base_failed` and `kept` of every row. Here the counts are asked
    for, so they are made once per row and the cascade reads them; else as `passing`."""
    chain = cascade(df, text, rules)
    whole = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    whole = whole.select("id", "text", words(F.col("text")).alias("words"))
    counted = whole.select("id", *[_made(F.col("text"), F.col("words"))(name).alias(name) for name in COUNTS])
    base = [rule for rule in chain if rule.base]
    verdicts = {"base_failed": rejected(base, F.col) if base else F.lit(False), "kept": ~rejected(chain, F.col)}
    return counted.withColumns(verdicts).withColumnRenamed("id", id_col)
