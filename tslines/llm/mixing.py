"""Mixing sources to target weights by entropy balancing.

Of all rates that give a source its target number of tokens and lie between 0 and a limit,
those closest to one in relative entropy are exponentially tilted: min(limit, exp(l * x)), x
a document's size over the source's typical size. The tilt l of each source solves a convex
dual; Newton steps, kept inside a bracket, run for all sources at once as aggregations over
a histogram of (source, size). Rates are then rounded to copies: a document gets the whole
part, and one more if its hash lies low enough, the line being drawn per source where the
target is met. All sums are exact decimals, so reruns agree whatever the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslines.llm.common import broadcast_if_small, whole_text, words
from tslines.session import staged

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Copies of one document at most, and tokens of a source in multiples of its size.
LIMIT = 3
#: Sources whose parameters are broadcast, 100 bytes each; more are joined.
MAX_BROADCAST_SOURCES = 100_000
#: Bins of the rounding line, and parts of the one bin in which a source meets its target;
#: the line is off by such a part's share of the source at most.
BINS, FINE = 1 << 12, 1 << 5
STEPS = 60


def exact(value: Column) -> Column:
    """A double as a decimal whose sum does not depend on the order."""
    return value.cast("decimal(38,6)")


def sized(df: DataFrame, id_col: str, source: str, text: str) -> DataFrame:
    """(id, source, size) of every row; size is the number of words."""
    size = F.size(words(whole_text(text))).cast("long")
    return df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), size.alias("size"))


def targets(histogram: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, weight, target) of every source of (source, size, n).

    Targets share all tokens by weight. Those over their limit stop there and the rest is
    shared anew, round by round, until none is over; each round is one aggregation, of which
    the driver gets three sums.
    """
    per = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))))
    per = staged(per.withColumn("weight", weight), "sources")
    most, total = limit * F.col("source_size"), None
    share = 0.0
    while True:
        full = most < F.col("weight") * share
        sums = per.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, most).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")
        ).first()
        if not sums["weight"] or not sums["all"]:
            break
        now = (sums["all"] - sums["full"]) / sums["weight"]
        if now <= share:
            break
        share = now
    # the same share for all that are not full
    return per.withColumn("target", F.least(most.cast("double"), F.col("weight") * F.lit(share)))


def rate_of(tilt: Column, size: Column, typical: Column, limit: int = LIMIT) -> Column:
    """The tilted rate of a document."""
    return F.exp(F.least(tilt * size / typical, F.log(F.lit(float(limit)))))


def tilts(histogram: DataFrame, wanted: DataFrame, limit: int = LIMIT, steps: int = STEPS) -> DataFrame:
    """(source, typical, tilt) of every source: Newton steps on the logarithm of what the
    tilt takes, halved into a bracket where they leave it. Sources whose target is their
    limit need no tilt, all their rates are the limit; they, and empty ones, get null."""
    size, n = F.col("size"), F.col("n")
    typical = histogram.groupBy("source").agg(F.try_divide(F.sum(size * size * n), F.sum(size * n)).alias("typical"))
    typical = typical.select("source", F.when(F.col("typical") > 0, F.col("typical")).alias("typical"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    joined = wanted.join(typical, same(wanted, typical)).select(wanted["source"], "source_size", "target", "typical")
    open_ = (F.col("target") > 0) & (F.col("target") < F.lit(limit * (1 - 1e-9)) * F.col("source_size"))
    state = joined.withColumns(
        {
            "tilt": F.when(open_, F.log(F.col("target") / F.col("source_size"))),
            "low": F.lit(float("-inf")),
            "high": F.lit(float("inf")),
            "done": ~open_ | F.col("typical").isNull(),
        }
    )
    state = staged(state, "tilts")
    for _ in range(steps):
        if not state.where("not done").limit(1).count():
            break
        left = broadcast_if_small(state.where("not done"), MAX_BROADCAST_SOURCES)
        rows = histogram.join(left, same(histogram, left)).select(left["source"], "size", "n", "tilt", "typical")
        rate = rate_of(F.col("tilt"), size, F.col("typical"), limit)
        free = F.col("tilt") * size / F.col("typical") < F.log(F.lit(float(limit)))
        taken = exact(size * n * rate)
        slope = exact(F.when(free, size * n * rate * size / F.col("typical")).otherwise(0.0))
        sums = rows.groupBy("source").agg(F.sum(taken).cast("double").alias("taken"), F.sum(slope).cast("double").alias("slope"))
        both = state.join(sums, same(state, sums), "left").select(state["*"], "taken", "slope")
        state = staged(both.select("source", "source_size", "target", "typical", *_step()), "tilts")
    return state.select("source", "typical", F.when(open_, F.col("tilt")).alias("tilt"))


def _step() -> list[Column]:
    """The next tilt, bracket and state of a source."""
    tilt, taken, target = F.col("tilt"), F.col("taken"), F.col("target")
    over = taken > target
    low, high = F.when(over, F.col("low")).otherwise(tilt), F.when(over, tilt).otherwise(F.col("high"))
    newton = tilt - F.log(F.greatest(taken, F.lit(1e-6)) / target) * F.greatest(taken, F.lit(1e-6)) / F.greatest(F.col("slope"), F.lit(1e-6))
    # at most this far at once, and the middle of the bracket where a step leaves it
    reach = 4 * (1 + F.abs(tilt))
    bounded = F.greatest(tilt - reach, F.least(tilt + reach, newton))
    middle = F.when((low > float("-inf")) & (high < float("inf")), (low + high) / 2).otherwise(bounded)
    new = F.when((bounded > low) & (bounded < high), bounded).otherwise(middle)
    good = F.col("done") | taken.isNull() | (F.abs(taken - target) <= F.greatest(F.lit(0.5), target * 1e-9)) | (high - low <= F.abs(tilt) * 1e-15)
    return [F.when(good, tilt).otherwise(new).alias("tilt"), F.when(good, F.col("low")).otherwise(low).alias("low"), F.when(good, F.col("high")).otherwise(high).alias("high"), good.alias("done")]


def mix(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The id, `source`, `size`, `source_size`, `target`, `rate` and `copies` of every row.

    Null texts are empty; a null source is a source, the last. Documents without words get
    no copy. Repeated rows and ids are documents of their own, alike ones treated alike. An
    empty table gives no rows. Other columns are not read. The whole text is read once;
    later passes read ids and sizes. The only window without a key numbers the sources.
    """
    rows = staged(sized(df, id_col, source, text), "sizes")
    return _copies(rows, weights, limit).withColumnRenamed("id", id_col)


def _copies(rows: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    histogram = staged(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    wanted = staged(targets(histogram, weights, limit), "targets")
    tilt = tilts(histogram, wanted, limit)
    params = wanted.join(tilt, wanted["source"].eqNullSafe(tilt["source"])).select(wanted["source"].alias("src"), "source_size", "target", "typical", "tilt")
    params = broadcast_if_small(staged(params, "params"), MAX_BROADCAST_SOURCES)
    rated = rows.join(params, rows["source"].eqNullSafe(params["src"])).drop("src")
    solved = rate_of(F.col("tilt"), F.col("size"), F.col("typical"), limit)
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("target") <= 0, F.lit(0.0)).otherwise(F.coalesce(solved, F.lit(float(limit))))
    rated = rated.withColumn("rate", F.least(rate, F.lit(float(limit))))
    # a tie of the last digits with the limit is the limit
    base = F.floor(F.col("rate") + 1e-12)
    part = F.greatest(F.col("rate") - base, F.lit(0.0))
    low_bits = F.xxhash64("id", "size", "source").bitwiseAND(F.lit((1 << 52) - 1))
    draw = low_bits.cast("double") / float(1 << 52)
    # 0 is drawn first; documents at the limit or without words never get one more
    line = F.when((F.col("size") == 0) | (base >= limit), F.lit(None)).otherwise(F.floor((draw - part + 1) * (BINS * FINE / 2)))
    rated = rated.withColumns({"base": base, "fine": line.cast("long")})
    rated = rated.withColumn("bin", F.floor(F.col("fine") / FINE))
    bins = rated.groupBy("source", "bin").agg(
        F.sum(F.col("base") * F.col("size")).alias("whole"), F.sum("size").alias("more"), F.max("target").alias("target")
    )
    by_source = Window.partitionBy("source")
    upto = by_source.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    more = F.when(F.col("bin").isNotNull(), F.col("more")).otherwise(0)
    bins = bins.withColumns({"whole": F.sum("whole").over(by_source), "upto": F.sum(more).over(upto), "more": more})
    # the first bin that goes past the target is looked at in parts
    past = (F.col("whole") + F.col("upto") > F.col("target")) & F.col("bin").isNotNull()
    crossed = F.min(F.when(past, F.struct("bin", (F.col("whole") + F.col("upto") - F.col("more")).alias("before"), "target")))
    lines = bins.groupBy("source").agg(crossed.alias("at"), F.max("bin").alias("last"))
    lines = lines.select(F.col("source").alias("src"), F.col("at.bin").alias("at"), F.col("at.before").alias("before"), F.col("at.target").alias("goal"), "last")
    lines = broadcast_if_small(staged(lines, "lines"), MAX_BROADCAST_SOURCES)
    within = rated.join(lines, rated["source"].eqNullSafe(lines["src"]) & (rated["bin"] == lines["at"]))
    parts = within.groupBy("source", "fine").agg(F.sum("size").alias("more"), F.max("before").alias("before"), F.max("goal").alias("goal"))
    parts = parts.withColumn("upto", F.sum("more").over(by_source.orderBy("fine").rowsBetween(Window.unboundedPreceding, 0)))
    # a part belongs to the mix if its middle is not past the target
    inside = F.col("before") + F.col("upto") - F.col("more") / 2 <= F.col("goal")
    met = parts.groupBy("source").agg(F.max(F.when(inside, F.col("fine"))).alias("met")).withColumnRenamed("source", "own")
    lines = lines.join(met, lines["src"].eqNullSafe(met["own"]), "left")
    # without a bin past the target all are in the mix; without a part, all before the bin
    line = F.when(F.col("at").isNull(), (F.col("last") + 1) * FINE).otherwise(F.coalesce("met", F.col("at") * FINE - 1))
    lines = broadcast_if_small(staged(lines.select("src", line.alias("line")), "line"), MAX_BROADCAST_SOURCES)
    drawn = rated.join(lines, rated["source"].eqNullSafe(lines["src"]))
    copies = F.col("base") + F.when(F.col("fine") <= F.col("line"), 1).otherwise(0)
    return drawn.select("id", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"))


def repeat_rows(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The rows of `df`, each as often as the mix takes it; columns as they are.

    Rows with the same id, source and size get the same copies, so their number is looked up
    by these; the lookup is joined to the texts, which move at most once.
    """
    rows = staged(sized(df, id_col, source, text), "sizes")
    found = _copies(rows, weights, limit).where("copies > 0")
    key = lambda id_, src, size: F.struct(id_.alias("id"), src.alias("source"), size.alias("size"))
    found = found.select(key(F.col("id"), F.col("source"), F.col("size")).alias("key"), "copies").distinct()
    size = F.size(words(whole_text(text))).cast("long")
    whole = df.select(F.struct("*").alias("row"), key(F.col(id_col), F.col(source), size).alias("key"))
    taken = whole.join(found, "key")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
