"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, how many copies of it the mix takes on average. Among
all rates between 0 and 2 that give every source its target of words, the ones
nearest to 1 in relative entropy are exponentially tilted: rate = min(2,
exp(a * size / mean size)), with one dual variable a for each source. The dual is
convex; its Newton steps need two sums a source over a table of (source, size,
count), computed by Spark at each step. Rates are then rounded to whole copies
by a dithered threshold chosen for each source, so that its words come within
about one document of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.line_rules import words_of
from meterlake.llm.shared import fresh, materialize, ranked, release

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
#: The dual is solved when a source's words are within this part of its target; steps that may take at most.
CLOSE, MOST_STEPS = 1e-9, 100
#: Rounding thresholds are found in levels of so many bins.
BINS, LEVELS = 256, 4


def sizes(docs: DataFrame, text_col: str = "text") -> Column:
    """Words of the text; 0 where it is null."""
    return F.coalesce(F.size(words_of(docs[text_col].cast("string"))), F.lit(0)).cast("long")


def targets(by_source: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size) -> with weight and target.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes; a target stops at twice its source's size and the
    excess is shared again by weight, until none is above. That fixed point is one
    level t with target = min(2 * size, t * weight); each step is one aggregate.
    """
    table = ranked(by_source, "source", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    table = materialize(table.withColumn("weight", weight).drop("place"), "sources")
    cap = F.col("source_size") * float(MOST_COPIES)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = cap <= level * F.col("weight")
        row = table.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if not row["open"]:
            break
        new = (share * total - row["stopped"]) / row["open"]
        if new <= level * (1 + 1e-15):
            break
        level = new
    return table.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def exact_sum(value: Column) -> Column:
    """A sum in millionths, which no order of the rows changes; values up to 10**22."""
    return F.sum(value.cast("decimal(28,6)")).cast("double")


def dual(table: DataFrame, sized: DataFrame) -> DataFrame:
    """The tilt of each source by Newton steps: table with ``tilt`` (null where all documents go twice).

    A source's words grow with its tilt, so each step also narrows the interval
    that holds the solution; a Newton step that leaves it is replaced by its middle.
    A dual that is not solved after MOST_STEPS is an error.
    """
    mean = sized.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean")
    )
    whole = F.col("target") >= MOST_COPIES * F.col("source_size") * (1 - 1e-12)
    state = table.join(mean.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    # start at the tilt that a source of equal documents would need
    start = F.log(F.col("target") / F.col("source_size"))
    none = F.lit(None).cast("double")
    state = state.withColumns({"tilt": F.when(~whole, F.coalesce(start, F.lit(0.0))), "low": none, "high": none})
    state = materialize(state, "dual")
    for _ in range(MOST_STEPS):
        both = sized.withColumnRenamed("source", "source_").join(
            state, F.col("source").eqNullSafe(F.col("source_"))
        )
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        free = rate < MOST_COPIES
        words = F.col("size") * F.col("n")
        sums = both.groupBy("source_").agg(
            exact_sum(words * F.least(rate, F.lit(float(MOST_COPIES)))).alias("got"),
            exact_sum(F.when(free, words * x * rate).otherwise(0.0)).alias("slope"),
        )
        step = (F.col("target") - F.col("got")) / F.col("slope")
        bounded = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step))
        close = F.abs(F.col("target") - F.col("got")) < CLOSE * F.col("target")
        short = F.col("got") < F.col("target")
        # without a slope all documents go twice, for a target below that, or next to none
        back = F.when(F.col("slope") > 0, bounded).when(short, F.lit(0.5)).otherwise(F.lit(-0.5))
        low, high = F.when(short, F.col("tilt")).otherwise(F.col("low")), F.when(short, F.col("high")).otherwise(F.col("tilt"))
        new = F.col("tilt") + back
        new = F.when((new <= low) | (new >= high), F.coalesce((low + high) / 2, new)).otherwise(new)
        new = F.when(close, F.col("tilt")).otherwise(new)
        error = F.max(F.abs(F.col("target") - F.col("got")) / F.col("target"))
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("source_")))
        moved = joined.withColumns({"new": F.when(F.col("tilt").isNotNull(), new), "new_low": low, "new_high": high})
        moved = moved.drop("tilt", "low", "high", "source_")
        kept = materialize(moved.withColumnsRenamed({"new": "tilt", "new_low": "low", "new_high": "high"}), "dual")
        worst = kept.where("tilt IS NOT NULL").agg(error).first()[0]
        release(state)
        state = kept.drop("got", "slope")
        state.scratch = kept.scratch
        if worst is None or worst < CLOSE:
            return state
    raise RuntimeError(f"the dual of the mix is not solved after {MOST_STEPS} steps: {worst} of a target is missing")


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """What the mix needs of a row: its source, its size, and a dither in [0, 1) from its values."""
    mark = F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string"), F.lit(11))
    return {
        "source": docs[source_col].cast("string"),
        "size": sizes(docs, text_col),
        "dither": F.pmod(mark, F.lit(2**40)) / float(2**40),
    }


def rate_of(tilt: Column, mean: Column, size: Column) -> Column:
    """The tilted rate of a document; without a tilt its source goes twice."""
    tilted = F.exp(F.least(tilt * size / mean, F.lit(700.0)))
    rate = F.when(tilt.isNull(), float(MOST_COPIES)).otherwise(F.least(F.lit(float(MOST_COPIES)), tilted))
    return F.when(size == 0, 0.0).otherwise(rate)


def copies_of(rate: Column, dither: Column, shift: Column, size: Column) -> Column:
    """Whole copies: floor(rate + dither + shift), within 0 and 2; a text without words has none."""
    whole = F.floor(rate + dither + F.coalesce(shift, F.lit(0.0)))
    within = F.least(F.lit(MOST_COPIES), F.greatest(F.lit(0), whole))
    return F.when(size == 0, F.lit(0)).otherwise(within).cast("long")


def plan_sources(rows: DataFrame, share: float = SHARE) -> DataFrame:
    """rows (source, size, dither) -> a row for each source: source_size, target, mean, tilt, shift."""
    sized = materialize(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    state = dual(targets(by_source, share), sized)
    plan = state.select(F.col("source").alias("source_"), "source_size", "target", "tilt", "mean")
    rated = rows.join(plan, F.col("source").eqNullSafe(F.col("source_"))).select(
        "source", "target", "size", "dither", rate_of(F.col("tilt"), F.col("mean"), F.col("size")).alias("rate")
    )
    shift = thresholds(rated).withColumnRenamed("source_", "with_shift")
    out = plan.join(shift, F.col("source_").eqNullSafe(F.col("with_shift")), "left").drop("with_shift")
    out = materialize(out.withColumnRenamed("source_", "source"), "mix-plan")
    release(sized, state)
    return out


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = SHARE,
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken of each row.

    ``copies`` is 0, 1 or 2 and ``taken`` = copies * size. Null texts and texts
    without words have size 0 and no copies. Rows that repeat, also with the same
    id, are mixed each by itself, by their values alone, so that reruns agree and
    equal rows fare alike. An empty table gives no rows.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), *[c.alias(n) for n, c in measured(docs, id_col, text_col, source_col).items()]
    )
    rows = materialize(rows, "mix-rows")
    plan = plan_sources(rows, share).withColumnRenamed("source", "source_")
    both = rows.join(plan, F.col("source").eqNullSafe(F.col("source_")))
    both = both.withColumn("rate", rate_of(F.col("tilt"), F.col("mean"), F.col("size")))
    both = both.withColumn("copies", copies_of(F.col("rate"), F.col("dither"), F.col("shift"), F.col("size")))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return both.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", taken)


def with_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = SHARE,
) -> DataFrame:
    """The rows of docs that the mix takes, with the column ``copies``: how often each goes in.

    A column of docs that has this name already is replaced.
    """
    values = measured(docs, id_col, text_col, source_col)
    plan = plan_sources(materialize(docs.select(*[c.alias(n) for n, c in values.items()]), "mix-rows"), share)
    # names that docs does not have
    own = {c: fresh(docs, f"_mix_{c}") for c in plan.columns}
    plan = plan.withColumnsRenamed(own)
    both = docs.join(plan, values["source"].eqNullSafe(plan[own["source"]]))
    rate = rate_of(plan[own["tilt"]], plan[own["mean"]], values["size"])
    taken = fresh(docs, "_mix_copies")
    copies = copies_of(rate, values["dither"], plan[own["shift"]], values["size"])
    return both.withColumn(taken, copies).where(F.col(taken) > 0).select(
        *[docs[c] for c in docs.columns if c.lower() != "copies"], F.col(taken).alias("copies")
    )


def thresholds(rated: DataFrame) -> DataFrame:
    """The shift of each source at which its taken words come nearest to its target.

    Copies grow with the shift. A document's first and second copy come at the
    shifts 1 - rate - dither and 2 - rate - dither; the words of all copies that
    came before a shift are what the source takes. The place where they reach the
    target is found level by level: each level sums words over BINS bins of the
    bin found before (an aggregate over all rows, then a window over BINS rows a
    source), and after the last one the bin's lower or upper edge is taken,
    whichever is nearer.
    """
    came = rated.where("size > 0").select(
        "source", "target", "size", F.explode(F.array([F.lit(float(k + 1)) for k in range(MOST_COPIES)])).alias("k"), "rate", "dither"
    )
    came = came.select("source", "target", "size", (F.col("k") - F.col("rate") - F.col("dither")).alias("at"))
    bounds = came.groupBy(F.col("source").alias("source_")).agg(F.max("target").alias("target_"))
    bounds = bounds.withColumns({"low": F.lit(-3.0), "width": F.lit(6.0), "before": F.lit(0.0)})
    for level in range(LEVELS):
        both = came.join(bounds, F.col("source").eqNullSafe(F.col("source_")))
        bin_ = F.floor((F.col("at") - F.col("low")) / (F.col("width") / BINS)).cast("int")
        inside = both.withColumn("bin", bin_).where((F.col("bin") >= 0) & (F.col("bin") < BINS))
        sums = inside.groupBy("source_", "target_", "low", "width", "before", "bin").agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source_").orderBy("bin")
        run = sums.withColumn("after", F.col("before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        # the first bin that reaches the target, or the last one of the source
        hit = F.coalesce(
            F.min(F.when(F.col("after") >= F.col("target_"), F.struct("bin", "after", "words"))),
            F.max(F.struct("bin", "after", "words")),
        )
        found = run.groupBy("source_", "target_", "low", "width").agg(hit.alias("hit"))
        bounds = materialize(
            found.select(
                "source_",
                "target_",
                (F.col("low") + F.col("hit.bin") * F.col("width") / BINS).alias("low"),
                (F.col("width") / BINS).alias("width"),
                (F.col("hit.after") - F.col("hit.words")).alias("before"),
                F.col("hit.after").alias("after"),
            ),
            "mix-bins",
        )
    up = (F.col("after") - F.col("target_")) <= (F.col("target_") - F.col("before"))
    return bounds.select("source_", (F.col("low") + F.when(up, F.col("width")).otherwise(0.0)).alias("shift"))
