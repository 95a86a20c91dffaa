"""Mixing sources to target weights by entropy balancing.

Documents get rates ``r`` (expected copies) that meet a token target for every
group and stay as close as possible, in relative entropy weighted by tokens, to
their base rates ``q``.  The dual of that problem is convex in one multiplier
per target, its solution tilts the base rates exponentially,
``r = min(cap, q * exp(lambda_group))``, and a Newton method with a bracket finds the
multipliers: every iteration is one distributed aggregation of the tilted token
sums (dual gradient) and their uncapped part (dual curvature).  Rates are then
rounded to whole copies by systematic sampling along each group's documents in
descending size, with the phase that leaves the smallest residual; further
documents, as many as it takes, then make up what is left of it.

Only DataFrame functions are used on this path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paracorpus.llm.common import spill, with_positions, word_count

#: Phases of the systematic sampling that are compared per group.
PHASES = 64
MAX_NEWTON = 60
TOLERANCE = 1e-9


def group_sizes(docs: DataFrame) -> DataFrame:
    """(grp, total) of a frame with ``grp`` and ``size``; one row per group, null included."""
    return docs.groupBy("grp").agg(F.sum("size").alias("total"))


def fill_targets(groups: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """Targets of (grp, total): groups in code point order, null last, weigh
    ``weights`` in turn and share ``share`` of all tokens; no target exceeds
    ``cap`` times its group's tokens and the excess is shared anew by weight.

    Each round is one aggregation of the group table, which returns two numbers.
    """
    ranked = with_positions(groups.withColumn("is_null", F.col("grp").isNull()), ["is_null", "grp"], "rank", "groups")
    turn = (F.col("rank") % len(weights) + 1).cast("int")
    table = ranked.select(
        "grp", "total", F.element_at(F.lit([float(w) for w in weights]).cast("array<double>"), turn).alias("weight")
    )
    limit = F.col("total") * F.lit(float(cap))
    level, capped_before = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= limit
        row = table.agg(
            F.sum("total").alias("all"),
            F.sum(F.when(full, limit).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("capped"),
        ).first()
        if not row["open"] or row["capped"] == capped_before:
            break
        capped_before = row["capped"]
        level = (share * row["all"] - row["fixed"]) / row["open"]
    goal = limit if level is None else F.least(F.col("weight") * F.lit(level), limit)
    return table.select("grp", "total", goal.alias("target"))


def solve_rates(docs: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Newton iterations on the dual; (grp, total, target, lam) with one multiplier per group.

    ``docs`` holds grp, size, base (base rate).  Documents of one group with the
    same size and base rate are merged first, so an iteration reads a histogram.
    A group whose target is all it can give gets an infinite multiplier.
    """
    cells = spill(
        docs.groupBy("grp", "base").agg(F.sum("size").alias("tokens")).filter("tokens > 0 AND base > 0"),
        "mix_cells",
    )
    state = targets.select("grp", "total", "target", F.lit(0.0).alias("lam"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(False).alias("done"))
    for _ in range(MAX_NEWTON):
        state = spill(state, "mix_state")
        if state.filter(~F.col("done")).limit(1).count() == 0:
            break
        s = state.filter(~F.col("done")).select(F.col("grp").alias("g"), "lam")
        raw = F.col("base") * F.exp("lam")
        sums = (
            cells.join(s, F.col("grp").eqNullSafe(F.col("g")), "inner")
            .groupBy("g")
            .agg(
                F.sum(F.col("tokens") * F.least(raw, F.lit(float(cap)))).alias("taken"),
                F.sum(F.when(raw < cap, F.col("tokens") * raw).otherwise(0.0)).alias("curve"),
                F.sum(F.col("tokens") * F.lit(float(cap))).alias("most"),
            )
        )
        gap = F.col("target") - F.col("taken")
        # Newton on the logarithm of the token sum, exact in one step while nothing is
        # capped; steps that leave the bracket of the root halve it
        grow = F.log(F.col("target") / F.col("taken")) * F.col("taken") / F.col("curve")
        lo = F.when(gap > 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("hi"))
        tried = F.col("lam") + F.when(F.col("curve") > 0, grow)
        half = F.when(lo == float("-inf"), hi - 1).when(hi == float("inf"), lo + 1).otherwise((lo + hi) / 2)
        stepped = F.when((tried > lo) & (tried < hi), tried).otherwise(half)
        joined = state.join(sums, F.col("grp").eqNullSafe(F.col("g")), "left")
        solved = F.abs(gap) <= F.col("target") * TOLERANCE
        lam = (
            F.when(F.col("done"), F.col("lam"))
            .when(F.col("target") <= 0, F.lit(float("-inf")))
            .when(F.col("taken").isNull(), F.col("lam"))
            .when(F.col("target") >= F.col("most") * (1 - TOLERANCE), F.lit(float("inf")))
            .when(solved, F.col("lam"))
            .otherwise(stepped)
        )
        done = (
            F.col("done")
            | (F.col("target") <= 0)
            | F.col("taken").isNull()
            | (F.col("target") >= F.col("most") * (1 - TOLERANCE))
            | solved
        )
        state = joined.select("grp", "total", "target", lam.alias("lam"), lo.alias("lo"), hi.alias("hi"), done.alias("done"))
    return state.select("grp", "total", "target", "lam")


def _copies(rate: Column, rank: Column, phase: Column) -> Column:
    return (F.floor(rate * (rank + 1) + phase) - F.floor(rate * rank + phase)).cast("int")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: int = 2,
    base_rate: str | None = None,
) -> DataFrame:
    """Copies per document: (doc_id, size, source_size, target, rate, copies, taken, tie).

    ``size`` is the word count (null text: 0); ``base_rate`` names an optional
    column of prior rates (null or negative: 0).  No document gets more than
    ``cap`` copies.  Null groups form one group, last in order.  Repeated rows
    are separate documents; ``tie`` (64-bit hash of id and text) orders rows of
    equal group and size, rows equal in all of these are interchangeable.
    Documents of size 0 get no copies when the group's rate is below 1.  The
    result is a function of the rows alone, so reruns agree.  An empty table
    gives an empty result; other columns are ignored.
    """
    base = F.lit(1.0) if base_rate is None else F.greatest(F.coalesce(F.col(base_rate).cast("double"), F.lit(0.0)), F.lit(0.0))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(group_col).alias("grp"),
        word_count(F.col(text_col)).alias("size"),
        base.alias("base"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("tie"),
    )
    order = narrow.select(
        F.col("grp").isNull().alias("is_null"), "grp", F.col("base"), (-F.col("size")).alias("neg"), "tie", "doc_id", "size"
    )
    placed = with_positions(order, ["is_null", "grp", "base", "neg", "tie", "doc_id"], "pos", "mix_docs")
    targets = spill(fill_targets(group_sizes(placed), list(weights), share, cap), "mix_targets")
    solved = spill(solve_rates(placed, targets, cap), "mix_rates")

    # rank inside (group, base rate): the rate is constant there
    first = placed.groupBy("grp", "base").agg(F.min("pos").alias("first"))
    info = spill(
        first.join(solved.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(
            F.col("grp").alias("g"),
            F.col("base").alias("b"),
            "first",
            "total",
            "target",
            F.when(F.col("lam") == float("inf"), F.lit(float(cap)))
            .otherwise(F.least(F.col("base") * F.exp("lam"), F.lit(float(cap))))
            .alias("rate"),
        ),
        "mix_info",
    )
    rated = placed.join(info, F.col("grp").eqNullSafe(F.col("g")) & (F.col("base") == F.col("b"))).withColumn(
        "rank", F.col("pos") - F.col("first")
    )
    trials = [
        F.sum(F.col("size") * _copies(F.col("rate"), F.col("rank"), F.lit(k / PHASES))).alias(f"t{k}") for k in range(PHASES)
    ]
    sums = rated.groupBy("g").agg(F.first("target").alias("goal"), *trials)
    misses = F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("goal")).alias("miss"), F.lit(k / PHASES).alias("phase")) for k in range(PHASES)])
    phases = spill(sums.select(F.col("g").alias("pg"), F.array_min(misses)["phase"].alias("phase")), "mix_phase")
    chosen = rated.join(phases, F.col("g").eqNullSafe(F.col("pg")))
    copies = F.least(_copies(F.col("rate"), F.col("rank"), F.col("phase")), F.lit(cap))
    rounded = spill(
        chosen.select("doc_id", "grp", "size", "total", "target", "rate", copies.alias("copies"), "tie", "pos"), "mix_rounded"
    )
    fixes = spill(_made_up(rounded, cap), "mix_fixes")
    final = rounded.join(fixes, "pos", "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0)))
    return final.select(
        "doc_id",
        "size",
        F.col("total").alias("source_size"),
        "target",
        "rate",
        "copies",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        "tie",
    )


def _made_up(rounded: DataFrame, cap: int) -> DataFrame:
    """(pos, change): documents that get copies more or fewer, so that each group's
    residual falls below the size of its smallest spare copy.

    A spare copy is one that a document may get up to ``cap`` or may lose.  They
    are counted by size, first copies of all documents before second ones.  A
    round takes sizes in descending order up to the residual, of the last size
    as many as fit, which leaves less than half of the residual; rounds go on
    with what still fits.  Only counts are summed along a group; the documents
    of the sizes taken in part are chosen by a distributed position.
    """
    left = rounded.groupBy("grp").agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("gap"))
    left = left.select(F.col("grp").alias("g"), F.floor(F.abs("gap")).cast("long").alias("left"), F.when(F.col("gap") > 0, 1).otherwise(-1).alias("sign"))
    left = spill(left, "mix_left")
    room = F.when(F.col("sign") < 0, F.col("copies")).when(F.col("rate") > 0, F.lit(cap) - F.col("copies")).otherwise(0)
    near = rounded.join(left, F.col("grp").eqNullSafe(F.col("g"))).filter((F.col("size") > 0) & (F.col("size") <= F.col("left")) & (room > 0))
    spare = near.select("g", "sign", "size", "pos", F.explode(F.sequence(F.lit(1), room.cast("int"))).alias("turn"))
    cells = spill(spare.groupBy("g", "turn", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(None).cast("long")), "mix_cells")
    left = left.select("g", "left")
    along = Window.partitionBy("g").orderBy("turn", F.desc("size")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        state = left.select(F.col("g").alias("sg"), "left")
        cells = cells.join(state, F.col("g").eqNullSafe(F.col("sg"))).drop("sg")
        fits = F.col("k").isNull() & (F.col("size") <= F.col("left"))
        words = F.when(fits, F.col("size") * F.col("n")).otherwise(0)
        before = F.col("upto") - F.col("size") * F.col("n")
        some = F.when(F.col("upto") <= F.col("left"), F.col("n")).when(before <= F.col("left"), F.floor((F.col("left") - before) / F.col("size")))
        step = cells.withColumn("fits", fits).withColumn("upto", F.sum(words).over(along))
        step = step.withColumn("now", F.when(F.col("fits"), some).cast("long"))
        step = spill(step.select("g", "turn", "size", "n", F.coalesce("k", "now").alias("k"), "now"), "mix_cells")
        cells = step.drop("now")
        if step.filter("now > 0").limit(1).count() == 0:
            break
        used = step.groupBy(F.col("g").alias("ug")).agg(F.sum(F.coalesce("now", F.lit(0)) * F.col("size")).alias("used"))
        left = left.join(used, F.col("g").eqNullSafe(F.col("ug"))).select("g", (F.col("left") - F.col("used")).alias("left"))
        left = spill(left, "mix_left")

    taken = cells.filter("k > 0").select(F.col("g").alias("tg"), F.col("turn").alias("tt"), F.col("size").alias("ts"), "n", "k")
    of = F.col("g").eqNullSafe(F.col("tg")) & (F.col("turn") == F.col("tt")) & (F.col("size") == F.col("ts"))
    chosen = spill(spare.join(taken, of).select("g", "turn", "size", "pos", "sign", "n", "k"), "mix_chosen")
    part = chosen.filter("k < n").withColumn("is_null", F.col("g").isNull())
    part = with_positions(part, ["is_null", "g", "turn", "size", "pos"], "at", "mix_part")
    first = part.groupBy("g", "turn", "size").agg(F.min("at").alias("first"))
    first = first.select(F.col("g").alias("tg"), F.col("turn").alias("tt"), F.col("size").alias("ts"), "first")
    part = part.join(first, of).filter(F.col("at") - F.col("first") < F.col("k"))
    both = chosen.filter("k = n").select("pos", "sign").unionByName(part.select("pos", "sign"))
    return both.groupBy("pos").agg(F.sum("sign").cast("int").alias("change"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, columns unchanged.

    Rows are matched by id and ``tie``; rows equal in both are counted together
    and the copies of the group go to each row in the order of the group.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    per = mix(docs, **options).groupBy("doc_id", "tie").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    per = spill(per.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "__copies", "__rows"), "mix_copies")
    keyed = docs.withColumn("__t", F.xxhash64(F.col(id_col), F.col(text_col)))
    joined = keyed.join(per, keyed[id_col].eqNullSafe(per["__id"]) & (F.col("__t") == F.col("__tie")))
    out = joined.filter("__rows = 1").withColumn("__n", F.col("__copies"))
    if per.filter("__rows > 1").limit(1).count():
        one = Window.partitionBy("__id", "__tie").orderBy(F.lit(1))
        several = joined.filter("__rows > 1").withColumn("__k", F.row_number().over(one) - 1)
        several = several.withColumn("__n", F.expr("__copies div __rows + if(__k < __copies % __rows, 1, 0)")).drop("__k")
        out = out.unionByName(several)
    out = out.filter("__n > 0")
    return out.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*[F.col(c) for c in docs.columns])


def op10_query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")
