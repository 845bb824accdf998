"""I/Q readout channels to fractional frequency shift."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.flags import is_finite
from starloom.functions.medians import exact_median

CHANNEL = r"^r(\d+)_([IQ])$"


def _channels(iq: DataFrame) -> DataFrame:
    return iq.withColumns({"res_id": F.regexp_extract("channel", CHANNEL, 1).cast("int"), "part": F.regexp_extract("channel", CHANNEL, 2)})


def pair_iq(iq: DataFrame) -> DataFrame:
    """block, res_id, det, t_ticks, i, q from rows (block, channel, t_ticks, value)."""
    pick = lambda p: F.max(F.when(F.col("part") == p, F.col("value")))
    out = _channels(iq).where("part <> ''").groupBy("block", "res_id", "t_ticks").agg(pick("I").alias("i"), pick("Q").alias("q"))
    return out.withColumn("det", F.concat("block", F.format_string(":r%04d", "res_id")))


def validate_iq(iq: DataFrame) -> DataFrame:
    """block, problem: bad names, duplicates, missing halves, gaps in the ids, lists that change between frames or files."""
    spans = [(by, message) for by, message in (("frame", "channel list changes"), ("file_idx", "detector list changes between files")) if by in iq.columns]
    # the rows are read for this table of names and for the count of equal ones, and names are taken apart in it
    seen = iq.groupBy("block", "channel", *(by for by, _ in spans)).agg(F.count("*").alias("rows"))
    c = _channels(seen)
    bad = c.where("part = ''").select("block", F.lit("bad channel name").alias("problem"))
    good = c.where("part <> ''")
    twice = iq.groupBy("block", "channel", "t_ticks").agg(F.count("*").alias("n")).groupBy("block", "channel").agg(F.max("n").alias("n")).where("n > 1")
    dup = _channels(twice).where("part <> ''").select("block", F.lit("duplicate channel").alias("problem"))
    half = good.groupBy("block", "res_id").agg(F.countDistinct("part").alias("n")).where("n < 2").select("block", F.lit("missing half").alias("problem"))
    gap = good.groupBy("block").agg(F.max("res_id").alias("m"), F.countDistinct("res_id").alias("n")).where("m + 1 <> n").select("block", F.lit("ids not contiguous").alias("problem"))
    parts = [bad, dup, half, gap]
    for by, message in spans:  # a list of channels for each block and frame or file
        lists = good.groupBy("block", by).agg(F.array_sort(F.collect_set("channel")).alias("l"))
        parts.append(lists.groupBy("block").agg(F.countDistinct("l").alias("n")).where("n > 1").select("block", F.lit(message).alias("problem")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def validate_sweep(sweep: DataFrame, tones: DataFrame) -> DataFrame:
    """block, res_id, problem: too few points, frequencies not rising or not positive, tone outside, no gradient,
    not exactly one sweep (where sweeps have a sweep_id), more than one comb tone."""
    w = Window.partitionBy("block", "res_id").orderBy("pt")
    s = sweep.withColumn("prev", F.lag("freq").over(w))
    stats = s.groupBy("block", "res_id").agg(F.count("*").alias("n"), F.min("freq").alias("lo"), F.max("freq").alias("hi"), F.bool_or(F.col("prev") >= F.col("freq")).alias("falls"), F.bool_or(~(is_finite(F.col("freq")) & is_finite(F.col("i")) & is_finite(F.col("q")))).alias("holes"))
    ref = tone_reference(sweep, tones).select("block", "res_id", (F.col("di") ** 2 + F.col("dq") ** 2).alias("g2"))
    j = stats.join(tones, ["block", "res_id"], "left").join(ref, ["block", "res_id"], "left")
    tests = [(F.col("n") < 2, "fewer than two points"), (F.coalesce(F.col("falls"), F.lit(False)) | (F.col("lo") <= 0), "frequencies must rise from above 0"), (F.col("holes"), "values missing"), ((F.col("f_tone") < F.col("lo")) | (F.col("f_tone") > F.col("hi")), "tone outside the sweep"), ((F.col("g2") == 0) & F.col("f_tone").between(F.col("lo"), F.col("hi")), "no gradient at the tone")]
    problems = F.filter(F.array(*(F.when(t, F.lit(m)) for t, m in tests)), lambda p: p.isNotNull())
    out = j.select("block", "res_id", F.explode(problems).alias("problem"))
    combs = tones.groupBy("block", "res_id").agg(F.count("*").alias("n"))
    lone = tones.join(sweep, ["block", "res_id"], "left_anti").select("block", "res_id", F.lit("no sweep").alias("problem"))
    out = out.unionByName(lone).unionByName(combs.where("n > 1").select("block", "res_id", F.lit("more than one comb tone").alias("problem")))
    if "sweep_id" in sweep.columns:
        many = sweep.groupBy("block", "res_id").agg(F.countDistinct("sweep_id").alias("n")).where("n > 1")
        out = out.unionByName(many.select("block", "res_id", F.lit("more than one sweep").alias("problem")))
    return out.distinct()


def sweep_i_min(sweep: DataFrame) -> DataFrame:
    """block, res_id, pt of the smallest |I + jQ|, at most the last but one."""
    m = sweep.groupBy("block", "res_id").agg(F.min(F.struct((F.col("i") ** 2 + F.col("q") ** 2).alias("p"), "pt")).alias("b"), F.max("pt").alias("last"))
    return m.select("block", "res_id", F.least(F.col("b.pt"), F.col("last") - 1).alias("pt"))


def sweep_i_dvmax(sweep: DataFrame) -> DataFrame:
    """block, res_id, pt before the largest step between neighbours; the first of equals."""
    w = Window.partitionBy("block", "res_id").orderBy("pt")
    d = sweep.withColumn("step2", (F.lead("i").over(w) - F.col("i")) ** 2 + (F.lead("q").over(w) - F.col("q")) ** 2)
    m = d.where("step2 is not null").groupBy("block", "res_id").agg(F.max(F.struct("step2", (-F.col("pt")).alias("np"))).alias("b"), F.max("pt").alias("last"))
    return m.select("block", "res_id", F.least(-F.col("b.np"), F.col("last")).alias("pt"))


def tone_from_median(iq: DataFrame, sweep: DataFrame) -> DataFrame:
    """block, res_id, f_tone: the sweep's frequency nearest to the median of the data."""
    med = exact_median(iq, ["block", "res_id"], "i").withColumnRenamed("i", "mi").join(exact_median(iq, ["block", "res_id"], "q").withColumnRenamed("q", "mq"), ["block", "res_id"])
    d = sweep.join(med, ["block", "res_id"]).withColumn("d2", (F.col("i") - F.col("mi")) ** 2 + (F.col("q") - F.col("mq")) ** 2)
    return d.groupBy("block", "res_id").agg(F.min(F.struct("d2", "pt", "freq")).alias("b")).select("block", "res_id", F.col("b.freq").alias("f_tone"))


def probe_tone(sweep: DataFrame, comb: DataFrame | None) -> DataFrame:
    """The comb's tone where there is one, else the frequency at the largest step of the sweep."""
    own = sweep_i_dvmax(sweep).join(sweep, ["block", "res_id", "pt"]).select("block", "res_id", F.col("freq").alias("__own"))
    if comb is None:
        return own.withColumnRenamed("__own", "f_tone")
    return own.join(comb, ["block", "res_id"], "left").select("block", "res_id", F.coalesce("f_tone", "__own").alias("f_tone"))


def tone_reference(sweep: DataFrame, tones: DataFrame) -> DataFrame:
    """block, res_id, f_tone, i0, q0, di, dq, df: the sweep at the tone, from its nearest point and the one beyond.

    The neighbour is on the tone's side; at an exact hit the next point, or the one before at the end.
    di, dq are the changes of I and Q over df, the frequency step from the nearest point to the neighbour.
    """
    j = sweep.join(tones, ["block", "res_id"])
    near = j.groupBy("block", "res_id", "f_tone").agg(F.min(F.struct(F.abs(F.col("freq") - F.col("f_tone")).alias("d"), "pt", "freq", "i", "q")).alias("a"), F.max("pt").alias("last"), F.min("pt").alias("first"))
    up = F.when(F.col("f_tone") == F.col("a.freq"), F.col("a.pt") < F.col("last")).otherwise(F.col("f_tone") > F.col("a.freq"))
    near = near.withColumn("pt", F.greatest("first", F.least("last", F.when(up, F.col("a.pt") + 1).otherwise(F.col("a.pt") - 1))))
    two = near.join(sweep, ["block", "res_id", "pt"])
    share = (F.col("f_tone") - F.col("a.freq")) / (F.col("freq") - F.col("a.freq"))
    return two.select("block", "res_id", "f_tone", (F.col("a.i") + share * (F.col("i") - F.col("a.i"))).alias("i0"), (F.col("a.q") + share * (F.col("q") - F.col("a.q"))).alias("q0"), (F.col("i") - F.col("a.i")).alias("di"), (F.col("q") - F.col("a.q")).alias("dq"), (F.col("freq") - F.col("a.freq")).alias("df"))


def iq_to_df_gradient(iq: DataFrame, ref: DataFrame) -> DataFrame:
    """Adds df_f0: (I, Q) less the reference, projected on the sweep's local tangent."""
    j = iq.join(ref, ["block", "res_id"])
    gi, gq = F.col("di") / F.col("df"), F.col("dq") / F.col("df")
    shift = ((F.col("i") - F.col("i0")) * gi + (F.col("q") - F.col("q0")) * gq) / (gi * gi + gq * gq)
    return j.withColumn("shift_hz", shift).withColumn("df_f0", F.col("shift_hz") / F.col("f_tone"))


def _phase_lines(sweep: DataFrame, cells: int) -> DataFrame:
    """block, res_id, cell, lo, hi, f, slope: lines between sweep points that follow in phase, in each phase cell that they cross."""
    by = Window.partitionBy("block", "res_id").orderBy("p", "pt")  # a row a sweep point
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = 2 * math.pi
    s = sweep.withColumns({"p1": F.lead("p").over(by), "f1": F.lead("freq").over(by), "pf": F.first("p").over(every), "ff": F.first("freq").over(every)})
    slope = (F.coalesce("f1", "ff") - F.col("freq")) / (F.coalesce(F.col("p1"), F.col("pf") + turn) - F.col("p"))
    line = s.select("block", "res_id", F.col("p").alias("lo"), F.coalesce(F.col("p1"), F.lit(turn)).alias("hi"), F.col("freq").alias("f"), slope.alias("slope"), F.col("p1").isNull().alias("closes"), "pf")
    # the last line goes on from phase 0 to the first point
    rest = line.where("closes").select("block", "res_id", F.lit(0.0).alias("lo"), F.col("pf").alias("hi"), (F.col("f") + (turn - F.col("lo")) * F.col("slope")).alias("f"), "slope")
    both = line.select(rest.columns).unionByName(rest).where("lo < hi")
    cell = lambda c: F.floor(F.col(c) / turn * cells)
    return both.withColumn("cell", F.explode(F.sequence(cell("lo"), cell("hi"))))


def iq_to_df_angle(iq: DataFrame, sweep: DataFrame, tones: DataFrame, cells: int = 64) -> DataFrame:
    """Adds df_f0 from the phase about the sweep's centre, on lines between the sweep's points in order of phase.

    The sample's cell of phase and the lines that cross it are equi-joined, and the line that holds the phase is kept.
    """
    keys = ["block", "res_id"]
    mid = lambda c: ((F.min(c) + F.max(c)) / 2).alias(f"c{c}")
    centre = sweep.groupBy(*keys).agg(mid("i"), mid("q"))
    phase = F.pmod(F.atan2(F.col("q") - F.col("cq"), F.col("i") - F.col("ci")), F.lit(2 * math.pi))
    lines = _phase_lines(sweep.join(centre, keys).withColumn("p", phase), cells).join(tones, keys)
    own = iq.join(centre, keys).withColumn("x", phase).drop("ci", "cq").withColumn("cell", F.floor(F.col("x") / (2 * math.pi) * cells))
    met = own.join(lines, [*keys, "cell"]).where("lo <= x and x < hi")
    freq = F.col("f") + (F.col("x") - F.col("lo")) * F.col("slope")
    return met.withColumn("df_f0", (freq - F.col("f_tone")) / F.col("f_tone")).select(*iq.columns, "f_tone", "df_f0")


def iq_to_df_hybrid(iq: DataFrame, sweep: DataFrame, tones: DataFrame, tol: float = 4.0) -> DataFrame:
    """df_f0 by gradient, or by angle where the shift is over tol sweep steps; angle_used tells which."""
    g = iq_to_df_gradient(iq, tone_reference(sweep, tones)).withColumn("angle_used", F.abs("shift_hz") > tol * F.abs("df"))
    near = g.where("not angle_used").select("block", "res_id", "t_ticks", "i", "q", "df_f0", "angle_used")
    far = iq_to_df_angle(g.where("angle_used").select("block", "res_id", "t_ticks", "i", "q", "angle_used"), sweep, tones)
    return near.unionByName(far.select(near.columns))
