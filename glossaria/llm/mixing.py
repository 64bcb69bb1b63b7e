"""Mixing sources to target weights.

How often a source is used on average follows from its share of the total size: that many whole copies of
every record are certain, the fraction is drawn. The draw is Pareto order sampling with unequal chances: a record's
inclusion chance is in proportion to its weight (by default its size), at most 1; records are ranked by their
random odds divided by their inclusion odds, and the lowest ranks are taken, in order and none passed over, until the
size is reached; the record that crosses it is taken if that comes nearer. Records are drawn in strata of like size,
the largest first, each stratum for the size its chances add up to; by what one stratum's last record misses or
exceeds its size, the next one's is raised or lowered, so a source ends within its smallest records of its share. The
random number of a record is a hash of its id and the seed, so a rerun, or the loss of an executor, changes nothing.

Neither the factor of the chances nor the cut needs a source sorted: the factor comes from sums over bins of the
weights, a cut from sums over bins of the ranks, and only the one bin with the cut, some hundred records, is ordered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaria.workspace import materialise

#: Records per bin, and most bins per source.
PER_BIN, MOST_BINS = 200, 1 << 20
#: Bins of the weights to a doubling.
WEIGHT_BINS = 64
#: Sizes of one stratum are within this factor.
LEVEL = 4


def uniform(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on key and seed only."""
    return (F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def plan(sizes: DataFrame, targets: DataFrame, total: int | None = None, most_sources: int = 10_000) -> DataFrame:
    """Per source ``(source, target_share, max_repeats, n_docs, tokens, budget, copies, fraction, rest)``.

    The total is the largest that all shares allow under their caps, or ``total`` if that is less. Targets
    that are null or not positive, or whose source has no tokens, ask for nothing and get nothing; the
    others then keep their proportions to each other. Repeated target rows count once.
    """
    wanted = targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats")).where("source is not null").dropDuplicates(["source"])
    if wanted.limit(most_sources + 1).count() > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    have = sizes.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    rows = wanted.join(F.broadcast(have.join(F.broadcast(wanted.select("source")), "source", "left_semi")), "source", "left").fillna(0, ["n_docs", "tokens"])
    share = F.when((F.col("target_share") > 0) & (F.col("tokens") > 0) & (F.col("max_repeats") > 0), F.col("target_share")).otherwise(0.0)
    everything = Window.partitionBy()
    rows = rows.withColumn("share", share).withColumn("share", F.try_divide(F.col("share"), F.sum("share").over(everything)))
    most = F.min(F.try_divide(F.col("max_repeats") * F.col("tokens"), F.col("share"))).over(everything)
    rows = rows.withColumn("total", F.least(most, F.lit(float(total)) if total is not None else most)).withColumn("budget", F.coalesce(F.col("share") * F.col("total"), F.lit(0.0)))
    times = F.when(F.col("budget") > 0, F.least(F.try_divide(F.col("budget"), F.col("tokens")), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return (
        rows.withColumn("times", times)
        .withColumn("copies", F.floor(F.col("times") + 1e-9).cast("int"))
        .withColumn("rest", F.greatest(F.col("budget") - F.col("copies") * F.col("tokens"), F.lit(0.0)))
        .withColumn("fraction", F.when(F.col("copies") >= F.col("max_repeats"), 0.0).otherwise(F.try_divide(F.col("rest"), F.col("tokens"))))
        .select("source", "target_share", "max_repeats", "n_docs", "tokens", "budget", "copies", F.coalesce("fraction", F.lit(0.0)).alias("fraction"), "rest")
    )


def _factors(docs: DataFrame) -> dict[str, float]:
    """Per source the factor k for which chances min(1, k * w) have the source's rest as their expected size.

    One pass: sums per bin of the logarithm of w, WEIGHT_BINS to a doubling; within a bin the weights are taken as equal.
    """
    bin_of = F.floor(F.log2("w") * WEIGHT_BINS).cast("int")
    rows = docs.where("w > 0 and fraction > 0").groupBy("source", bin_of.alias("bin")).agg(F.sum("n_tokens").alias("size"), F.sum(F.col("w") * F.col("n_tokens")).alias("open"), F.max("w").alias("w"), F.max("rest").alias("rest")).collect()
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    out = {}
    for source, bins in by.items():
        bins.sort(key=lambda r: -r["bin"])
        rest, open_ = float(bins[0]["rest"]), float(sum(r["open"] for r in bins))
        for r in bins:  # the heaviest become certain, one bin after the other, while the factor asks for it
            if rest <= 0 or not open_ or rest / open_ * r["w"] < 1:
                break
            rest, open_ = rest - r["size"], open_ - r["open"]
        out[source] = max(rest, 0.0) / open_ if open_ > 0 else float("inf")
    return out


def pareto_mix(sizes: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 1, weight: str | None = "n_tokens", per_bin: int = PER_BIN) -> DataFrame:
    """How often each record is used: ``(doc_id, source, n_tokens, copies)``, for records used at least once.

    ``sizes (doc_id, source, n_tokens)`` with unique doc_id, ``targets (source, target_share, max_repeats)``. Inclusion of the
    drawn copy is in proportion to ``weight``, a column of ``sizes`` (null or negative as 0: only whole copies), a chance
    of 1 at most; with None all records of a source have the same chance. Records without tokens and
    records of sources without a target are not used.
    """
    columns = ["doc_id", "source", F.col("n_tokens").cast("bigint").alias("n_tokens")]
    by_source = plan(sizes, targets, total)
    rows = by_source.select("source", "copies", "fraction", "rest", "n_docs").collect()  # one per target, of checked number
    spark = sizes.sparkSession
    small = spark.createDataFrame([tuple(r) for r in rows], "source string, whole int, fraction double, rest double, n_docs bigint")
    weighed = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)
    docs = sizes.where("n_tokens > 0").select(*columns, weighed.alias("w")).join(F.broadcast(small), "source")
    docs = docs.withColumn("w", F.when(F.col("n_tokens") <= F.col("rest"), F.col("w")).otherwise(0.0))  # larger than all that is drawn: only whole copies
    factors = spark.createDataFrame(list(_factors(docs).items()), "source string, k double")
    docs = docs.join(F.broadcast(factors), "source", "left").withColumn("p", F.when((F.col("fraction") > 0) & (F.col("w") > 0), F.least(F.coalesce(F.col("k") * F.col("w"), F.lit(0.0)), F.lit(1.0))).otherwise(0.0))
    # a stratum holds sizes from a power of LEVEL to the next
    docs = docs.withColumn("level", F.floor(F.log("n_tokens") / math.log(LEVEL) + 1e-9).cast("int"))
    docs = docs.withColumn("rank", F.when(F.col("p") >= 1, float("-inf")).when(F.col("p") > 0, _logit(uniform(F.col("doc_id"), seed)) - _logit(F.col("p"))))
    drawn = materialise(docs.where("rank is not null").select("doc_id", "source", "level", "n_tokens", "p", "rank", "fraction"), "drawn")
    cuts = _cuts(drawn, per_bin)
    last = spark.createDataFrame(cuts, "source string, level int, last double, last_id bigint")
    within = (F.col("rank") < F.col("last")) | ((F.col("rank") == F.col("last")) & (F.col("doc_id") <= F.col("last_id")))
    taken = docs.join(F.broadcast(last), ["source", "level"], "left").withColumn("extra", F.coalesce(within.cast("int"), F.lit(0)))
    return taken.select("doc_id", "source", "n_tokens", (F.col("whole") + F.col("extra")).cast("int").alias("copies")).where("copies > 0")


def _cuts(drawn: DataFrame, per_bin: int) -> list[tuple]:
    """``(source, level, rank, doc_id)`` of the last record that each stratum of ``drawn`` takes; strata that take none are left out.

    A stratum's rows stay where they are: sums per bin of the ranks show the bin with the cut, and that bin alone is ordered.
    Only one row per source and level reaches the driver.
    """
    strata = drawn.groupBy("source", "level").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p") * F.col("n_tokens")).alias("wanted"), F.sum("n_tokens").alias("all"), F.max("fraction").alias("fraction")).collect()
    spark, carry, out = drawn.sparkSession, {}, []
    for level in sorted({r["level"] for r in strata}, reverse=True):
        here = [(r["source"], r["wanted"] + carry.get(r["source"], 0.0), sum(x["wanted"] for x in strata if x["source"] == r["source"] and x["level"] < level) or float("inf"), min(max(r["n"] // per_bin, 1), MOST_BINS), r["fraction"]) for r in strata if r["level"] == level]
        small = spark.createDataFrame(here, "source string, room double, spare double, bins bigint, mean double")
        rows = drawn.where(F.col("level") == level).select("doc_id", "source", "n_tokens", "rank").join(F.broadcast(small), "source")
        # the mean chance recentres the ranks; for equal chances the bin is the random number itself
        place = 1 / (1 + F.exp(-(F.col("rank") + _logit(F.least(F.col("mean"), F.lit(1 - 1e-9))))))
        rows = rows.withColumn("bin", F.least((place * F.col("bins")).cast("bigint"), F.col("bins") - 1))
        before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.groupBy("source", "bin", "room").agg(F.sum("n_tokens").alias("size")).withColumn("below", F.coalesce(F.sum("size").over(before), F.lit(0)))
        # the last bin that begins below the size; the records before it are all taken
        at = sums.where("below <= room or below = 0").groupBy("source").agg(F.max_by(F.struct("bin", "below"), "bin").alias("c")).select("source", F.col("c.bin").alias("cut"), F.col("c.below").alias("below"))
        near = rows.join(F.broadcast(at), "source").where("bin between cut - 1 and cut")
        inside = Window.partitionBy("source", "bin").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
        so_far = F.when(F.col("bin") == F.col("cut"), F.col("below") + F.sum("n_tokens").over(inside)).otherwise(F.col("below"))
        # the record that crosses: if it comes nearer, and smaller strata can make good for it
        takes = (F.col("so_far") - F.col("n_tokens") / 2 <= F.col("room")) & (F.col("so_far") <= F.col("room") + F.col("spare"))
        near = near.withColumn("so_far", so_far).where((F.col("bin") < F.col("cut")) | takes)
        found = near.groupBy("source").agg(F.max_by(F.struct("rank", "doc_id", "so_far"), F.struct("rank", "doc_id")).alias("l")).select("source", "l.*").collect()
        taken = {r["source"]: r["so_far"] for r in found}
        out += [(r["source"], level, float(r["rank"]), r["doc_id"]) for r in found]
        for source, room, *_ in here:
            carry[source] = room - taken.get(source, 0)
    return out


def mix_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: what it asked for and what it got: records, tokens, share of all tokens, most copies of a record."""
    got = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    rows = targets.select("source", "target_share", "max_repeats").join(F.broadcast(got), "source", "left").fillna(0, ["n_docs", "n_tokens", "most_copies"])
    return rows.withColumn("actual_share", F.round(F.try_divide(F.col("n_tokens"), F.sum("n_tokens").over(Window.partitionBy())), 6))
