"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed per cell (source, language, topic). Each round scales the cells to the target share
of every source, then language, then topic. The ratio of a cell's fitted weight to its tokens, scaled and
capped at 1, is the probability with which its documents stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import removed, saved
from quarry.llm.tables import whole

MARGINS = ("source", "lang", "topic")
ROUNDS = 8
CAP_ROUNDS = 6
POWER = 0.5
RATE = 0.5
SEED = "mix"
NOISE = ("###", "&&&", "$$$", "%%%", "***", "!!")


def tokens_of(text: Column) -> Column:
    """Words separated by white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic by the form of the text; any other column may take its place."""
    noisy = F.lit(False)
    for mark in NOISE:
        noisy = noisy | F.contains(text, F.lit(mark))
    return (
        F.when(F.contains(text, F.lit(" | ")), "table").when(noisy, "noise").when(tokens < 100, "note").when(tokens >= 1000, "long").otherwise("prose")
    )


def chance(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the key alone: 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def aim_of(sums: DataFrame, margin: str, power: float, target: DataFrame | None) -> DataFrame:
    """(margin, aim): the tokens that each value shall have. Targets (value, share) are normalised over the values present."""
    if target is None:
        return sums.select(margin, "have", F.pow("have", F.lit(power)).alias("share"))
    given = target.groupBy(F.col("value").alias(margin)).agg(F.sum("share").cast("double").alias("share"))
    return sums.join(given, margin, "left").select(margin, "have", F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0)).alias("share"))


def margin_errors(fit: DataFrame, aims: dict[str, DataFrame]) -> DataFrame:
    """(margin, value, aim, now, error): how far each value of a margin is from its aim, as a part of the whole."""
    rows = None
    for m, aim in aims.items():
        part = fit.groupBy(m).agg(F.sum("weight").alias("now")).join(aim, m)
        part = part.select(F.lit(m).alias("margin"), F.col(m).alias("value"), "aim", "now", F.abs(F.col("aim") - F.col("now")).alias("error"))
        rows = part if rows is None else rows.unionByName(part)
    whole_of = rows.groupBy("margin").agg(F.sum("aim").alias("all"))
    return rows.join(whole_of, "margin").select("margin", "value", "aim", "now", F.coalesce(F.try_divide("error", "all"), F.lit(0.0)).alias("error"))


def fitted(
    cells: DataFrame, margins=MARGINS, rounds: int = ROUNDS, power: float = POWER, targets: dict[str, DataFrame] | None = None, tolerance: float | None = None
) -> DataFrame:
    """Cells with a column `ratio`. Target shares are those given per margin, else tokens to the power, normalised.

    targets: by margin, (value, share). Values without a share, or with a null or negative one, get none, so their
    documents go; shares of values that the corpus lacks go to the others in proportion; repeated values add up.
    With a tolerance, rounds end once no value of any margin is farther from its aim than that part of all tokens.
    Sums per margin value are partial aggregates, so a source with a third of all rows costs no more than another.
    """
    total = F.sum("tokens").cast("double")
    aims = {}
    for m in margins:
        sums = cells.groupBy(m).agg(total.alias("have"))
        shares = aim_of(sums, m, power, (targets or {}).get(m))
        n, everything = shares.agg(F.sum("share").alias("norm"), F.sum("have").alias("all")).first() or (None, None)
        if everything and not n:
            raise ValueError(f"no value of {m} in the corpus has a share of its target")
        aims[m] = saved(shares.select(m, (F.col("share") / F.lit(n or 1.0) * F.lit(everything or 0.0)).alias("aim")), f"aim-{m}")
    first = fit = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for m in margins:
            scale = fit.groupBy(m).agg(F.sum("weight").alias("now")).join(aims[m], m).select(m, F.try_divide("aim", "now").alias("scale"))
            # kept after every margin: the weights are read twice in the next one, and plans must not double each time
            new = saved(fit.join(scale, m).withColumn("weight", F.col("weight") * F.coalesce("scale", F.lit(1.0))).drop("scale"), "fit")
            if fit is not first:
                removed(fit)
            fit = new
        if tolerance is not None and (margin_errors(fit, aims).agg(F.max("error")).first()[0] or 0.0) <= tolerance:
            break
    return fit.withColumn("ratio", F.coalesce(F.try_divide("weight", F.col("tokens").cast("double")), F.lit(0.0)))


def calibrated(fit: DataFrame, rate: float = RATE, rounds: int = CAP_ROUNDS) -> DataFrame:
    """Cells with `probability`: the ratio times a common factor, at most 1, so that the rate of tokens stays."""
    goal = (fit.agg(F.sum("tokens")).first()[0] or 0) * rate
    factor = rate
    for _ in range(rounds):
        capped = F.col("ratio") * F.lit(factor) >= 1
        full, rest = fit.agg(
            F.coalesce(F.sum(F.when(capped, F.col("tokens").cast("double"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if rest <= 0 or goal <= full:
            break
        factor = max(factor, (goal - full) / rest)
    return fit.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * F.lit(factor)))


def mixed(docs: DataFrame, rate: float = RATE, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, tolerance: float | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, tokens, weight, probability, kept.

    Null source or language counts as the empty name; null or empty text has no tokens, belongs to the topic
    of short notes and takes its cell's probability. Rows with one doc_id share their fate. An empty table
    gives an empty result. Only doc_id, text, source and lang are read.
    targets, rounds and tolerance are those of `fitted`.
    """
    text = whole("text")
    rows = docs.select("doc_id", whole("source").alias("source"), whole("lang").alias("lang"), tokens_of(text).alias("tokens"), text.alias("body"))
    rows = rows.select("doc_id", "source", "lang", topic_of(F.col("body"), F.col("tokens")).alias("topic"), "tokens")
    rows = saved(rows, "tokens")
    cells = saved(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    odds = calibrated(fitted(cells, rounds=rounds, targets=targets, tolerance=tolerance), rate).select(*MARGINS, "ratio", "probability")
    return rows.join(odds, list(MARGINS)).select(
        "doc_id",
        *MARGINS,
        "tokens",
        F.round("ratio", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        (chance(F.col("doc_id")) < F.col("probability")).alias("kept"),
    )
