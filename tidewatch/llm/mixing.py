"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm.common import broadcast_if_small, table, unit_hash

# Counts beyond this have a chance below 1e-12 for every rate of one draw; larger rates are
# sums of several draws.
_MOST_COPIES, _MOST_RATE = 128, 50.0
_CHUNK = 4096  # copies that one array lists


def poisson_steps(rate: Column, most: int = _MOST_COPIES) -> Column:
    """The values of the Poisson distribution function at 0, 1, ... that a hash can reach.

    Summed in doubles in that order; a rate of NULL or 0 has the single step 1.
    """
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("steps"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        total = F.element_at(state["steps"], -1) + term
        return F.struct(
            term.alias("term"), F.concat(state["steps"], F.array(total)).alias("steps")
        )

    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(most - 1)), start, step, lambda state: state["steps"]
    )
    reachable = F.filter(grown, lambda total: total < F.lit(1.0 - 2.0**-48))
    return F.when(rate > 0, reachable).otherwise(F.array(F.lit(1.0)))


def poisson_count(steps: Column, uniform: Column) -> Column:
    """The smallest k whose distribution function exceeds ``uniform``."""
    return F.size(F.filter(steps, lambda total: total <= uniform))


def poisson_draws(rate: Column) -> Column:
    """How many draws of at most 50 each make up a rate; 1 for a rate of NULL or 0."""
    return F.greatest(F.ceil(rate / F.lit(_MOST_RATE)), F.lit(1).cast("long"))


def poisson_total(steps: Column, draws: Column, name: Column, key: Column) -> Column:
    """The sum of ``draws`` counts at independent uniform numbers of (name, key, draw).

    Sums of independent Poisson counts are Poisson counts of the summed rate, so this is
    exact for every rate. The first draw's number is of (name, key) alone.
    """
    first = poisson_count(steps, unit_hash(name, key)).cast("long")
    more = F.aggregate(
        F.sequence(F.lit(1).cast("long"), draws - 1), first,
        lambda sum_, draw: sum_ + poisson_count(steps, unit_hash(name, key, draw)))
    return F.when(draws > 1, more).otherwise(first)


def source_rates(
    docs: DataFrame, weights: DataFrame, total: float | None, *, source: str, weight: str,
    size: Column | None = None, most_rate: float | None = _MOST_RATE,
) -> DataFrame:
    """(source, rate): mean repetitions of a source's documents that meet the target weights.

    A source's target is its share of ``weight`` times ``total`` (all sizes, if not given);
    its rate is target / size. Sources without a positive weight get rate 0; weighted sources
    that hold nothing are left out, and their weight with them. Rates above ``most_rate`` are
    refused; with None, as ``mix_sources`` asks, no rate is.
    """
    size = F.lit(1) if size is None else F.coalesce(size, F.lit(0))
    held = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size.cast("double")).alias("held"))
    known = weights.filter(F.col(weight) > 0).groupBy(F.col(source).alias("_source")).agg(
        F.sum(F.col(weight).cast("double")).alias("weight")
    )
    joined = held.join(known, F.col("source").eqNullSafe(F.col("_source")), "left")
    sums = joined.agg(
        F.sum("held").alias("all"), F.sum(F.when(F.col("held") > 0, F.col("weight"))).alias("w"),
        F.max(F.col("weight") / F.col("held")).alias("most"),
    ).first()
    aim = float(total if total is not None else sums["all"] or 0.0)
    whole = float(sums["w"] or 1.0)
    if most_rate is not None and (sums["most"] or 0.0) / whole * aim > most_rate:
        raise ValueError(f"a source would be repeated more than {most_rate:g} times on average")
    rate = F.when(F.col("held") > 0, F.col("weight") / F.lit(whole) * F.lit(aim) / F.col("held"))
    return joined.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix_sources(
    docs: DataFrame, weights: DataFrame, *, key: str = "doc_id", source: str = "source",
    weight: str = "weight", size: Column | None = None, total: float | None = None, seed: int = 0,
) -> DataFrame:
    """Documents repeated to meet target weights: columns of ``docs``, then ``copy`` and ``place``.

    A document's number of copies inverts a Poisson distribution, whose mean is its source's
    rate, at a uniform number made of (seed, key); the same document gets the same count in
    every run. A rate above 50 is cut into equal parts of at most 50, one number each, whose
    counts add up, so no rate is refused. Each copy has a ``place``, another uniform number
    of (seed, key, copy); the result is globally in that order, which is the one exchange
    that moves texts. A NULL source is a source of its own; NULL keys share one number;
    repeated rows are counted row by row, with equal results. Existing columns of the two
    names are replaced.
    """
    rates = source_rates(
        docs, weights, total, source=source, weight=weight, size=size, most_rate=None)
    kept = [name for name in docs.columns if name not in ("copy", "place")]
    # Numbered columns rather than one struct, whose pruning fails below two explodes in a row.
    own = [f"_{number}" for number in range(len(kept))]
    rows = docs.select(
        *[docs[f"`{name}`"].alias(number) for name, number in zip(kept, own)],
        F.col(source).alias("_source"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
    )
    draws = poisson_draws(F.col("rate"))
    stepped = rates.select(
        "source", draws.alias("draws"), poisson_steps(F.col("rate") / draws).alias("steps"))
    rated = rows.join(
        broadcast_if_small(stepped, rates.count()), F.col("_source").eqNullSafe(F.col("source"))
    )
    counted = rated.withColumn(
        "n", poisson_total(F.col("steps"), F.col("draws"), F.lit(f"count{seed}"), F.col("_key"))
    ).filter(F.col("n") > 0)
    # In chunks, so that no array grows with the rate.
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_CHUNK).cast("long"))
    chunks = counted.select(*own, "_key", "n", F.explode(starts).alias("start"))
    last = F.least(F.col("n"), F.col("start") + _CHUNK) - 1
    copies = chunks.select(
        *own, "_key", F.explode(F.sequence(F.col("start"), last)).alias("copy")
    ).withColumn("place", unit_hash(F.lit(f"place{seed}"), F.col("_key"), F.col("copy")))
    return copies.orderBy("place", "_key", "copy").select(
        *[F.col(number).alias(name) for name, number in zip(kept, own)], "copy", "place"
    )


def example_weights(docs: DataFrame) -> DataFrame:
    """Target weights of the query: each source by the square root of its documents.

    Large sources are flattened, as is usual for training mixtures.
    """
    return docs.groupBy("source").agg(F.sqrt(F.count(F.lit(1))).alias("weight"))


SEED = 7


def op4_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents the mixture holds, how often, and in which global order."""
    docs = table(spark, folder, "documents")
    mixed = mix_sources(docs.select("doc_id", "source"), example_weights(docs), seed=SEED)
    return mixed.select("doc_id", "source", F.col("copy").cast("int").alias("copy"), "place")


def _uniform(*parts: str) -> str:
    text = " || '|' || ".join(f"CAST({part} AS VARCHAR)" for part in parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 12)) AS BIGINT) / {float(2**48)!r}"


# Counts that the SQL lists: beyond them lies less than 2^-48 of any rate up to 50.
_LEVELS = 160

OP4_SQL = f"""
WITH held AS (SELECT source, CAST(count(*) AS DOUBLE) AS held FROM documents GROUP BY source),
     rates AS (
       SELECT source,
              sqrt(held) / (SELECT sum(sqrt(held)) FROM held) * (SELECT sum(held) FROM held) / held
                AS rate
       FROM held),
     terms AS (
       SELECT source, k,
              exp(-rate + k * ln(rate) - lgamma(k + 1)) AS term
       FROM rates, range({_LEVELS}) t(k)),
     steps AS (
       SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms),
     counted AS (
       SELECT doc_id, source,
              (SELECT count(*) FROM steps s
               WHERE s.source IS NOT DISTINCT FROM d.source
                 AND s.upto <= {_uniform(f"'count{SEED}'", "coalesce(CAST(doc_id AS VARCHAR), '')")})
                AS n
       FROM documents d)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy,
       {_uniform(f"'place{SEED}'", "coalesce(CAST(doc_id AS VARCHAR), '')", "copy")} AS place
FROM (SELECT doc_id, source, unnest(range(n)) AS copy FROM counted)
"""
