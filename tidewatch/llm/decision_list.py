"""Quality rules: an ordered list of threshold conjunctions learned by sequential covering."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm.common import SPACES, table, words_of
from tidewatch.sources.work import WorkTables

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
_WINDOW = 3


def text_statistics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and n_upper (ASCII capitals), over whole texts; NULL text counts as empty.

    Existing columns of these names are replaced.
    """
    plain = F.coalesce(F.col(text), F.lit(""))

    def count_of(characters: str) -> Column:
        return (F.char_length(plain) - F.char_length(F.translate(plain, characters, ""))).cast("long")

    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    lines = F.filter(
        F.split(plain, "\n"), lambda line: F.translate(line, SPACES, "") != ""
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]
    kept = [docs[f"`{name}`"] for name in docs.columns if name not in names]
    return (
        docs.select(*kept, words_of(F.col(text)).alias("_words"), lines.alias("_lines"),
                    F.char_length(F.translate(plain, SPACES, "")).cast("long").alias("word_chars"),
                    count_of(SYMBOLS).alias("n_symbols"), count_of(capitals).alias("n_upper"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("n_dup_lines",
                    (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .transform(_with_repeats)
        .select(*[name for name in docs.columns if name not in names], *names)
    )


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside three-word windows that the text holds twice or more.

    Windows are hashed and sorted with their places, so that equal ones are neighbours; the
    places of repeated ones, in order, cover min(3, distance to the next) words each. All of
    it is linear or a sort within the row, whatever the text's length.
    """
    n = F.size("_words")
    words = F.col("_words")
    windows = F.when(n >= _WINDOW, F.transform(
        F.sequence(F.lit(0), n - _WINDOW),
        lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")),
    )).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    df = df.withColumn("_sorted", F.sort_array(windows))
    ordered = F.col("_sorted")
    last = F.size("_sorted") - 1
    repeated = F.filter(ordered, lambda w, k: (
        F.when(k > 0, F.get(ordered, k - 1)["h"] == w["h"]).otherwise(False)
        | F.when(k < last, F.get(ordered, k + 1)["h"] == w["h"]).otherwise(False)))
    df = df.withColumn("_at", F.sort_array(F.transform(repeated, lambda w: w["i"])))
    at = F.col("_at")
    covered = F.aggregate(
        at, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-_WINDOW).alias("last")),
        lambda s, i: F.struct(
            (s["sum"] + F.least(F.lit(_WINDOW), i - s["last"])).alias("sum"), i.alias("last")),
        lambda s: s["sum"],
    )
    return df.withColumn("n_repeat_words", covered)


# The rates that rules may test, all from the statistics above.
def text_rates() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / words,
        "repeat_rate": F.col("n_repeat_words") / words,
        "dup_line_rate": F.col("n_dup_lines") / words,
        "upper_rate": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    """``rate <= bound`` or ``rate > bound``."""

    rate: str
    above: bool
    bound: float

    def column(self) -> Column:
        rate = F.col(self.rate)
        return rate > self.bound if self.above else rate <= self.bound


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects; right and wrong rejections among the pruning rows."""

    conditions: tuple[Condition, ...]
    right: int
    wrong: int

    def column(self) -> Column:
        return _all_of(self.conditions)


def _all_of(conditions: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition.column()
    return out


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list as one ordered conditional expression: the first rule that holds rejects."""
    kept = None
    for rule in rules:
        kept = F.when(rule.column(), False) if kept is None else kept.when(rule.column(), False)
    return F.lit(True) if kept is None else kept.otherwise(True)


def rule_number(rules: Sequence[Rule]) -> Column:
    """Number of the rule that rejects a row, from 1; 0 for rows kept."""
    number = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, start=1))):
        number = F.when(rule.column(), i).otherwise(number)
    return number


def learn_rules(
    labelled: DataFrame, rates: Sequence[str], *, label: str = "bad", prune: Column,
    bins: int = 32, most_rules: int = 12, most_conditions: int = 3, least_precision: float = 0.9,
    least_covered: int = 5,
) -> list[Rule]:
    """Sequential covering over a written table of ``rates`` and a boolean ``label`` (true: reject).

    Each rule grows on the rows where ``prune`` is false: the threshold of the largest
    information gain is added until no wrong row is covered. It is cut back to the prefix
    of the best (right - wrong) / (right + wrong) on the other rows, and kept if it is right
    there often enough; rows it covers leave both sets. Every step is one aggregation over
    all labelled rows, of which the driver sees (rates x bins) sums. Thresholds are
    ``bins`` quantiles of each rate among the rows to reject and among all. Rows without
    a label are left out; no rows, or rows of one label, give no rules.
    """
    rows = labelled.filter(F.col(label).isNotNull()).withColumn("_prune", prune)
    shares = [i / bins for i in range(bins)]
    found = rows.agg(*[
        F.concat(F.percentile_approx(rate, shares, 2000),
                 F.percentile_approx(F.when(F.col(label), F.col(rate)), shares, 2000)).alias(rate)
        for rate in rates
    ]).first()
    bounds = {rate: sorted(set(found[rate] or [])) for rate in rates}
    rules: list[Rule] = []
    while len(rules) < most_rules:
        open_rows = rows.filter(verdict(rules))
        conditions = _grow(open_rows.filter(~F.col("_prune")), bounds, label, most_conditions)
        if not conditions:
            break
        rule = _prune(open_rows.filter("_prune"), conditions, label)
        if rule.right < least_covered or rule.right < least_precision * (rule.right + rule.wrong):
            break
        rules.append(rule)
    return rules


def _bin(rate: str, bounds: list[float]) -> Column:
    """Number of bounds that lie below the rate."""
    below = F.lit(0)
    for bound in bounds:
        below = below + (F.col(rate) > bound).cast("int")
    return below


def _grow(rows: DataFrame, bounds: dict[str, list[float]], label: str, most: int) -> list[Condition]:
    conditions: list[Condition] = []
    binned = [
        F.struct(F.lit(rate).alias("rate"), _bin(rate, edges).alias("bin"))
        for rate, edges in bounds.items() if edges
    ]
    if not binned:
        return []
    while len(conditions) < most:
        sums = (
            rows.filter(_all_of(conditions))
            .select(F.col(label).cast("int").alias("y"), F.explode(F.array(*binned)).alias("b"))
            .groupBy("b.rate", "b.bin").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
            .collect()
        )
        counts = {(row["rate"], row["bin"]): (row["p"], row["n"] - row["p"]) for row in sums}
        best, gain = None, 1e-9
        for rate, edges in bounds.items():
            own = [counts.get((rate, i), (0, 0)) for i in range(len(edges) + 1)]
            all_p, all_n = sum(p for p, _ in own), sum(n for _, n in own)
            if all_n == 0 or all_p == 0:
                continue
            low_p = low_n = 0
            for (p, n), bound in zip(own, edges):
                low_p, low_n = low_p + p, low_n + n
                for above, right, wrong in ((False, low_p, low_n),
                                            (True, all_p - low_p, all_n - low_n)):
                    better = _gain(right, wrong, all_p, all_n)
                    # Among equals the narrower condition: the higher bound of "above".
                    if better > gain or (above and best and better == gain):
                        best, gain = Condition(rate, above, bound), better
        if best is None:
            break
        conditions.append(best)
    return conditions


def _gain(p: int, n: int, all_p: int, all_n: int) -> float:
    """FOIL's information gain of narrowing (all_p, all_n) rows to (p, n)."""
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))


def _prune(rows: DataFrame, conditions: list[Condition], label: str) -> Rule:
    prefixes = [conditions[:i] for i in range(1, len(conditions) + 1)]
    sums = rows.agg(*[
        F.count_if(_all_of(prefix) & (F.col(label) == F.lit(side))).alias(f"s{i}_{int(side)}")
        for i, prefix in enumerate(prefixes) for side in (True, False)
    ]).first()
    scored = [(sums[f"s{i}_1"], sums[f"s{i}_0"]) for i in range(len(prefixes))]
    best = max(range(len(prefixes)), key=lambda i: (
        (scored[i][0] - scored[i][1]) / max(1, sum(scored[i])), -i))
    return Rule(tuple(prefixes[best]), *scored[best])


LEAST_WORDS, MOST_REPEATS = 50, 50


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))


def document_rules(stats: DataFrame, labels: DataFrame, tables: WorkTables) -> list[Rule]:
    """Rules from labelled documents that pass the base checks; a third of the ids prunes."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 0).alias("bad"))
    rates = text_rates()
    labelled = tables.write(
        stats.filter(~base_failed()).join(known, F.col("doc_id") == F.col("_id")).select(
            *[column.alias(name) for name, column in rates.items()], "bad",
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")),
        "labelled-rates",
    )
    return learn_rules(labelled, list(rates), prune=F.col("prune"))


def op8_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document."""
    tables = WorkTables(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = tables.write(text_statistics(docs).drop("text"), "statistics")
    rules = document_rules(stats, table(spark, folder, "labels"), tables)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rated = stats.select(
        *[F.col(name).alias(f"_{name}") for name in names], base_failed().alias("base_failed"),
        *[column.alias(name) for name, column in text_rates().items()])
    return rated.select(
        *[F.col(f"_{name}").alias(name) for name in names], "base_failed",
        (~F.col("base_failed") & verdict(rules)).alias("kept"),
        F.when(F.col("base_failed"), -1).otherwise(rule_number(rules)).alias("rule"),
    )
