"""Quality rules under weak supervision: rules vote or abstain, EM weighs their votes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch
from adstream.llm.text import SPACES, WORD_CHARACTER, whole, words

# The symbols and the limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the languages expected, as signs of running text.
FUNCTION_WORDS = (
    "the of and to in is that for it with as was on are be this from or by "
    "der die und das den von zu mit ist des im auf nicht ein eine "
    "le la les de des un une et que pour dans qui sur est "
    "el los las del y en por con una para como se su"
).split()

_EM_STEPS = 25
_GOOD, _BAD = 1, -1
_VOTES = (_GOOD, 0, _BAD)


def text_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds the counts that rules look at; the text is split into words once."""
    text = whole(F.col(text_col))
    size = F.size("_words")
    windows = F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.struct(
            F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("at")
        ),
    )
    # After sorting, a window found twice or more lies beside an equal one.
    repeated = F.filter(
        F.col("_windows"),
        lambda w, i: (w["h"] == F.get("_windows", i + 1)["h"])
        | ((i > 0) & (w["h"] == F.get("_windows", F.greatest(i - 1, F.lit(0)))["h"])),
    )
    starts = F.array_sort(F.transform(repeated, lambda w: w["at"]))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda s, at: F.struct(
            at.alias("last"), (s["total"] + F.least(F.lit(3), at - s["last"])).cast("long").alias("total")
        ),
    )["total"]
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD_CHARACTER))
    in_words = F.translate(text, SPACES, "")
    return (
        docs.withColumn("_words", words(F.col(text_col)))
        .withColumn("_windows", F.when(size >= 3, F.array_sort(windows)).otherwise(F.slice(windows_empty(), 1, 0)))
        .withColumn("_starts", starts)
        .withColumn("_lines", lines)
        .withColumns(
            {
                "n_words": size.cast("long"),
                "word_chars": F.length(in_words).cast("long"),
                "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": covered,
                "n_letters": F.length(F.regexp_replace(in_words, r"\P{L}+", "")).cast("long"),
                "n_capitals": F.length(F.regexp_replace(in_words, r"\P{Lu}+", "")).cast("long"),
                "n_marks": (F.length(text) - F.length(F.translate(text, "!?", ""))).cast("long"),
                "n_function_words": F.size(
                    F.array_intersect(F.split(F.lower(text), r"[^\p{L}]+"), F.array(*map(F.lit, FUNCTION_WORDS)))
                ).cast("long"),
            }
        )
        .drop("_words", "_windows", "_starts", "_lines")
    )


def windows_empty() -> Column:
    """An array of window structs, to be cut to nothing for very short texts."""
    return F.array(F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("at")))


def rule_votes() -> dict[str, Column]:
    """Each rule votes good (1) or bad (-1) where it is sure, and else abstains (0)."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, _BAD).when(good, _GOOD).otherwise(0)

    symbols, letters = F.col("n_symbols") / n, F.col("n_letters") / chars
    mean, repeats = F.col("word_chars") / n, F.col("n_repeat_words") / n
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    capitals = F.col("n_capitals") / F.greatest(F.col("n_letters"), F.lit(1))
    marks = F.col("n_marks") / n
    return {
        "symbols": vote(symbols <= 0.02, symbols > 0.1),
        "letters": vote(letters >= 0.9, letters < 0.75),
        "word_length": vote((mean >= 3) & (mean <= 12), (mean < 2) | (mean > 20)),
        "repeats": vote(repeats <= 0.1, repeats > 0.3),
        "lines": vote((lines == 0) & (F.col("n_lines") > 1), lines > 0.3),
        "capitals": vote(capitals <= 0.2, capitals > 0.5),
        "marks": vote(marks <= 0.02, marks > 0.15),
        "function_words": vote(F.col("n_function_words") >= 3, F.col("n_function_words") == 0),
    }


@dataclass(frozen=True)
class VoteModel:
    """The share of good documents, and for either class how a rule votes on it."""

    prior: float
    good: dict[str, dict[int, float]]
    bad: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """Probability of "good" given the vote columns."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, on_good in self.good.items():
            weight = {v: math.log(on_good[v] / self.bad[rule][v]) for v in _VOTES}
            vote = F.col(rule)
            odds = odds + F.when(vote == _GOOD, weight[_GOOD]).when(vote == _BAD, weight[_BAD]).otherwise(weight[0])
        return 1 / (1 + F.exp(-odds))


def weigh_votes(patterns: DataFrame, rules: list[str], scratch: Scratch) -> VoteModel:
    """Each rule's accuracy on either class, by expectation-maximisation.

    ``patterns`` has one row for every combination of votes that occurs, at most 3 to
    the number of rules however many documents there are, with its count ``n``. An E-step gives
    each combination its posterior; the M-step is one aggregate over them. On good
    documents a rule is held to be right more often than on bad ones it is wrong,
    which ties the hidden classes to their names.
    """
    table = scratch.save(patterns.coalesce(1), "patterns")
    good = {r: {_GOOD: 0.8, 0: 0.18, _BAD: 0.02} for r in rules}
    bad = {r: {_GOOD: 0.5, 0: 0.2, _BAD: 0.3} for r in rules}
    model = VoteModel(0.8, good, bad)
    for _ in range(_EM_STEPS):
        # The posterior is a column of its own, or each of the sums would hold a copy of it.
        weighed = table.select(*rules, F.col("n").cast("double").alias("n"), model.posterior().alias("p"))
        n, p = F.col("n"), F.col("p")
        sums = [F.sum(n).alias("all"), F.sum(n * p).alias("good")]
        for r in rules:
            for v in _VOTES:
                cast = F.col(r) == v
                sums.append(F.sum(F.when(cast, n)).alias(f"all_{r}_{v}"))
                sums.append(F.sum(F.when(cast, n * p)).alias(f"good_{r}_{v}"))
        row = weighed.agg(*sums).first()
        if not row["all"]:
            break
        n_good, n_bad = row["good"], row["all"] - row["good"]
        good, bad = {}, {}
        for r in rules:
            on_good = {v: ((row[f"good_{r}_{v}"] or 0) + model.good[r][v]) / (n_good + 1) for v in _VOTES}
            on_bad = {
                v: ((row[f"all_{r}_{v}"] or 0) - (row[f"good_{r}_{v}"] or 0) + model.bad[r][v]) / (n_bad + 1)
                for v in _VOTES
            }
            good[r] = _tied(on_good, _BAD, 0.05)
            bad[r] = _tied(on_bad, _GOOD, on_good[_GOOD])
            bad[r][_BAD] = max(bad[r][_BAD], 2 * good[r][_BAD])
        following = VoteModel(min(max(n_good / row["all"], 0.05), 0.95), good, bad)
        change = abs(following.prior - model.prior)
        model = following
        if change < 1e-5:
            break
    return model


def _tied(rates: dict[int, float], vote: int, most: float) -> dict[int, float]:
    """Rates of votes with that of ``vote`` held to ``most``, and none at zero."""
    return {v: min(max(x, 1e-4), most if v == vote else 1.0) for v, x in rates.items()}


def assess_quality(
    docs: DataFrame, text_col: str = "text", threshold: float = 0.5, columns: list[str] | None = None
) -> DataFrame:
    """Adds the counts, ``base_failed``, ``quality`` (posterior) and ``kept`` to every row.

    ``columns`` names the columns of ``docs`` that the result needs, by default all.

    ``kept`` is false for a text that fails the base rules (under 50 words, or over
    half of its words in repeated three-word windows) and for one whose posterior is
    below the threshold. A NULL or empty text has counts of zero and fails the base
    rules. Repeated rows are judged each, and alike. The columns of ``docs`` stay,
    whatever their names, unless they have a name of the new columns, which they then
    give up. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rules = rule_votes()
    columns = docs.columns if columns is None else columns
    own = docs.select(F.struct(*columns).alias("row"), F.col(text_col).cast("string").alias("body"))
    counted = text_statistics(own, "body")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    voted = counted.select("row", *counts, base_failed.alias("base_failed"), *[v.alias(r) for r, v in rules.items()])
    voted = scratch.save(voted, "votes")
    patterns = voted.filter("NOT base_failed").groupBy(*rules).agg(F.count("*").alias("n"))
    model = weigh_votes(patterns, list(rules), scratch)
    new = [*counts, "base_failed", "quality", "kept"]
    kept = ~F.col("base_failed") & (F.col("quality") >= threshold)
    judged = voted.withColumn("quality", model.posterior()).withColumn("kept", kept)
    return judged.select(*[F.col("row")[c].alias(c) for c in columns if c not in new], *new)
