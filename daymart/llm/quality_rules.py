"""Quality rules as weak supervision, in built-in functions only.

Each rule looks at one property of a text and votes: good (1), bad (-1), or abstains (0).
Expectation-maximisation over how often each combination of votes occurs estimates, without any label,
how reliable every rule is; a text is kept if the posterior probability of being good
reaches ``min_posterior``.  A few hard limits (``base_failed``) come before the votes.

The texts are measured once and the measures written to the shared folder.  From them come the counts of vote
combinations (at most ``3 ** rules`` rows, whatever the corpus) and, by a closed expression, every row's
verdict.  Nothing is shuffled but the counts.

Defined results: a NULL or blank text has no words and fails the base; repeated rows are judged alike, each
for itself; an empty table gives an empty result; columns other than the text are neither read nor touched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import fresh, written

WORD_GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule -> (measure, good when, bad when); between the two it abstains.
RULES: dict[str, tuple[str, str, str]] = {
    "symbols": ("n_symbols / n_words", "x <= 0.05", "x >= 0.2"),
    "repeated_lines": ("n_dup_lines / n_lines", "x <= 0.34 and n_lines > 1", "x >= 0.5"),
    "repeated_words": ("n_repeat_words / n_words", "x <= 0.1", "x >= 0.3"),
    "capitals": ("n_capitals / n_letters", "x <= 0.15", "x >= 0.5"),
    "letters": ("n_letters / word_chars", "x >= 0.88", "x <= 0.68"),
    "word_length": ("word_chars / n_words", "x between 3.5 and 7.0", "x < 2.0 or x > 15.0"),
    "variety": ("n_distinct_words / n_words", "x >= 0.55", "x <= 0.25"),
}


@dataclass(frozen=True)
class Reliability:
    """``prior``: share of good texts; per rule the log-odds that its good and its bad vote add."""

    prior: float
    when_good: dict[str, float]
    when_bad: dict[str, float]


def _repeated(words: Column) -> Column:
    """Words that lie in a window found twice or more in the text.

    Most texts repeat no window; that shows in the number of distinct digests.  Only the others are
    sorted by digest to find the places, from which the covered words are summed up.
    """
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    digests = F.transform(places, lambda p: F.xxhash64(*[F.get(words, p + k) for k in range(WINDOW)]))

    def covered(digests: Column) -> Column:
        in_order = F.sort_array(F.transform(digests, lambda d, p: F.struct(d.alias("d"), p.alias("p"))))
        return _with(in_order, twice)

    def twice(at: Column) -> Column:
        same = F.filter(
            at,
            lambda x, i: F.coalesce(F.get(at, i - 1)["d"] == x["d"], F.lit(False))
            | F.coalesce(F.get(at, i + 1)["d"] == x["d"], F.lit(False)),
        )
        return _with(F.sort_array(F.transform(same, lambda x: x["p"])), reach)

    def reach(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def found(digests: Column) -> Column:
        return F.when(F.size(F.array_distinct(digests)) == F.size(digests), F.lit(0)).otherwise(covered(digests))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(_with(digests, found))


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, although ``use`` mentions it more than once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))

    def of_parts(parts: Column) -> Column:
        words, lines, joined = parts["words"], parts["lines"], parts["joined"]
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
            F.length(F.regexp_replace(joined, "\\P{L}+", "")).cast("long").alias("n_letters"),
            F.length(F.regexp_replace(joined, "\\P{Lu}+", "")).cast("long").alias("n_capitals"),
        )

    parts = _with(words, lambda words: F.struct(words.alias("words"), lines.alias("lines"), F.array_join(words, "").alias("joined")))
    return _with(parts, of_parts)


def measured(docs: DataFrame, text: str = "text", into: str = "_measures", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with the struct of measures in column ``into``, written out.

    The one-element array keeps the optimiser from copying the long expression to every place that uses it.
    """
    kept = [F.col(f"`{name}`") for name in (docs.columns if keep is None else keep)]
    return written(docs.select(*kept, F.explode(F.array(measures(F.col(f"`{text}`")))).alias(into)))


def _vote(rule: str, into: str) -> Column:
    measure, good, bad = RULES[rule]
    for name in ("n_words", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_capitals", "n_letters", "word_chars", "n_distinct_words"):
        measure, good, bad = (part.replace(name, f"{into}.{name}") for part in (measure, good, bad))
    top, bottom = measure.split(" / ")
    share = f"({top} / nullif({bottom}, 0))"
    good, bad = (" ".join(share if word == "x" else word for word in part.split(" ")) for part in (good, bad))
    return F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end")


def base_failed(into: str = "_measures") -> Column:
    m = F.col(into)
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50, prior: float = 0.5, start: tuple[float, float] = (0.02, 0.4), weight: float = 20.0) -> Reliability:
    """Expectation-maximisation over (votes, count) rows.

    ``start`` is how often a rule that votes is taken to vote bad, on good and on bad texts: a defect is rare among good texts, and
    a bad text has some of the defects only, so that a good vote says little.  ``weight`` imagined votes keep each rule near it until
    enough real ones are seen.  Abstentions say nothing.
    """
    rules = list(RULES)
    classes = dict(zip((1, -1), start))
    bad = {y: [rate] * len(rules) for y, rate in classes.items()}
    total = sum(count for _, count in patterns)
    for _ in range(rounds if total else 0):
        size = {y: 0.0 for y in classes}
        seen = {y: [[weight * rate, weight] for _ in rules] for y, rate in classes.items()}
        for votes, count in patterns:
            log = {
                y: math.log(prior if y == 1 else 1 - prior)
                + sum(math.log(bad[y][j] if v < 0 else 1 - bad[y][j]) for j, v in enumerate(votes) if v)
                for y in classes
            }
            good = 1 / (1 + math.exp(min(700, log[-1] - log[1])))
            for y, share in ((1, good), (-1, 1 - good)):
                size[y] += count * share
                for j, v in enumerate(votes):
                    if v:
                        seen[y][j][0] += count * share * (v < 0)
                        seen[y][j][1] += count * share
        bad = {y: [n / of for n, of in seen[y]] for y in classes}
        prior = (size[1] + 1) / (total + 2)
    return Reliability(
        prior,
        {rule: math.log((1 - g) / (1 - b)) for rule, g, b in zip(rules, bad[1], bad[-1])},
        {rule: math.log(g / b) for rule, g, b in zip(rules, bad[1], bad[-1])},
    )


def fit(frame: DataFrame, into: str = "_measures") -> Reliability:
    """Learn the reliability of the rules from all texts of a measured frame that pass the base."""
    votes = [_vote(rule, into).alias(rule) for rule in RULES]
    rows = frame.filter(~base_failed(into)).select(*votes).groupBy(*RULES).count().collect()  # at most 3 ** len(RULES)
    return estimate(sorted((tuple(r[rule] for rule in RULES), r["count"]) for r in rows))


def posterior(model: Reliability, into: str = "_measures") -> Column:
    log_odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for rule in RULES:
        vote = _vote(rule, into)
        log_odds = log_odds + F.when(vote == 1, F.lit(model.when_good[rule])).when(vote == -1, F.lit(model.when_bad[rule])).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-log_odds))


def judged(
    docs: DataFrame, text: str = "text", into: str = "_measures", min_posterior: float = 0.9, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``into``: the measures, ``posterior``, ``base_failed`` and ``kept``."""
    frame = measured(docs, text, into, keep)
    model = fit(frame, into)
    kept = ~base_failed(into) & (posterior(model, into) >= min_posterior)
    return frame.withColumn(
        into, F.struct(F.col(f"{into}.*"), posterior(model, into).alias("posterior"), base_failed(into).alias("base_failed"), kept.alias("kept"))
    )


def accepted(docs: DataFrame, text: str = "text", min_posterior: float = 0.9) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged."""
    into = fresh(docs, "_measures")
    frame = measured(docs, text, into)
    model = fit(frame, into)
    return frame.filter(~base_failed(into) & (posterior(model, into) >= min_posterior)).drop(into)
