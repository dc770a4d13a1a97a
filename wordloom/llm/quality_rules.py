"""Quality rules as weak supervision: rules vote or abstain, a latent class decides.

Each rule looks at one side of a text and votes good (1), bad (-1) or abstains (0). Which
rules to trust is not set by hand: expectation-maximisation over the counts of the vote
patterns estimates, for each rule, how often its votes are right on good and on bad texts,
and the share of good texts. A text is kept when its posterior probability of being good
reaches the threshold, so one weak complaint does not reject a text and several do.

The vote patterns are one aggregate with at most ``3 ** len(RULES)`` rows whatever the size of
the corpus; each step of the estimation is one aggregate over that stored table, of which the
driver sees the sums of the votes alone. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.text_stats import with_text_stats
from wordloom.session import staged

RULES = ("length", "symbols", "symbol_share", "word_length", "capitals", "marks", "windows",
         "lines", "variety")
#: Steps of the estimation, and how far a text must be good to be kept.
STEPS = 12
KEEP = 0.5
#: Before any text is seen: right votes and wrong votes of a rule on good and on bad texts.
PRIOR_GOOD = (29.4, 0.6)
PRIOR_BAD = (3.0, 7.0)
PRIOR_SHARE = (8.0, 2.0)


def _ratio(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules, over the columns of ``with_text_stats``."""
    mean = _ratio("word_chars", "n_words")
    enough = F.col("n_words") >= 50
    return {
        "length": _vote(F.col("n_words") < 10, F.col("n_words") >= 50),
        "symbols": _vote(_ratio("n_symbols", "n_words") > 0.5, F.col("n_symbols") == 0),
        "symbol_share": _vote(_ratio("n_symbols", "word_chars") > 0.05, _ratio("n_symbols", "word_chars") < 0.01),
        "word_length": _vote((mean < 2.5) | (mean > 14), (mean >= 3) & (mean <= 11)),
        "capitals": _vote(_ratio("n_upper", "word_chars") > 0.4, _ratio("n_upper", "word_chars") < 0.15),
        "marks": _vote(_ratio("n_marks", "n_words") > 0.3, _ratio("n_marks", "n_words") < 0.05),
        "windows": _vote(_ratio("n_repeat_words", "n_words") > 0.2, _ratio("n_repeat_words", "n_words") < 0.1),
        "lines": _vote(_ratio("n_dup_lines", "n_lines") > 0.3, enough & (F.col("n_dup_lines") == 0)),
        "variety": _vote((F.col("n_words") >= 20) & (F.col("n_distinct") * F.col("n_distinct") < 4 * F.col("n_words")),
                         (F.col("n_distinct") * F.col("n_distinct") > 16 * F.col("n_words"))),
    }


@dataclass(frozen=True)
class VoteModel:
    """The share of good texts, and each rule's chance of a right vote on good and bad texts."""

    share: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def log_odds(self, votes: Column) -> Column:
        """Log odds of good, from the array of votes in the order of RULES."""
        numbers = lambda values: F.array(*[F.lit(float(x)) for x in values])
        for_good = numbers(math.log(g / (1 - b)) for g, b in zip(self.good, self.bad))
        for_bad = numbers(math.log((1 - g) / b) for g, b in zip(self.good, self.bad))
        weights = F.transform(votes, lambda v, i: F.when(v == 1, F.get(for_good, i)).when(
            v == -1, F.get(for_bad, i)).otherwise(0.0))
        first = F.lit(math.log(self.share / (1 - self.share)))
        return F.aggregate(weights, first, lambda total, w: total + w)

    def posterior(self, votes: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds(votes)))


def first_model() -> VoteModel:
    part = lambda prior: prior[0] / sum(prior)
    return VoteModel(part(PRIOR_SHARE), (part(PRIOR_GOOD),) * len(RULES), (part(PRIOR_BAD),) * len(RULES))


def fit_votes(patterns: DataFrame, steps: int = STEPS) -> VoteModel:
    """Estimate the model from the counted vote patterns (``votes`` and ``texts``).

    Each step is one aggregate by rule and vote, at most ``3 * len(RULES)`` rows.
    """
    model = first_model()
    n = F.col("texts")
    for _ in range(steps):
        weighed = patterns.select("votes", "texts", model.posterior(F.col("votes")).alias("q"))
        sums = {
            (r["rule"], r["vote"]): (r["good"], r["bad"])
            for r in weighed.select("texts", "q", F.posexplode("votes").alias("rule", "vote"))
            .groupBy("rule", "vote")
            .agg(F.sum(n * F.col("q")).alias("good"), F.sum(n * (1 - F.col("q"))).alias("bad"))
            .collect()
        }
        if not sums:
            return model
        got = lambda j, vote, side: sums.get((j, vote), (0.0, 0.0))[side]
        rate = lambda right, wrong, prior: (right + prior[0]) / (right + wrong + sum(prior))
        every = range(len(RULES))
        good, bad = (sum(got(0, vote, side) for vote in (-1, 0, 1)) for side in (0, 1))
        model = VoteModel(
            rate(good, bad, PRIOR_SHARE),
            tuple(rate(got(j, 1, 0), got(j, -1, 0), PRIOR_GOOD) for j in every),
            tuple(rate(got(j, -1, 1), got(j, 1, 1), PRIOR_BAD) for j in every),
        )
    return model


def with_votes(docs: DataFrame, key: str = "doc_id", text: str = "text",
               carry: bool = False) -> DataFrame:
    """The counts of each text, ``base_failed`` and the array ``votes`` in the order of RULES."""
    stats = with_text_stats(docs, key, text, carry)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rules = votes()
    return stats.select("*", failed.alias("base_failed"), F.array(*[rules[r] for r in RULES]).alias("votes"))


def vote_patterns(voted: DataFrame) -> DataFrame:
    """How many of the texts that pass the base rules have each pattern of votes, stored."""
    passed = F.count(F.when(~F.col("base_failed"), 1))
    counted = voted.groupBy("votes").agg(passed.alias("texts")).coalesce(1)
    return staged(counted, "patterns").where("texts > 0")


def _decide(voted: DataFrame, model: VoteModel) -> DataFrame:
    judged = voted.select("*", model.posterior(F.col("votes")).alias("p_good"))
    return judged.select("*", (~F.col("base_failed") & (F.col("p_good") >= KEEP)).alias("kept"))


def judge_quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its counts, votes, posterior ``p_good`` and ``kept``.

    A null text counts as empty. A text that fails the base rules (under ten words, or more
    than a fifth of its words in repeated windows) is never kept. Repeated rows are judged
    alike and each stays a row; an empty table gives no rows; other columns are not read.
    """
    voted = staged(with_votes(docs, key, text), "votes")
    return _decide(voted, fit_votes(vote_patterns(voted)))


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged; the texts are read twice and never shuffled."""
    model = fit_votes(vote_patterns(with_votes(docs, key, text)))
    judged = _decide(with_votes(docs, key, text, carry=True), model)
    # A filter is not pushed below a projection with a random column, where it would repeat all
    # of the expressions above many times over.
    marked = judged.select("row", "kept", F.rand(0).alias("any"))
    kept = marked.where(F.col("kept") & (F.col("any") >= 0))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
