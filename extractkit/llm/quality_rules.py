"""Document quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Words are runs without ASCII white space.  Each rule of :data:`RULES` looks at a few counts of
a document and votes good, bad or abstains.  A document's quality is hidden; a rule that votes
is right with an accuracy of its own on good and another on bad documents.  One pass counts the documents
of each combination of votes (at most ``3 ** len(RULES)`` rows, however many documents);
expectation-maximisation on these counts gives the accuracies and the share of good documents,
free but for a weak prior (:data:`PRIORS`) and for this: no rule may do worse than chance, which
says which of the two hidden classes is the good one.  Rules that vote alike on nearly all documents (:data:`ALIKE`) are one
opinion: together they weigh as much as one of them.
A document's posterior probability of being good is a sum of log odds, a plain expression.
A document fails outright (``base_failed``) with under 20 words, or with over 30 % of its
words in repeated windows of eight; others are kept at a posterior of one half or more.
All of this is Spark SQL expressions; windows are compared by a 64-bit hash of their words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.llm.common import let

SPACES = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word of marks only.
LONE = r"(?<![^\x20\x09-\x0D])[!-/:-@\[-`{-~]++(?![^\x20\x09-\x0D])"
SENTENCE_ENDS = (".", "!", "?", ":", ";", "…", "。", "！", "？", "\"", "”", "»", ")")
WINDOW = 8
FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_shouts", "n_distinct",
    "n_marks", "n_lone", "n_ended",
)
LINES = {"n_lines": "n", "n_dup_lines": "d", "n_ended": "e"}
#: Pseudo-votes of the prior, (right, wrong), on good and on bad documents, and pseudo-documents (good, bad).
#: Rules are written to spare good documents; one kind of junk trips few of them.  This matters for a few hundred
#: documents, or where all junk trips one opinion only, which by itself could as well be noise.
PRIORS = ((199.0, 1.0), (2.0, 8.0), (5.0, 5.0))
#: Cohen's kappa of two rules' votes (three values) from which they are one opinion.
ALIKE = 0.95


def _vote(rate: str, good: str, bad: str) -> str:
    return f"CASE WHEN {rate} {bad} THEN -1 WHEN {rate} {good} THEN 1 ELSE 0 END"


#: name -> vote as SQL: -1 bad, 1 good, 0 none
RULES = {
    "repeats": _vote("n_repeat_words / greatest(n_words, 1)", "< 0.1", "> 0.2"),
    "symbols": _vote("n_symbols / greatest(n_words, 1)", "< 0.02", "> 0.1"),
    "marks": _vote("n_marks / greatest(word_chars, 1)", "< 0.1", "> 0.25"),
    "lone": _vote("n_lone / greatest(n_words, 1)", "< 0.1", "> 0.2"),
    "ends": f"CASE WHEN n_lines >= 3 THEN {_vote('n_ended / greatest(n_lines, 1)', '> 0.6', '< 0.1')} ELSE 0 END",
    "lines": f"CASE WHEN n_lines >= 3 THEN {_vote('n_dup_lines / greatest(n_lines, 1)', '= 0', '> 0.3')} ELSE 0 END",
    "capitals": _vote("n_capitals / greatest(word_chars, 1)", "< 0.2", "> 0.4"),
    "shouts": _vote("n_shouts / greatest(n_words, 1)", "< 0.05", "> 0.2"),
    "length": _vote("word_chars / greatest(n_words, 1)", "BETWEEN 3 AND 7", "NOT BETWEEN 2 AND 10"),
    "variety": _vote("n_distinct / greatest(n_words, 1)", "> 0.25", "< 0.1"),
}


def _repeat_words(windows: Column) -> Column:
    """How many words lie in windows found twice or more."""

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get(at, k - 1))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def twice(ordered: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(ordered, k)["h"] == e["h"], F.lit(False))
        found = F.filter(ordered, lambda e, k: same(e, k - 1) | same(e, k + 1))
        return let(F.sort_array(F.transform(found, lambda e: e["i"])), covered)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ordered, twice))


def counts(text: Column) -> Column:
    """A struct of :data:`FEATURES` (long) of a whole text; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))

    def removed(characters: str) -> Column:
        return F.length(F.translate(text, characters, ""))

    def of(words: Column) -> Column:
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        windows = let(
            hashes, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        )
        lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
        ended = lambda x: F.substring(F.rtrim(x), -1, 1).isin(*SENTENCE_ENDS)
        lines = let(lines, lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"), F.size(F.filter(x, ended)).alias("e")
        ))
        values = {
            "n_words": F.size(words), "word_chars": removed(SPACES), "n_symbols": F.length(text) - removed(SYMBOLS),
            "n_repeat_words": F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(windows, _repeat_words)),
            "n_capitals": F.length(text) - removed(CAPITALS), "n_shouts": F.length(text) - removed("!"),
            "n_distinct": F.size(F.array_distinct(words)), "n_marks": F.length(text) - removed(MARKS), "n_lone": F.regexp_count(text, F.lit(LONE)),
        }
        return let(lines, lambda x: F.struct(*[
            (x[LINES[name]] if name in LINES else values[name]).cast("long").alias(name) for name in FEATURES
        ]))

    return let(F.array_remove(F.split(text, SPLIT), ""), of)


def with_counts(documents: DataFrame) -> DataFrame:
    """``documents`` with the counts of :func:`counts` as columns (clashing names are replaced)."""
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in FEATURES]
    return documents.select(*kept, count_columns(F.col("text")))


def count_columns(text: Column) -> Column:
    """The counts as columns of a generator of one row: a filter on them is not moved below it, which would compute them for each use."""
    return F.inline(F.array(counts(text)))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class RuleModel:
    """The share of good documents, each rule's accuracies (right votes on good and on bad documents), and rules that are one opinion."""

    good: float
    accuracies: dict[str, tuple[float, float]]
    opinions: tuple[tuple[str, ...], ...]

    def weights(self) -> dict[str, tuple[float, float]]:
        """Log odds of a rule's good and of its bad vote."""
        return {name: (math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)) for name, (on_good, on_bad) in self.accuracies.items()}

    def odds(self, votes: dict[str, int]) -> float:
        """The log odds that a document with these votes is good: the mean within an opinion, the sum over them."""
        weights, odds = self.weights(), math.log(self.good / (1 - self.good))
        for opinion in self.opinions:
            cast = [weights[name][votes[name] < 0] for name in opinion if votes[name]]
            odds += sum(cast) / max(1, len(cast))
        return odds

    def posterior(self) -> Column:
        """The probability that a document with the columns :data:`FEATURES` is good."""
        weights, odds = self.weights(), F.lit(math.log(self.good / (1 - self.good)))
        for opinion in self.opinions:
            votes = [F.expr(RULES[name]) for name in opinion]
            said = [F.when(v > 0, F.lit(weights[n][0])).when(v < 0, F.lit(weights[n][1])).otherwise(F.lit(0.0)) for n, v in zip(opinion, votes)]
            if len(opinion) == 1:
                odds = odds + said[0]
            else:
                odds = odds + sum(said[1:], said[0]) / F.greatest(F.lit(1), sum((F.abs(v) for v in votes[1:]), F.abs(votes[0])))
        return 1 / (1 + F.exp(-odds))

    def kept(self) -> Column:
        return ~base_failed() & (self.posterior() >= 0.5)


def same_opinions(names: list[str], patterns: list[tuple[tuple[int, ...], int]]) -> tuple[tuple[str, ...], ...]:
    """``names`` in groups: two rules whose votes agree by :data:`ALIKE` or more share one; a rule that always votes the same is alone."""
    total = sum(n for _, n in patterns)
    group = {name: name for name in names}
    for (i, a), (j, b) in combinations(enumerate(names), 2):
        agree = sum(n for v, n in patterns if v[i] == v[j]) / max(1, total)
        shares = [[sum(n for v, n in patterns if v[k] == vote) / max(1, total) for vote in (-1, 0, 1)] for k in (i, j)]
        chance = sum(x * y for x, y in zip(*shares))
        if chance < 1 and (agree - chance) / (1 - chance) >= ALIKE:
            old, new = group[b], group[a]
            group = {name: new if own == old else own for name, own in group.items()}
    return tuple(tuple(n for n in names if group[n] == own) for own in dict.fromkeys(group.values()))


def expectation_maximisation(names: list[str], patterns: list[tuple[tuple[int, ...], int]], rounds: int = 500, close: float = 1e-9) -> RuleModel:
    """The model that the counts of vote patterns (votes by rule, documents) make most probable under :data:`PRIORS`.

    It starts from the means of the priors and ends when no number moves by more than ``close``.  A rule that
    would do worse than chance (its good vote likelier on bad documents than on good ones) gets one rate for both, the
    best within that bound, and so no weight.  Without patterns the start is the result.
    """
    (good_right, good_wrong), (bad_right, bad_wrong), (prior_good, prior_bad) = PRIORS
    start = (good_right / (good_right + good_wrong), bad_right / (bad_right + bad_wrong))
    model = RuleModel(prior_good / (prior_good + prior_bad), dict.fromkeys(names, start), same_opinions(names, patterns))
    for _ in range(rounds if patterns else 0):
        share, total = prior_good, prior_good + prior_bad
        sums = {name: [good_right, good_wrong, bad_right, bad_wrong] for name in names}
        for pattern, n in patterns:
            p = 1 / (1 + math.exp(-model.odds(dict(zip(names, pattern)))))
            share, total = share + n * p, total + n
            for vote, own in zip(pattern, sums.values()):
                if vote:
                    own[vote < 0] += n * p
                    own[2 + (vote > 0)] += n * (1 - p)
        found = {}
        for name, (a, b, c, d) in sums.items():
            if a / (a + b) < d / (c + d):
                both = (a + d) / (a + b + c + d)
                found[name] = (both, 1 - both)
            else:
                found[name] = (a / (a + b), c / (c + d))
        moved = max([abs(share / total - model.good), *(abs(x - y) for n in names for x, y in zip(found[n], model.accuracies[n]))])
        model = RuleModel(share / total, found, model.opinions)
        if moved <= close:
            break
    return model


def fit(counted: DataFrame) -> RuleModel:
    """The model of all rows of :func:`with_counts` that the base checks leave open; see :func:`expectation_maximisation`."""
    votes = counted.where(~base_failed()).select(*[F.expr(vote).alias(name) for name, vote in RULES.items()])
    rows = sorted(votes.groupBy(*RULES).count().collect())
    return expectation_maximisation(list(RULES), [(tuple(row[:-1]), row[-1]) for row in rows])


def judged(documents: DataFrame) -> DataFrame:
    """``documents`` with :data:`FEATURES`, ``base_failed``, ``quality`` (posterior) and ``kept``.

    Null and empty texts have counts of 0 and fail; repeated rows count each; no rows give none;
    further columns pass through, unless they bear one of these names.
    """
    added = ("base_failed", "quality", "kept")
    counted = with_counts(documents.drop(*[c for c in documents.columns if c.lower() in added]))
    model = fit(counted)
    return counted.withColumns({"base_failed": base_failed(), "quality": model.posterior(), "kept": model.kept()})
