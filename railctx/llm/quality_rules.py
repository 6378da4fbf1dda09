"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes a text good (1), bad (-1) or abstains (0). How often a rule is right is not
given: expectation-maximisation over the votes of the whole corpus estimates, per class, how
often each rule votes which way, and the share of good texts; the posterior probability of
being good replaces the demand that every rule must pass. The corpus enters the estimate as counts of vote patterns, which are summed
before they are shuffled; a pattern table has at most 3^rules rows, whatever the corpus.

Priors stand for pseudo texts, a share of the corpus: a bad vote is rarely wrong, a good vote
says little, and most texts are good. They keep the two classes from trading places and a corpus that has no bad
texts from losing good ones.

Defined cases: null or empty text has no words, fails the base and is not kept; repeated rows
are judged alike; an empty table gives no rows; ids may be null or repeat.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railctx.llm.arrow import written

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: The smallest number of words, and the largest share of words in repeated windows, of the base.
LEAST_WORDS, MOST_REPEATED = 50, 0.5


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 50", "n_words < 5"),
    Rule("word_length", "word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbols", "20 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "20 * n_dup_lines <= n_lines", "3 * n_dup_lines > n_lines"),
    Rule("repeated_words", "10 * n_repeat_words <= n_words", "2 * n_repeat_words > n_words"),
    Rule("capitals", "5 * n_upper <= n_letters", "2 * n_upper > n_letters"),
    Rule("exclamations", "20 * n_exclaims <= n_words", "5 * n_exclaims > n_words"),
    Rule("distinct_words", "4 * n_distinct >= n_words or n_words > 400", "8 * n_distinct < n_words and n_words <= 2000"),
)

#: Pseudo texts of the prior as a share of the corpus and at least, the share of them that is
#: good, and how a rule votes on each class: good, abstain, bad. A bad text breaks few rules, so
#: passing one says little, but a good text hardly ever breaks any.
PRIOR_SHARE, PRIOR_TEXTS, PRIOR_GOOD = 0.1, 20.0, 0.9
PRIOR_VOTES = {True: (0.95, 0.048, 0.002), False: (0.75, 0.05, 0.20)}
#: Rules are written so that a good text seldom breaks one, and bad texts are bad in different
#: ways: the estimates of a false alarm, and of a bad text passing a rule, stay on these sides.
MOST_FALSE_ALARMS, LEAST_PASSED = 0.002, 0.75
ROUNDS = 30


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole_row: bool = False) -> DataFrame:
    """What the rules look at, from each whole text; ``row`` holds the columns of the input on demand."""
    row = [F.struct(*docs.columns).alias("row")] if whole_row else []
    plain = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *row
    )
    body = F.col("text")
    split = plain.select(
        *(c for c in plain.columns if c != "text"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
        F.length(F.translate(body, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(body) - F.length(F.translate(body, "!", ""))).cast("long").alias("n_exclaims"),
        F.length(F.regexp_replace(body, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(body, r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    counted = split.select(
        *(c for c in split.columns if c not in ("words", "lines")),
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    return repeated_words(counted.withColumn("n_distinct", F.size(F.array_distinct("hashes")).cast("long")))


def repeated_words(counted: DataFrame) -> DataFrame:
    """``n_repeat_words``: words that lie in a window of three found twice or more in the text.

    Windows are sorted with their place, so equal ones are neighbours; a place is marked when
    the window before or behind is equal. Texts in which no window repeats skip that. Every
    array is a column of its own, because an expression inside a lambda would be computed anew
    for each element.
    """
    others = [c for c in counted.columns if c != "hashes"]
    windowed = counted.select(
        *others,
        F.transform(
            F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("hashes", i + 1), F.get("hashes", i + 2)),
        ).alias("windows"),
    )
    placed = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
    )
    sorted_ = windowed.select(*others, placed.alias("placed"))
    marked = F.transform(
        "placed",
        lambda x, k: F.when(
            (F.get("placed", k - 1)["w"] == x["w"]) | (F.get("placed", k + 1)["w"] == x["w"]),
            F.array(x["i"], x["i"] + 1, x["i"] + 2),
        ),
    )
    covered = F.size(F.array_distinct(F.flatten(F.filter(marked, lambda i: i.isNotNull()))))
    return sorted_.select(*others, F.when(F.col("placed").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} or n_repeat_words > {MOST_REPEATED} * n_words")


def vote(rule: Rule) -> Column:
    return F.expr(f"case when {rule.bad} then -1 when {rule.good} then 1 else 0 end")


@dataclass(frozen=True)
class Model:
    """Share of good texts, and per class and rule the chance of each vote (good, abstain, bad)."""

    good: float
    votes: dict[bool, list[tuple[float, float, float]]]

    def log_odds(self, pattern: tuple[int, ...]) -> float:
        odds = math.log(self.good / (1 - self.good))
        for rule, value in enumerate(pattern):
            odds += math.log(self.votes[True][rule][1 - value] / self.votes[False][rule][1 - value])
        return odds


def held(votes: tuple[float, ...], place: int, at_least: float = 0.0, at_most: float = 1.0) -> tuple[float, ...]:
    """Chances with one of them kept in bounds and the others scaled to what is left."""
    bounded = min(max(votes[place], at_least), at_most)
    rest = (1 - bounded) / (1 - votes[place])
    return tuple(bounded if i == place else v * rest for i, v in enumerate(votes))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int) -> Model:
    """Expectation-maximisation over counted vote patterns, with the priors as pseudo texts."""
    model = Model(PRIOR_GOOD, {c: [PRIOR_VOTES[c]] * rules for c in (True, False)})
    prior = PRIOR_TEXTS + PRIOR_SHARE * sum(count for _, count in patterns)
    for _ in range(ROUNDS):
        mass = {True: prior * PRIOR_GOOD, False: prior * (1 - PRIOR_GOOD)}
        votes = {c: [[mass[c] * p for p in PRIOR_VOTES[c]] for _ in range(rules)] for c in (True, False)}
        for pattern, count in patterns:
            share = 1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(pattern)))))
            for c, weight in ((True, count * share), (False, count * (1 - share))):
                mass[c] += weight
                for rule, value in enumerate(pattern):
                    votes[c][rule][1 - value] += weight
        shares = {c: [tuple(x / sum(row) for x in row) for row in votes[c]] for c in (True, False)}
        shares = {
            True: [held(row, 2, at_most=MOST_FALSE_ALARMS) for row in shares[True]],
            False: [held(row, 0, at_least=LEAST_PASSED) for row in shares[False]],
        }
        model = Model(mass[True] / (mass[True] + mass[False]), shares)
    return model


def fit(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """Counts of vote patterns over all texts; at most 3^rules rows reach the driver."""
    names = [f"vote_{i}" for i in range(len(rules))]
    counted = measured.select(*(vote(r).alias(n) for r, n in zip(rules, names, strict=True))).groupBy(*names).count()
    patterns = sorted((tuple(row[n] for n in names), row["count"]) for row in counted.collect())
    return estimate(patterns, len(rules))


def log_odds(model: Model, rules: tuple[Rule, ...] = RULES) -> Column:
    total = F.lit(math.log(model.good / (1 - model.good)))
    for index, rule in enumerate(rules):
        good, none, bad = (math.log(a / b) for a, b in zip(model.votes[True][index], model.votes[False][index], strict=True))
        total = total + F.when(vote(rule) == 1, good).when(vote(rule) == -1, bad).otherwise(none)
    return total


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = 0.5, whole_row: bool = False, **columns: str) -> DataFrame:
    """Measures, the base, the posterior of being good and whether to keep the text."""
    measured = written(measures(docs, whole_row=whole_row, **columns))
    odds = log_odds(fit(measured, rules), rules)
    judged = measured.withColumn("base_failed", base_failed()).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))


def keep(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows that are kept, with all their columns and no shuffle."""
    return judge(docs, whole_row=True, **columns).where("kept").select("row.*")
