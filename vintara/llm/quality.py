"""Quality rules as weak supervision.

Each rule looks at counts of a text and votes good, bad or abstains. How far a rule can be trusted
is not set by hand: expectation-maximisation over how often the votes occur together estimates each
rule's accuracies on good and on bad texts and the share of good ones; a text is kept if its
posterior probability of being good is high enough, whichever rules it fails.

All counts are DataFrame expressions within the row, so nothing is shuffled but the table of vote
patterns: at most three to the number of rules, whatever the size of the corpus. That table goes
to the driver; the posterior is an expression over the votes again.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.llm.common import BLANKS, let
from vintara.session import settle

#: Characters that count as symbols (fixed by the contract), words of a window.
SYMBOLS, WINDOW = "#*$%&|<>", 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper",
          "n_bangs", "n_digits", "n_symbol_lines", "n_ends")


def _without(text: Column, characters: str) -> Column:
    """How many of the characters are in the text."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _covered(windows: Column) -> Column:
    """Words that lie in a window found twice or more, from the windows' hashes in order."""

    def of_sorted(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        twice = F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(places, start, lambda acc, x: F.struct(
            x.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("sum")))["sum"]

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(ordered, of_sorted)).otherwise(
        F.lit(0).cast("long"))


def _of_words(words: Column) -> Column:
    n = F.size(words)
    windows = F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                             lambda i: F.xxhash64(F.slice(words, i, WINDOW))))
    return F.struct(n.cast("long").alias("n_words"),
                    F.coalesce(let(windows, _covered), F.lit(0).cast("long")).alias("n_repeat_words"),
                    F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))


def counts(text: Column) -> Column:
    """Struct of ``COUNTS`` of a whole text; all zero for a null or empty one.

    Words are runs without ASCII white space. Windows are compared by 64-bit hashes.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    of_lines = let(lines, lambda a: F.struct(F.size(a).cast("long").alias("n_lines"),
                                             (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
                                             F.size(F.filter(a, lambda x: F.length(F.translate(x, SYMBOLS, "")) < F.length(x)))
                                             .cast("long").alias("n_symbol_lines")))
    closed = F.concat(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit(" "))
    ends = F.length(closed) - F.length(F.replace(closed, F.lit(". "), F.lit(" ")))
    found = let(F.struct(let(words, _of_words).alias("w"), of_lines.alias("l")), lambda s: F.struct(
        s["w"]["n_words"].alias("n_words"), F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        _without(text, SYMBOLS).alias("n_symbols"), s["l"]["n_lines"].alias("n_lines"),
        s["l"]["n_dup_lines"].alias("n_dup_lines"), s["w"]["n_repeat_words"].alias("n_repeat_words"),
        s["w"]["n_distinct"].alias("n_distinct"), _without(text, UPPER).alias("n_upper"),
        _without(text, "!").alias("n_bangs"), _without(text, "0123456789").alias("n_digits"),
        s["l"]["n_symbol_lines"].alias("n_symbol_lines"), ends.cast("long").alias("n_ends")))
    return found


def _vote(bad: Column, good: Column | None = None) -> Column:
    """1 good, 0 bad, -1 abstains; bad comes first, and nothing is said where a count is missing."""
    vote = F.when(F.coalesce(bad, F.lit(False)), 0)
    return (vote if good is None else vote.when(F.coalesce(good, F.lit(False)), 1)).otherwise(-1)


def votes() -> dict[str, Column]:
    """The rules, over the columns of ``COUNTS``.

    Most only know a fault when they see it and abstain otherwise: a text without one fault may
    have another. What speaks for a text is that it reads like prose.
    """
    by_word = lambda c: F.try_divide(F.col(c), F.col("n_words"))
    by_char = lambda c: F.try_divide(F.col(c), F.col("word_chars"))
    n, length, symbols, repeated = F.col("n_words"), by_word("word_chars"), by_word("n_symbols"), by_word("n_repeat_words")
    same_lines, distinct = F.try_divide("n_dup_lines", "n_lines"), by_word("n_distinct")
    symbol_chars, symbol_lines, ends = by_char("n_symbols"), F.try_divide("n_symbol_lines", "n_lines"), by_word("n_ends")
    upper, bangs, digits = by_char("n_upper"), by_word("n_bangs"), by_char("n_digits")
    return {
        "too_short": _vote(n < 20),
        "odd_word_length": _vote((length < 2.5) | (length > 14)),
        "symbols_by_word": _vote(symbols > 0.1),
        "symbols_by_character": _vote(symbol_chars > 0.02),
        "symbols_by_line": _vote(symbol_lines > 0.5),
        "repeated_passages": _vote(repeated > 0.3),
        "repeated_lines": _vote(same_lines > 0.5),
        "few_different_words": _vote((distinct < 0.1) & (n >= 50)),
        "capitals": _vote(upper > 0.5),
        "exclamations": _vote(bangs > 0.3),
        "digits": _vote(digits > 0.4),
        "no_sentences": _vote((ends < 0.002) & (n >= 50)),
        "prose": _vote(F.lit(False), (n >= 20) & ends.between(0.005, 0.5) & (symbol_chars < 0.01) & (upper < 0.3)
                       & (repeated < 0.2) & length.between(2.5, 14)),
    }


#: Chances of (bad, abstain, good) that fitting starts from, on good and on bad texts, and how
#: many votes of every hundred they count for.
START, WEIGHT = {True: (0.02, 0.48, 0.5), False: (0.3, 0.6, 0.1)}, 0.05


class Model:
    """Share of good texts, and each rule's chances to vote bad, abstain and vote good on them and
    on bad ones."""

    def __init__(self, good: float, rules: Mapping[str, Mapping[bool, tuple[float, float, float]]]) -> None:
        self.good, self.rules = good, {name: dict(by) for name, by in rules.items()}

    def accuracies(self) -> dict[str, float]:
        """Chance that a rule is right when it votes."""
        out = {}
        for name, by in self.rules.items():
            right = self.good * by[True][2] + (1 - self.good) * by[False][0]
            out[name] = right / (right + self.good * by[True][0] + (1 - self.good) * by[False][2])
        return out

    def _weights(self, name: str) -> list[float]:
        """Log odds that each vote adds."""
        by = self.rules[name]
        return [math.log(by[True][k] / by[False][k]) for k in range(3)]

    def log_odds(self, votes: Mapping[str, int]) -> float:
        outcome = {0: 0, -1: 1, 1: 2}
        return math.log(self.good / (1 - self.good)) + sum(self._weights(n)[outcome[votes[n]]] for n in self.rules)

    def posterior(self) -> Column:
        """Probability of good, over columns named like the rules."""
        total = F.lit(math.log(self.good / (1 - self.good)))
        for name in self.rules:
            bad, none, good = self._weights(name)
            total = total + F.when(F.col(name) == 0, bad).when(F.col(name) == 1, good).otherwise(none)
        return 1 / (1 + F.exp(-total))


def fit(patterns: list[dict], names: list[str], rounds: int = 200) -> Model:
    """EM over vote patterns with their number ``n``.

    It starts from rules that are mostly right, which settles which of the two classes is the good
    one; the start also counts as some votes, so that no chance becomes zero.
    """
    model, total = Model(0.8, {name: START for name in names}), sum(p["n"] for p in patterns)
    outcome = {0: 0, -1: 1, 1: 2}
    for _ in range(rounds if total else 0):
        mass = {True: 0.0, False: 0.0}
        seen = {name: {c: [0.0, 0.0, 0.0] for c in START} for name in names}
        for p in patterns:
            good = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(p)))))
            for kind, share in ((True, good), (False, 1 - good)):
                mass[kind] += p["n"] * share
                for name in names:
                    seen[name][kind][outcome[p[name]]] += p["n"] * share
        held = {c: 1 + WEIGHT * mass[c] for c in START}
        after = Model((mass[True] + 1) / (total + 2), {name: {
            c: tuple((x + held[c] * s) / (mass[c] + held[c]) for x, s in zip(seen[name][c], START[c]))
            for c in START} for name in names})
        moved = max(abs(x - y) for n in names for c in START for x, y in zip(after.rules[n][c], model.rules[n][c]))
        model = after
        if moved < 1e-9:
            break
    return model


def learn(counted: DataFrame) -> Model:
    """Fit to all rows of a frame with the columns of ``COUNTS``."""
    rules = votes()
    patterns = counted.select(*[v.alias(n) for n, v in rules.items()]).groupBy(*rules).agg(F.count("*").alias("n"))
    return fit([row.asDict() for row in patterns.collect()], list(rules))


def base_failed() -> Column:
    """Fails whatever the rules say (fixed by the contract)."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id``, ``COUNTS``, the votes, ``base_failed``, ``probability`` and ``kept`` of each row.

    Rows that repeat an id are judged each by itself. A null or empty text has no words and fails.
    """
    counted = settle(docs.select(F.col(doc_id).alias("doc_id"), counts(F.col(text)).alias("c")).select("doc_id", "c.*"))
    voted = counted.select("*", *[v.alias(n) for n, v in votes().items()])
    probability = learn(counted).posterior()
    return voted.withColumn("base_failed", base_failed()).withColumn("probability", probability).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= least))
