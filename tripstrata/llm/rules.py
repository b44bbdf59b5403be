"""Quality rules as a learned decision list, applied as Spark expressions only.

Statistics of every text are column expressions. Rules are learned on the driver from a
sample of labelled statistics of bounded size, by sequential covering: a rule grows by the
threshold that best tells bad rows from good ones, is pruned on rows it has not seen, and
covers its rows; what is left is covered by the next. The list becomes one ordered
conditional expression.

A null text has no words. A text without words has all statistics zero and fails the base
rules. Null labels are ignored; of several for one document the mean decides. Without bad
labels the list is empty and keeps all. Tables without rows give none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep, least_hashed
from tripstrata.llm.boosting import is_held_out

#: Most labelled rows learned from; those of least hash of their id.
SAMPLE_ROWS = 10_000
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 4, 24
#: Least share of bad rows among those that a rule drops, on rows it was not grown on.
PRECISION = 0.9

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = [
    "n_words", "word_length", "symbol_share", "symbols_per_word", "dup_line_share",
    "repeat_share", "upper_share", "digit_share", "distinct_share", "words_per_line",
    "marks_per_word", "shouts_per_word",
]


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(_without(text, letters))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def repeated_words(hashes: Column) -> Column:
    """Words in windows that occur more than once, from the windows' hashes in order."""

    def starts(pairs: Column) -> Column:
        same = lambda j, p: F.coalesce(F.get(pairs, j)["h"] == p["h"], F.lit(False))
        marked = F.transform(pairs, lambda p, j: F.when(same(j - 1, p) | same(j + 1, p), p["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    sorted_pairs = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        let(sorted_pairs, starts),
        zero,
        lambda acc, i: F.struct(
            (i + WINDOW).alias("end"),
            (acc["total"] + i + WINDOW - F.greatest(acc["end"], i)).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def _repeat_count(words: Column) -> Column:
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )
    counted = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            repeated_words(h)
        ),
    )
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(counted)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` with the base statistics and those that rules are learned over."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).alias("n_distinct"),
            _repeat_count(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        F.filter(F.split(text, "\n"), lambda x: _without(x, SPACES) != ""),
        lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        of_words.alias("w"),
        of_lines.alias("l"),
        F.length(_without(text, SPACES)).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _count(text, "0123456789").alias("n_digits"),
        _count(text, ".,;:?").alias("n_marks"),
        _count(text, "!").alias("n_shouts"),
    ).select("*", "w.*", "l.*")
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        per("word_chars", "n_words").alias("word_length"),
        per("n_symbols", "word_chars").alias("symbol_share"),
        per("n_symbols", "n_words").alias("symbols_per_word"),
        per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
        per("n_upper", "word_chars").alias("upper_share"),
        per("n_digits", "word_chars").alias("digit_share"),
        per("n_distinct", "n_words").alias("distinct_share"),
        per("n_words", "n_lines").alias("words_per_line"),
        per("n_marks", "n_words").alias("marks_per_word"),
        per("n_shouts", "n_words").alias("shouts_per_word"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.cut) == self.above

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


Rule = list[Condition]


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    hit = [r for r in rows if all(c.holds(r) for c in rule)]
    bad = sum(r["bad"] for r in hit)
    return bad, len(hit) - bad


def _grow(rows: list[dict]) -> Rule:
    """Add the condition of most information gain until no good row is covered."""
    rule: Rule = []
    while len(rule) < MAX_CONDITIONS:
        bad, good = sum(r["bad"] for r in rows), sum(not r["bad"] for r in rows)
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for feature in FEATURES:
            ranked = sorted((r[feature], r["bad"]) for r in rows)
            below, step = 0, max(1, len(ranked) // CUTS)
            for k, (value, is_bad) in enumerate(ranked[:-1]):
                below += is_bad
                edge = ranked[k + 1][1] != is_bad or not (k + 1) % step
                if value == ranked[k + 1][0] or not edge:
                    continue
                cut = (value + ranked[k + 1][0]) / 2
                for above, p, n in ((False, below, k + 1), (True, bad - below, len(ranked) - k - 1)):
                    gain = p * (math.log2(p / n) - before) if p else 0.0
                    if gain > best[0] + 1e-9:
                        best = gain, Condition(feature, above, cut)
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if best[1].holds(r)]
    return rule


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """Drop last conditions where that does better on unseen rows."""

    def worth(r: Rule) -> float:
        bad, good = _counts(r, rows)
        return (bad - good) / (bad + good) if bad + good else -1.0

    best = rule
    for size in range(len(rule) - 1, 0, -1):
        if worth(rule[:size]) >= worth(best):
            best = rule[:size]
    return best


def learn_list(rows: list[dict]) -> list[Rule]:
    """Rules for bad rows, in the order they were found; rows have ``FEATURES`` and ``bad``."""
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        growing = [r for i, r in enumerate(rows) if i % 3]
        unseen = [r for i, r in enumerate(rows) if not i % 3]
        rule = _prune(_grow(growing), unseen)
        bad, good = _counts(rule, unseen)
        if not rule or bad < 3 or bad < PRECISION * (bad + good):
            break
        rules.append(rule)
        rows = [r for r in rows if not all(c.holds(r) for c in rule)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True unless one of the rules holds, the first that does deciding."""
    out = F.lit(True)
    for rule in reversed(rules):
        whole = rule[0].column()
        for condition in rule[1:]:
            whole = whole & condition.column()
        out = F.when(whole, F.lit(False)).otherwise(out)
    return out


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, list[Rule]]:
    """Statistics, ``base_failed`` and ``kept`` of every row of ``docs``, and the rules."""
    stats = keep(with_statistics(docs, id_col, text_col), "rule-statistics")
    marks = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.avg("quality") < 0.5).alias("bad"))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    sample = stats.join(marks, "doc_id").where(~base_failed & ~is_held_out("doc_id"))
    rows = least_hashed(sample, "doc_id", sample_rows, FEATURES)
    rules = learn_list([r.asDict() for r in rows])
    done = stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & verdict(rules)).alias("kept"),
    )
    return done, rules
