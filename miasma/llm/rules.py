"""Quality rules: text statistics in Catalyst expressions and a learned decision list over them.

The list is learned by sequential covering. From labelled statistics, a rule is grown condition by
condition (``statistic >= t`` or ``statistic <= t``) for the highest information gain on one part
of the rows, then cut back to the length that is most precise on the other part; what it covers is
taken away and the next rule is grown. The result reads as an ordered chain of ``CASE WHEN``
conditions that reject, with "keep" at its end. Statistics, base rule and list are plain DataFrame
expressions within a row: one pass, no shuffle, no Python on the executors.

Learning uses at most ``MAX_TRAIN_ROWS`` labelled rows outside the held-out third; only their
numbers reach the driver.

Defined cases: null and empty texts have zero for every statistic and fail the base rule; null
labels are skipped; without labelled rows, or of one class only, the list is empty and the base
rule alone decides; repeated rows are judged alike; all other columns stay, columns named like a
result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.llm.common import WORD, held_out

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_TRAIN_ROWS = 10_000
FOLD = 3

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# What rules may test, besides the number of words; shares, so that they hold for any length.
SHARES = ["chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share",
          "upper_share", "digit_share", "mark_share", "words_per_line"]
STATISTICS = ["n_words", *SHARES]
# Name prefix of columns in between.
_T = "_rules_"


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _covered(positions: Column, width: int) -> Column:
    """Words covered by windows of ``width`` words that start at these sorted positions."""
    steps = F.transform(positions, lambda p, i: F.least(
        F.lit(width), F.coalesce(F.get(positions, i + 1) - p, F.lit(width))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, s: a + s)


def with_repeats(df: DataFrame, words: str, out: str, width: int = 3) -> DataFrame:
    """Add the number of words in windows of ``width`` words that occur twice or more.

    Window hashes are sorted as plain longs that hold the window's place in their lowest bits;
    neighbours with equal upper bits are the candidates. Only these are compared by the full
    64-bit hash. Everything is sorting, so a text of any length takes n log n.
    """
    hashes, bits, packed, found = (f"{_T}{x}" for x in ("hashes", "bits", "packed", "found"))
    n = F.size(words)
    starts = F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(hashes, F.transform(starts, lambda i: F.xxhash64(
        *[F.get(F.col(words), i + k) for k in range(width)])))
    df = df.withColumn(bits, F.length(F.bin(F.size(hashes))))

    def shifted(x: Column) -> Column:
        return F.call_function("shiftleft", x, F.col(bits))

    def upper(x: Column) -> Column:
        return F.call_function("shiftright", x, F.col(bits))

    df = df.withColumn(packed, F.sort_array(F.transform(
        hashes, lambda x, i: shifted(x).bitwiseOR(i.cast("bigint")))))
    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(bits)) - 1
    near = F.filter(packed, lambda x, i: F.coalesce(upper(x) == upper(F.get(F.col(packed), i + 1)), F.lit(False))
                    | ((i > 0) & F.coalesce(upper(x) == upper(F.get(F.col(packed), F.greatest(i - 1, F.lit(0)))), F.lit(False))))
    df = df.withColumn(found, F.sort_array(F.transform(
        near, lambda x: F.struct(F.get(F.col(hashes), x.bitwiseAND(low).cast("int")).alias("h"),
                                 x.bitwiseAND(low).cast("int").alias("p")))))
    df = df.drop(hashes, packed, bits)
    same = F.filter(found, lambda x, i: F.coalesce(x["h"] == F.get(F.col(found), i + 1)["h"], F.lit(False))
                    | ((i > 0) & F.coalesce(x["h"] == F.get(F.col(found), F.greatest(i - 1, F.lit(0)))["h"], F.lit(False))))
    df = df.withColumn(f"{_T}at", F.sort_array(F.transform(same, lambda x: x["p"]))).drop(found)
    return df.withColumn(out, _covered(F.col(f"{_T}at"), width)).drop(f"{_T}at")


def _without(docs: DataFrame, names) -> DataFrame:
    """``docs`` without columns of these names; Spark compares names without case."""
    return docs.select([c for c in docs.columns if c.lower() not in names])


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, the base counts and the shares that rules test.

    The statistics are spread by ``inline``: Spark would push a filter on a plain column below the
    projections that build it, and work out the arrays anew for each of their elements.
    """
    docs = _without(docs, (*BASE, *SHARES))
    text, words, lines = F.col(f"{_T}text"), f"{_T}words", f"{_T}lines"
    df = (docs.withColumn(f"{_T}text", F.coalesce(F.col(text_col), F.lit("")))
          .withColumn(words, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
          .withColumn(lines, F.filter(F.split(text, "\n", -1),
                                      lambda x: F.length(F.translate(x, SPACE, "")) > 0)))
    df = (df.withColumn("n_words", F.size(words).cast("bigint"))
          .withColumn("word_chars", F.length(F.translate(text, SPACE, "")).cast("bigint"))
          .withColumn("n_symbols", _count(text, SYMBOLS).cast("bigint"))
          .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"))
          .withColumn("distinct_share", _share(F.size(F.array_distinct(words)), F.size(words)))
          .withColumn("words_per_line", _share(F.size(words), F.size(lines)))
          .withColumn("dup_line_share", _share(F.col("n_dup_lines"), F.size(lines)))
          .withColumn("upper_share", _share(_count(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.col("word_chars")))
          .withColumn("digit_share", _share(_count(text, "0123456789"), F.col("word_chars")))
          .withColumn("mark_share", _share(_count(text, "!?;:"), F.col("n_words")))
          .drop(lines, f"{_T}text"))
    df = with_repeats(df, words, "n_repeat_words").drop(words)
    df = (df.withColumn("chars_per_word", _share(F.col("word_chars"), F.col("n_words")))
          .withColumn("symbols_per_word", _share(F.col("n_symbols"), F.col("n_words")))
          .withColumn("repeat_share", _share(F.col("n_repeat_words"), F.col("n_words"))))
    return df.select(*docs.columns, F.inline(F.array(F.struct(*BASE, *SHARES))))


@dataclass(frozen=True)
class Condition:
    statistic: int
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.statistic]
        return v >= self.threshold if self.at_least else v <= self.threshold

    def column(self) -> Column:
        v = F.col(STATISTICS[self.statistic])
        return v >= F.lit(self.threshold) if self.at_least else v <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{STATISTICS[self.statistic]} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = list[Condition]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([c.holds(x) for c in rule]) if rule else np.ones(len(x), bool)


def _best_condition(x: np.ndarray, bad: np.ndarray, cuts: int = 64) -> Condition | None:
    """The threshold with the highest gain: rows of the class kept × bits gained for each."""
    p, n = bad.sum(), (~bad).sum()
    before, best, top = np.log2(p / (p + n)), None, 1e-9
    for s in range(x.shape[1]):
        values = np.unique(x[:, s])
        if len(values) < 2:
            continue
        mids = (values[:-1] + values[1:]) / 2
        if len(mids) > cuts:
            mids = np.unique(np.concatenate([
                mids[np.linspace(0, len(mids) - 1, cuts).astype(int)],
                np.quantile(x[bad, s], np.linspace(0, 1, cuts))]))
        order = np.argsort(x[:, s], kind="stable")
        v, b = x[order, s], np.concatenate([[0], np.cumsum(bad[order])])
        from_low = np.searchsorted(v, mids, "right")   # rows with value <= cut
        from_high = np.searchsorted(v, mids, "left")   # rows with value < cut
        for at_least, kept_bad, kept in ((False, b[from_low], from_low),
                                         (True, b[-1] - b[from_high], len(v) - from_high)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(kept_bad > 0, kept_bad * (np.log2(kept_bad / np.maximum(kept, 1)) - before), -1)
            k = int(gain.argmax())
            if gain[k] > top:
                top, best = gain[k], Condition(s, at_least, float(mids[k]))
    return best


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
          min_precision: float = 0.95, seed: int = 11) -> list[Rule]:
    """Ordered rules that cover the rows marked ``bad``. A rule that is not precise enough on the
    rows kept aside for pruning ends the list, so clean rows stay."""
    rules, draw = [], np.random.default_rng(seed)
    x, bad = np.asarray(x, float), np.asarray(bad, bool)
    while len(rules) < max_rules and bad.any() and not bad.all():
        aside = draw.random(len(x)) < 1 / 3
        grow, grow_bad = x[~aside], bad[~aside]
        if not grow_bad.any():
            break
        rule: Rule = []
        inside = np.ones(len(grow), bool)
        while len(rule) < max_conditions and not grow_bad[inside].all():
            found = _best_condition(grow[inside], grow_bad[inside])
            if found is None:
                break
            rule.append(found)
            inside &= found.holds(grow)
        if not rule:
            break

        def worth(r: Rule) -> tuple[float, int]:
            hit = _covers(r, x[aside])
            good, wrong = (hit & bad[aside]).sum(), (hit & ~bad[aside]).sum()
            return (good - wrong) / max(good + wrong, 1), int(good)

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = _covers(rule, x)
        if (hit & bad).sum() < max(3, min_precision * hit.sum()) or worth(rule)[0] < 2 * min_precision - 1:
            break
        rules.append(rule)
        x, bad = x[~hit], bad[~hit]
    return rules


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and "label is 0" of up to ``max_rows`` labelled rows, in the order of a hash."""
    by_hash = F.xxhash64("_id")
    chosen = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
              .filter(F.col("_label").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id"), FOLD))
              .orderBy(by_hash, "_id", "_label").limit(max_rows))
    rows = (with_statistics(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
                            .join(F.broadcast(chosen), "_id"), "_text")
            .orderBy(by_hash, "_id", *STATISTICS, "_label").select("_label", *STATISTICS).limit(max_rows).collect())
    if not rows:
        return np.zeros((0, len(STATISTICS))), np.zeros(0, bool)
    table = np.array([tuple(r) for r in rows], float)
    return table[:, 1:], table[:, 0] == 0


def train(docs: DataFrame, labels: DataFrame, **columns) -> list[Rule]:
    return learn(*training_sample(docs, labels, **columns))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects: the list as an ordered conditional expression."""
    chain = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        condition = F.lit(True)
        for c in rule:
            condition = condition & c.column()
        chain = chain.when(condition, F.lit(False))
    return chain.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """All rows and columns, their statistics, ``base_failed`` and ``kept``."""
    return (with_statistics(_without(docs, ("base_failed", "kept")), text_col).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def select_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are kept, columns unchanged whatever their names."""
    rows = docs.select(F.struct(*docs.columns).alias(f"{_T}row"), F.col(text_col).alias(f"{_T}input"))
    return judge(rows, rules, f"{_T}input").filter("kept").select(f"{_T}row.*")
