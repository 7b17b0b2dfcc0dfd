"""Quality rules as a learned decision list over text statistics.

``text_statistics`` measures every whole text.  ``learn_rules`` fits an
ordered list of threshold conjunctions by sequential covering: a rule grows
one threshold at a time by information gain on two thirds of the labelled
rows, is pruned from its end on the other third, and is kept if it is right
there often enough; the rows it covers are taken out and the next rule is
grown.  ``rule_expression`` turns the list into one ordered Spark conditional
expression, so scoring is a projection inside whole-stage code.

Fitting uses at most ``max_labelled`` labels (those of the smallest seeded
hash of the id; only a few numbers of each reach the driver).  Verdicts cover
every row.

Defined results: a null text has no words (all statistics 0) and fails the
base rules; without labels the list is empty and only the base rules act; a
null label is no label, a document with several labels is one labelled row
each; an empty table gives an empty table; repeated rows give one result row
each; null ids stay null; other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import WORD, arrow_map

SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks", "n_text")

#: What thresholds are put on: each a share or a mean, so that it doesn't depend on the length.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "mean_word_length": ("word_chars", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, covered = 0, 0  # covered: words before this position that are counted or passed
    for k, w in enumerate(windows):
        if counts[w] > 1:
            total += k + 3 - max(k, covered)
            covered = k + 3
    return total


def statistics_of(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    seen, n_lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            n_lines += 1
            dup += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum([text.count(c) for c in SYMBOLS]),
        dup,
        repeated_words(words),
        n_lines,
        len(set(words)),
        sum([text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]),
        sum([text.count(c) for c in "0123456789"]),
        text.count("!") + text.count("?"),
        len(text),
    )


def text_statistics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts of each whole text."""

    def rows(given):
        found = [statistics_of(t or "") for t in given[text_col]]
        yield {"doc_id": given[id_col], **{c: [x[k] for x in found] for k, c in enumerate(COUNTS)}}

    return arrow_map(df, [id_col, text_col], rows, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed(prefix: str = "", *, min_words: int = 50, max_repeat_pct: int = 50) -> Column:
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < min_words) | (100 * repeated > max_repeat_pct * words)


def feature(name: str, prefix: str = "") -> Column:
    count, of = (F.col(prefix + c).cast("double") for c in FEATURES[name])
    return F.coalesce(F.try_divide(count, of), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, prefix: str = "") -> Column:
        value = feature(self.feature, prefix)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        value = table[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(table.values()))), bool)
    for c in rule:
        out &= c.holds(table)
    return out


def gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """FOIL's information gain of narrowing (p0, n0) to (p, n)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, out, -np.inf)


def best_condition(table, bad, inside) -> tuple[float, Condition | None]:
    """The threshold of highest gain among all midpoints of all features."""
    best, found = 0.0, None
    y = bad[inside]
    p0, n0 = int(y.sum()), int((~y).sum())
    for name in FEATURES:
        v = table[name][inside]
        order = np.argsort(v, kind="stable")
        v, left_p = v[order], np.cumsum(y[order])
        cut = np.flatnonzero(v[:-1] < v[1:])
        if not len(cut):
            continue
        below_p, below_n = left_p[cut], cut + 1 - left_p[cut]
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            g = gain(p.astype(float), n.astype(float), p0, n0)
            k = int(np.argmax(g))
            if g[k] > best + 1e-9:
                best, found = float(g[k]), Condition(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best, found


def precision(rule: Rule, table, bad) -> tuple[float, int]:
    inside = covers(rule, table)
    return (float((bad & inside).sum() + 1) / (inside.sum() + 2)), int((bad & inside).sum())


def cover_rules(table: dict[str, np.ndarray], bad: np.ndarray, *, max_rules: int, max_conditions: int, min_precision: float, min_cover: int, seed: int) -> list[Rule]:
    """Sequential covering of the ``bad`` rows."""
    rng = np.random.default_rng(seed)
    grow = rng.random(len(bad)) < 2 / 3
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules and (bad & left & grow).sum() >= min_cover:
        inside, rule = left & grow, ()
        while len(rule) < max_conditions and (~bad & inside).any():
            _, condition = best_condition(table, bad, inside)
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(table)
        held = left & ~grow
        part = {k: v[held] for k, v in table.items()}
        # pruned from its end while that does not make it worse on the held-out third
        while len(rule) > 1 and precision(rule[:-1], part, bad[held])[0] >= precision(rule, part, bad[held])[0]:
            rule = rule[:-1]
        right, covered = precision(rule, part, bad[held])
        if not rule or right < min_precision or covered < max(1, min_cover // 2):
            break
        rules.append(rule)
        left &= ~covers(rule, table)
    return rules


def learn_rules(
    df: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = 20_000,
    max_rules: int = 12,
    max_conditions: int = 4,
    min_precision: float = 0.9,
    min_cover: int = 8,
    seed: int = 17,
) -> list[Rule]:
    """An ordered list of rules for label 0, from the documents of at most ``max_labelled`` labels.

    The chosen labels (ids and a flag, so at most ``max_labelled`` narrow
    rows) are broadcast to the documents; only labelled texts are measured.
    """
    given = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    given = given.select(F.col(id_col).alias("_label_id"), (F.col(label_col) == 0).alias("_bad"))
    chosen = given.orderBy(F.xxhash64("_label_id", F.lit(seed)), "_label_id", "_bad").limit(max_labelled)
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
    counts = with_statistics(texts.select("_bad", "_text"), "_text").where(~base_failed())
    rows = counts.select("_bad", *[feature(f).alias(f) for f in FEATURES]).collect()
    if not rows:
        return []
    rows.sort()  # the split below must not depend on the order of arrival
    table = {f: np.array([r[f] for r in rows]) for f in FEATURES}
    return cover_rules(
        table,
        np.array([r["_bad"] for r in rows]),
        max_rules=max_rules,
        max_conditions=max_conditions,
        min_precision=min_precision,
        min_cover=min_cover,
        seed=seed,
    )


def rule_expression(rules: list[Rule], prefix: str = "") -> Column:
    """The number (from 1) of the first rule that holds, 0 if none does."""
    out = F
    for number, rule in enumerate(rules, 1):
        holds = rule[0].column(prefix)
        for c in rule[1:]:
            holds &= c.column(prefix)
        out = out.when(holds, F.lit(number))
    return out.otherwise(F.lit(0)) if rules else F.lit(0)


def judge(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``rule`` (the rule that rejects, 0 if none) and ``kept``."""
    rules = learn_rules(df, labels, id_col=id_col, text_col=text_col, **fit)
    return (
        text_statistics(df, id_col=id_col, text_col=text_col)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", rule_expression(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )


def keep_good(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """The rows of ``df`` that the rules keep, each judged by its own text in place, without a join."""
    rules = learn_rules(df, labels, id_col=id_col, text_col=text_col, **fit)
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    measured = with_statistics(df, text_col, prefix)
    return measured.where(~base_failed(prefix) & (rule_expression(rules, prefix) == 0)).select(*df.columns)


def with_statistics(df: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    """All columns of ``df`` and the counts of the text, their names after ``prefix``."""

    def rows(given):
        found = [statistics_of(t or "") for t in given[text_col]]
        yield {**given, **{prefix + c: [x[k] for x in found] for k, c in enumerate(COUNTS)}}

    ddl = df.schema.simpleString()[len("struct<") : -1]
    return arrow_map(df, df.columns, rows, f"{ddl}, " + ", ".join(f"{prefix}{c} long" for c in COUNTS))
