"""Quality rules: a decision list learned from labels, emitted as Spark conditions.

Statistics of a text (``statistics``) become integer features (``FEATURES``). Sequential
covering learns rules for bad documents from labelled ones: a rule grows by the threshold
condition with the best information gain until it covers no good document of the growing
part, is pruned on the other part, and is kept if it is precise there; what it covers is
taken out and the next rule is learned. Each rule is a conjunction of thresholds that can
be read, and the list becomes one ordered ``when`` expression.

Learning reads a bounded sample: the SAMPLE labelled documents with the smallest hashes of
their ids. Statistics and verdicts are made for every document.

Defined cases: a NULL or empty text has no words and fails; NULL doc_ids get a verdict and
are not learned from; a document labelled more than once counts with its lowest quality;
labels that are NULL or without a document are ignored; without labels of both kinds the
list is empty and only the base rules hold; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm.common import WORD, free_name, releasing, ship_package

SAMPLE = 20_000
MIN_PRECISION = 0.9  # of a rule, on the part that did not grow it
MIN_COVER = 5  # bad documents a rule covers there, at least
MAX_RULES = 12
MAX_CONDITIONS = 4
THRESHOLDS = 32  # candidate cuts per feature

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATISTICS_DDL = ", ".join(f"{name} long" for name in STATISTICS)
_SYMBOLS = re.compile(r"[#*$%&|<>]+")


def repeated_words(words: list[str]) -> int:
    """Words inside WINDOW-word windows that the text holds twice or more."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    n = len(numbers)
    if n == len(words):
        return 0
    # windows as exact numbers: pairs, pairs of pairs, and one word more
    code, width, m = ids, 1, n
    for step in (1, 2, 1):
        other = ids if step == 1 and width > 1 else code
        size = n if step == 1 else m
        joined = code[: len(code) - (step if width < 4 else 0)]
        other = other[width : width + len(joined)]
        joined = joined[: len(other)] * size + other
        width += step
        values, code = np.unique(joined, return_inverse=True)
        m = len(values)
    twice = np.bincount(code) > 1
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice[code])
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks) > 0).sum())


def text_statistics(text: str) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(len, _SYMBOLS.findall(text))),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the STATISTICS of each text; columns of these names are replaced."""
    ship_package(docs.sparkSession)
    kept = docs.drop(*STATISTICS)
    place = kept.columns.index("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_statistics(text or "") for text in batch.column(place).to_pylist()]
            columns = np.array(found, np.int64).reshape(-1, len(STATISTICS)).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(column) for column in columns)], names=[*batch.schema.names, *STATISTICS]
            )

    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, T.LongType()) for name in STATISTICS)])
    return kept.mapInArrow(releasing(measure), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


# integer features: (name, numerator, scale, denominator); the value is numerator * scale div denominator
FEATURES = (
    ("n_words", "n_words", 1, None),
    ("chars_per_100_words", "word_chars", 100, "n_words"),
    ("symbols_per_1000_chars", "n_symbols", 1000, "word_chars"),
    ("dup_lines", "n_dup_lines", 1, None),
    ("dup_lines_per_1000_words", "n_dup_lines", 1000, "n_words"),
    ("repeated_per_1000_words", "n_repeat_words", 1000, "n_words"),
)


def feature(name: str) -> Column:
    _, top, scale, bottom = next(one for one in FEATURES if one[0] == name)
    value = F.col(top) * scale
    return value if bottom is None else F.floor(value / F.greatest(F.col(bottom), F.lit(1))).cast("long")


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        value = values[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    result = np.ones(n, bool)
    for condition in rule:
        result &= condition.holds(values)
    return result


def _candidates(values: dict[str, np.ndarray]) -> list[Condition]:
    found = []
    for name, value in values.items():
        cuts = np.unique(np.quantile(value, np.linspace(0, 1, THRESHOLDS + 1), method="nearest"))
        found += [Condition(name, side, int(cut)) for cut in cuts for side in (True, False)]
    return found


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition with the most information about the bad ones, until all are bad."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        own = {name: value[inside] for name, value in values.items()}
        bad_own = bad[inside]
        best, chosen = 0.0, None
        for condition in _candidates(own):
            held = condition.holds(own)
            p1, n1 = (held & bad_own).sum(), (held & ~bad_own).sum()
            if p1 and (gain := p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))) > best:
                best, chosen = gain, condition
        if chosen is None:
            break
        rule += (chosen,)
        inside &= chosen.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule that is worth most on rows that did not grow it."""

    def worth(part: Rule) -> float:
        held = _covered(part, values, len(bad))
        p, n = (held & bad).sum(), (held & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    parts = [rule[: i + 1] for i in range(len(rule))]
    return max(parts, key=lambda part: (worth(part), -len(part))) if parts else ()


def learn(values: dict[str, np.ndarray], bad: np.ndarray, grows: np.ndarray) -> list[Rule]:
    """An ordered list of rules that cover bad rows. ``grows`` marks the growing part."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        part = {side: left & (grows == side) for side in (True, False)}
        own = {side: {name: value[rows] for name, value in values.items()} for side, rows in part.items()}
        if not (bad & part[True]).any() or not (bad & part[False]).any():
            break
        rule = _prune(_grow(own[True], bad[part[True]]), own[False], bad[part[False]])
        held = _covered(rule, own[False], int(part[False].sum()))
        p = int((held & bad[part[False]]).sum())
        if not rule or p < MIN_COVER or p < MIN_PRECISION * held.sum():
            break
        rules.append(rule)
        left &= ~_covered(rule, values, len(bad))
    return rules


def learn_from_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn from the labelled documents that the base rules keep."""
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(labels["doc_id"])
        .agg(F.min("quality").alias("__quality"))
        .orderBy(order, "doc_id")
        .limit(sample)
    )
    # at most ``sample`` pairs of numbers: small enough for every executor
    found = docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(chosen), "doc_id")
    measured = statistics(found).where(~base_failed())
    columns = [feature(name).alias(name) for name, *_ in FEATURES]
    # a repeated doc_id could bring more rows than labels, so the bound is set again
    rows = (
        measured.select("doc_id", F.col("__quality").alias("quality"), *columns).orderBy(order, *[name for name, *_ in FEATURES]).limit(sample).toPandas()
    )
    values = {name: rows[name].to_numpy() for name, *_ in FEATURES}
    bad = rows["quality"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn(values, bad, np.arange(len(rows)) % 3 != 0)


def verdict(rules: list[Rule]) -> Column:
    """True for documents to keep: the first rule that holds decides."""
    decided = F.when(base_failed(), F.lit(False))
    for rule in rules:
        whole = F.lit(True)
        for condition in rule:
            whole = whole & condition.column()
        decided = decided.when(whole, F.lit(False))
    return decided.otherwise(F.lit(True))


def describe(rules: list[Rule]) -> str:
    return "\n".join(" and ".join(map(str, rule)) + " -> drop" for rule in rules) or "(no rules)"


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept."""
    rules = learn_from_labels(docs, labels)
    return statistics(docs.select(docs["doc_id"], docs["text"])).select(
        "doc_id", *STATISTICS, base_failed().alias("base_failed"), verdict(rules).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents worth keeping, with their own columns."""
    rules = learn_from_labels(docs, labels)
    own, names = docs, {}
    for name in docs.columns:
        if name.lower() in STATISTICS:
            names[name] = free_name(own, f"__{name}")
            own = own.withColumnRenamed(name, names[name])
    return statistics(own).where(verdict(rules)).drop(*STATISTICS).withColumnsRenamed({v: k for k, v in names.items()})
