"""Quality rules as a learned decision list over document statistics. DataFrame functions only.

The statistics are column expressions over the text. From labelled statistics, sequential covering learns rules one by
one: a rule grows by the threshold condition with the best information gain until it covers no good document,
is pruned back to the conditions that pay on rows it was not grown on, and is kept if it is precise there; the rows
it covers are then left out and the next rule is learned, over thresholds of what is left. The first rule that is not
precise, or covers too little, ends the list, which becomes an ordered conditional
expression that rejects a document at the first rule it meets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import aside, label_sample, sampled_texts, written

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
TRAIN_ROWS = 4000  # labelled documents of each class at most
# Quantiles of both classes that serve as thresholds, down to the least and the largest value.
TAIL = [0.0, 0.001, 0.002, 0.005, 0.01, 0.02]
STEPS = [*TAIL, *(i / 20 for i in range(1, 20)), *(1 - q for q in reversed(TAIL))]
LEAST_PRECISION, LEAST_COVER = 0.9, 3
SEED = 31
FEATURES = ("symbol_share", "mark_share", "dup_line_share", "repeat_share", "word_length", "words_per_line", "n_words")


def without(text: Column, marks: str) -> Column:
    return reduce(lambda c, mark: F.replace(c, F.lit(mark), F.lit("")), marks, text)


def _count(text: Column, marks: str) -> Column:
    """How many of these one-byte characters a text has."""
    return (F.octet_length(text) - F.octet_length(without(text, marks))).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """`docs` with a struct `_s` of the statistics of its `text`; a null text has no words and no lines.

    Windows of three words are compared by 64-bit hashes within a text. A text without a window that
    occurs twice, the usual case, needs no sorting.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    longs = "array<bigint>"
    step = docs.withColumn("_t", text)
    trimmed = F.btrim("_t", F.lit(SPACES))
    step = step.withColumn("_w", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+")))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    step = step.withColumn("_l", lines)
    window = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
    )
    step = step.withColumn("_h", F.when(F.size("_w") >= 3, window).otherwise(F.array().cast(longs)))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    placed = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_p", F.when(repeats, placed))
    same = F.filter(
        "_p",
        lambda x, k: F.coalesce(F.get("_p", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_p", k + 1)["h"] == x["h"], F.lit(False)),
    )
    step = step.withColumn("_r", F.array_sort(F.transform(same, lambda x: x["i"])))
    covered = F.transform("_r", lambda x, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), x - F.get("_r", k - 1))))
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    struct = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        (F.char_length("_t") - _count(F.col("_t"), SPACES)).cast("long").alias("word_chars"),
        _count(F.col("_t"), SYMBOLS).alias("n_symbols"),
        _count(F.col("_t"), "!").alias("n_marks"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"),
    )
    # A generator of one row: filters on the statistics stay above it, and do not work them out a second time.
    return step.select(*docs.columns, F.explode(F.array(struct)).alias("_s"))


def base_failed() -> Column:
    n = F.col("_s.n_words")
    return (n < 50) | (100 * F.col("_s.n_repeat_words") > 50 * n)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(f"_s.{part}"), F.col(f"_s.{whole}")), F.lit(0.0)).cast("double")


def feature(name: str) -> Column:
    """What rules look at, from the struct of statistics; shares of nothing are 0."""
    return {
        "symbol_share": _share("n_symbols", "word_chars"),
        "mark_share": _share("n_marks", "word_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "word_length": _share("word_chars", "n_words"),
        "words_per_line": _share("n_words", "n_lines"),
        "n_words": F.col("_s.n_words").cast("double"),
    }[name]


@dataclass(frozen=True)
class Condition:
    """feature > threshold, or feature <= threshold."""

    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.name)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def verdict(rules: list[Rule]) -> Column:
    """True if a document is kept: an ordered conditional over the rules, the first that holds rejects."""
    out = None
    for rule in rules:
        holds = reduce(lambda a, b: a & b, (c.column() for c in rule))
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each feature in both classes, over those of the bounded training rows that are left."""
    asked = [
        F.percentile(F.when(F.col("label") == kind, F.col(f)), F.lit(STEPS)).alias(f"{f}{kind}") for f in FEATURES for kind in (0, 1)
    ]
    got = rows.agg(*asked).first()
    return {f: sorted({v for kind in (0, 1) for v in (got[f"{f}{kind}"] or []) if v is not None}) for f in FEATURES}


def _holds(rule: Rule) -> Column:
    parts = [F.col(c.name) > F.lit(c.threshold) if c.above else F.col(c.name) <= F.lit(c.threshold) for c in rule]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _below(cuts: list[float], value: Column) -> Column:
    """How many of the thresholds lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < value))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Adds the condition of the best gain until no good row is covered, or none gains."""
    rule: Rule = ()
    while True:
        # A row lies in one bin of each feature: the number of thresholds below its value.
        bins = [
            F.struct(
                F.lit(f).alias("f"),
                _below(cuts[f], F.col(f)).alias("bin"),
            )
            for f in FEATURES
            if cuts[f]
        ]
        if not bins:
            return rule
        counted = (
            rows.where(_holds(rule)).select("label", F.explode(F.array(*bins)).alias("b")).groupBy("b.f", "b.bin", "label").count()
        )
        counts: dict[str, list[list[int]]] = {f: [[0, 0] for _ in range(len(cuts[f]) + 1)] for f in FEATURES}
        for r in counted.collect():  # at most features x bins x 2 rows
            counts[r["f"]][r["bin"]][r["label"]] = r["count"]
        some = next(f for f in FEATURES if cuts[f])
        bad, good = (sum(b[k] for b in counts[some]) for k in (0, 1))
        if not good or not bad:
            return rule
        best, gained = None, 1e-9
        for f in FEATURES:
            low = [0, 0]
            for at, cut in enumerate(cuts[f]):
                low = [low[k] + counts[f][at][k] for k in (0, 1)]
                for above, (p, n) in ((False, low), (True, [bad - low[0], good - low[1]])):
                    if p:
                        gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                        if gain > gained:
                            best, gained = Condition(f, above, cut), gain
        if best is None:
            return rule
        rule = (*rule, best)


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The leading part of the rule that is worth most on rows it was not grown on, with what it covers there."""
    asked = []
    for k in range(1, len(rule) + 1):
        for kind in (0, 1):
            asked.append(F.count_if(_holds(rule[:k]) & (F.col("label") == kind)).alias(f"c{k}_{kind}"))
    got = rows.agg(*asked).first()
    best = max(range(1, len(rule) + 1), key=lambda k: ((got[f"c{k}_0"] - got[f"c{k}_1"]) / max(1, got[f"c{k}_0"] + got[f"c{k}_1"]), got[f"c{k}_0"], -k))
    return rule[:best], got[f"c{best}_0"], got[f"c{best}_1"]


def learn(labelled: DataFrame) -> list[Rule]:
    """The decision list for rows with `label` (0: reject), `doc_id` and `_s`; rows that fail the base rules take no part."""
    rows = written(
        labelled.where(~base_failed()).select(
            "label",
            (F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(3)) == 2).alias("apart"),
            *[feature(f).alias(f) for f in FEATURES],
        ),
        "labelled-statistics",
    )
    left, rules = rows, []
    while True:
        grown_on = left.where(~F.col("apart"))
        rule = _grow(grown_on, _thresholds(grown_on))
        if not rule:
            return rules
        rule, bad, good = _prune(left.where("apart"), rule)
        if bad < LEAST_COVER or bad < LEAST_PRECISION * (bad + good):
            return rules
        rules.append(rule)
        left = left.where(~_holds(rule))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learns on at most `rows` documents of each class; the bounded list of their ids is broadcast."""
    ids = label_sample(docs, labels, "quality", rows, F.lit(True), SEED)
    return learn(statistics(sampled_texts(docs, ids)))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, the statistics, `base_failed` and `kept` of every document."""
    rules = train(docs, labels)
    out = statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select(
        "doc_id",
        *[F.col(f"_s.{n}").alias(n) for n in names],
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )


def keep_passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rules and the list, with all their columns."""
    rules = train(docs, labels)
    held, back = aside(docs, "text")
    kept = statistics(held).where(~base_failed() & verdict(rules))
    return kept.select(*held.columns).withColumnsRenamed(back)
