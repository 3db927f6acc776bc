"""Mixing sources to target weights: budgets down a domain-language-source tree, and a seeded token-prefix for each leaf.

A node's budget is shared among its children by their weights, none taking more than its subtree can give
(its tokens times the allowed epochs). What a child cannot take goes to its siblings; as a subtree's capacity counts all
its leaves, a shortage leaves the parent only when all siblings are full. Shares are whole numbers of tokens
and add up exactly; ties and remainders go by name.

A leaf reads its documents in epochs, each in an order of its own that a seeded hash gives. Its budget buys whole
epochs and then a prefix of the next: the documents before which fewer tokens than the rest of the budget lie.
That prefix ends at one hash value, so placing a document needs the leaf's row only. The value is found from sums over
hash ranges; only the one range per leaf in which the prefix ends is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, aside, written

LEVELS = ["domain", "lang", "source"]
BUCKET_BITS = 12


@dataclass(frozen=True)
class Mixture:
    """Weights by level and name, others weighing `other`; the share of all tokens wanted; epochs allowed; the seed."""

    domains: dict[int, str]  # by the number that ends a source's name, modulo their count
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    other: int = 1
    parts: int = 3  # the total budget is parts / whole of all tokens
    whole: int = 5
    epochs: int = 2
    seed: int = 42

    def domain(self) -> Column:
        digits = F.regexp_extract(F.coalesce(F.col("source").cast("string"), F.lit("")), r"(\d{1,9})$", 1)
        number = F.pmod(F.when(digits != "", digits.cast("int")), F.lit(len(self.domains)))
        out = None
        for n, name in self.domains.items():
            out = (F if out is None else out).when(number == n, F.lit(name))
        return out.otherwise(F.lit("other"))

    def weight(self, level: str) -> Column:
        out = None
        for name, w in self.weights.get(level, {}).items():
            out = (F if out is None else out).when(F.col(level) == name, F.lit(w))
        return F.lit(self.other).cast("long") if out is None else out.otherwise(F.lit(self.other)).cast("long")


def leaves_of(mixture: Mixture) -> list[Column]:
    """The three levels of a document; a null name counts as an empty one."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return [mixture.domain().alias("domain"), name("lang").alias("lang"), name("source").alias("source")]


def place_in_epoch(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A 60-bit number by which an epoch orders its documents; documents of one id share a place."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def fill(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """`nodes` (parents, name, cap, weight, wanted: the parent's budget) with `budget`, exact to the token."""
    big = "decimal(38,0)"
    per = Window.partitionBy(*[F.col(p) for p in parents] or [F.lit(0)])
    order = per.orderBy("ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = nodes.withColumn(
        "ratio", F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).otherwise(F.lit(float("inf")))
    )
    sums = sums.withColumns(
        {
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(per) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # In this order the nodes that get all they can give come first.
    full = F.col("cap").cast(big) * F.col("weight_left") <= F.col("weight").cast(big) * (F.col("wanted") - F.col("cap_before"))
    sums = sums.withColumn("full", full)
    sums = sums.withColumns(
        {
            "rest": F.col("wanted") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(per), F.lit(0)),
            "rest_weight": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(per), F.lit(0)),
            "rank": F.sum(F.when(~F.col("full") & (F.col("weight") > 0), 1).otherwise(0)).over(order),
        }
    )
    share = F.expr("case when rest_weight > 0 then (cast(weight as decimal(38,0)) * rest) div rest_weight else 0 end")
    sums = sums.withColumn("share", F.when(F.col("full"), F.lit(0)).otherwise(share).cast("long"))
    over = F.col("rest") - F.sum("share").over(per)
    extra = F.when((F.col("rest_weight") > 0) & (F.col("weight") > 0) & (F.col("rank") <= over), 1).otherwise(0)
    return sums.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.col("share") + extra).cast("long")).drop(
        "ratio", "cap_before", "weight_left", "full", "rest", "rest_weight", "rank", "share"
    )


def budgets(leaf_tokens: DataFrame, mixture: Mixture) -> DataFrame:
    """`domain`, `lang`, `source`, `tokens`, `budget` of each leaf."""
    leaves = leaf_tokens.withColumn("cap", F.col("tokens") * F.lit(mixture.epochs))
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {mixture.parts} div {mixture.whole}").cast("long").alias("wanted"))
    held = total.withColumn("all", F.lit(0))
    parents: list[str] = []
    for level in LEVELS:
        keys = [*parents, level]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", mixture.weight(level))
        nodes = nodes.withColumn("all", F.lit(0)).join(held, parents or ["all"]).drop("all")
        filled = fill(nodes, parents, level)
        held = filled.select(*keys, F.col("budget").alias("wanted"))
        parents = keys
    return filled.select(*LEVELS, "tokens", "budget")


def plan(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """A stored row per leaf: `tokens`, `budget`, `epochs` (whole ones) and `cut`, the last place of the prefix, null for none."""
    tokens = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    thin = written(
        docs.select(*leaves_of(mixture), F.col("doc_id").cast("long").alias("doc_id"), tokens.alias("tokens")), "tokens"
    )
    leaf_tokens = thin.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    bought = budgets(leaf_tokens, mixture)
    epochs = F.expr("case when tokens > 0 then budget div tokens else 0 end").cast("long")
    bought = bought.withColumn("epochs", epochs)
    bought = written(bought.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "budgets")
    open_ = bought.where("rest > 0").select(*LEVELS, "epochs", "rest")
    placed = thin.join(open_, LEVELS).withColumn("at", place_in_epoch(mixture.seed, F.col("epochs"), F.col("doc_id")))
    placed = placed.withColumn("bucket", F.shiftright("at", 60 - BUCKET_BITS))
    ranges = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("held"), F.max("at").alias("top"), F.max("rest").alias("rest"))
    earlier = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = written(ranges.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0))), "ranges")
    inside = ranges.where("before + held < rest").select(*LEVELS, "top")
    crossing = ranges.where("before < rest and before + held >= rest").select(*LEVELS, "bucket", "before")
    sooner = Window.partitionBy(*LEVELS, "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    last = placed.join(crossing, [*LEVELS, "bucket"]).withColumn(
        "start", F.col("before") + F.coalesce(F.sum("tokens").over(sooner), F.lit(0))
    )
    last = last.where("start < rest").select(*LEVELS, F.col("at").alias("top"))
    cuts = inside.unionAll(last).groupBy(*LEVELS).agg(F.max("top").alias("cut"))
    return written(bought.join(cuts, LEVELS, "left").select(*LEVELS, "tokens", "budget", "epochs", "cut"), "mixture")


def copies(mixture: Mixture) -> Column:
    """How often a document is taken, from its leaf's row (prefixed with _) and its id."""
    at = place_in_epoch(mixture.seed, F.col("_epochs"), F.col("doc_id").cast("long"))
    return (F.col("_epochs") + F.when(at <= F.col("_cut"), 1).otherwise(0)).cast("int")


def _with_leaf(docs: DataFrame, leaf_rows: DataFrame, mixture: Mixture) -> DataFrame:
    rows = leaf_rows.select(*[F.col(c).alias(f"_{c}") for c in leaf_rows.columns])
    marked = docs.withColumns({f"_own_{level}": c for level, c in zip(LEVELS, leaves_of(mixture), strict=True)})
    match = [F.col(f"_own_{level}") == F.col(f"_{level}") for level in LEVELS]
    return marked.join(rows, match).withColumn("_copies", copies(mixture))


def mixed(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """`doc_id`, `domain`, `lang`, `source`, the leaf's `leaf_tokens` and `budget`, and `copies` of every document."""
    thin = docs.select("doc_id", "lang", "source")
    return _with_leaf(thin, plan(docs, mixture), mixture).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(f"_own_{level}").alias(level) for level in LEVELS],
        F.col("_tokens").alias("leaf_tokens"),
        F.col("_budget").alias("budget"),
        F.col("_copies").alias("copies"),
    )


def take(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """The documents as often as the mixture takes them, with all their columns."""
    held, back = aside(docs, "doc_id", "text", "lang", "source")
    chosen = _with_leaf(held, plan(docs, mixture), mixture).where("_copies > 0")
    if mixture.epochs > 1:
        chosen = chosen.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return chosen.select(*held.columns).withColumnsRenamed(back)


def sql(mixture: Mixture) -> str:
    """What `mixed` gives, as SQL over the table documents."""
    cases = lambda column, names: "".join(f" WHEN {column} = {k!r} THEN {v!r}" for k, v in names.items())
    number = f"TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1), '') AS INT) % {len(mixture.domains)}"
    parts = [
        f"""docs AS (SELECT doc_id, CASE{cases(number, mixture.domains)} ELSE 'other' END AS domain,
            coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens FROM documents)""",
        f"leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {mixture.epochs} AS cap FROM docs GROUP BY ALL)",
        f"b0 AS (SELECT coalesce(sum(tokens), 0) * {mixture.parts} // {mixture.whole} AS wanted FROM leaves)",
    ]
    keys: list[str] = []
    for n, level in enumerate(LEVELS):
        parent, keys = list(keys), [*keys, level]
        weights = mixture.weights.get(level, {})
        weight = f"CASE{cases(level, weights)} ELSE {mixture.other} END" if weights else str(mixture.other)
        per = f"PARTITION BY {', '.join(parent)}" if parent else ""
        join = f"JOIN b{n} USING ({', '.join(parent)})" if parent else f"CROSS JOIN b{n}"
        listed = ", ".join(keys)
        parts += [
            f"n{n} AS (SELECT {listed}, sum(cap) AS cap, sum(tokens) AS tokens, ({weight})::HUGEINT AS weight FROM leaves GROUP BY {listed})",
            f"o{n} AS (SELECT *, CASE WHEN weight > 0 THEN cap::DOUBLE / weight ELSE 'inf'::DOUBLE END AS ratio FROM n{n} {join})",
            f"""s{n} AS (SELECT *, cap * (sum(weight) OVER ({per}) - coalesce(sum(weight) OVER w, 0))
                <= weight * (wanted - coalesce(sum(cap) OVER w, 0)) AS filled FROM o{n}
                WINDOW w AS ({per} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
            f"""r{n} AS (SELECT *, wanted - coalesce(sum(CASE WHEN filled THEN cap END) OVER ({per}), 0) AS rest,
                coalesce(sum(CASE WHEN NOT filled THEN weight END) OVER ({per}), 0) AS rest_weight,
                sum(CASE WHEN NOT filled AND weight > 0 THEN 1 ELSE 0 END) OVER ({per} ORDER BY ratio, {level}) AS pos FROM s{n})""",
            f"h{n} AS (SELECT *, CASE WHEN filled OR rest_weight = 0 THEN 0 ELSE (weight * rest) // rest_weight END AS share FROM r{n})",
            f"""b{n + 1} AS (SELECT {listed}, tokens, (CASE WHEN filled THEN cap ELSE share + CASE WHEN rest_weight > 0 AND weight > 0
                AND pos <= rest - sum(share) OVER ({per}) THEN 1 ELSE 0 END END)::HUGEINT AS wanted FROM h{n})""".replace(
                "tokens, (CASE", "tokens, (CASE" if n == len(LEVELS) - 1 else "(CASE"
            ),
        ]
    parts += [
        f"bought AS (SELECT domain, lang, source, tokens AS leaf_tokens, wanted AS budget, CASE WHEN tokens > 0 THEN wanted // tokens ELSE 0 END AS epochs FROM b{len(LEVELS)})",
        f"""placed AS (SELECT *, budget - epochs * leaf_tokens AS rest,
            ('0x' || substr(md5('{mixture.seed}:' || epochs || coalesce(':' || doc_id, '')), 1, 15))::BIGINT AS spot
            FROM docs JOIN bought USING (domain, lang, source))""",
        """started AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY spot
            RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM placed)""",
    ]
    return (
        "WITH "
        + ",\n".join(parts)
        + "\nSELECT doc_id, domain, lang, source, leaf_tokens::BIGINT AS leaf_tokens, budget::BIGINT AS budget, "
        + "(epochs + CASE WHEN start < rest THEN 1 ELSE 0 END)::INT AS copies FROM started"
    )
