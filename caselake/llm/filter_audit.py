"""How corpus filters interact: what each removes in every order, and its exact Shapley share.

Every document gets a mask of the filters it fails. Rows are summed by part and mask, so an audit of five
filters needs at most 32 numbers a part, however many documents there are. From them follows, for each of the
32 coalitions, what it removes. Step counts of an order are differences of two coalitions. Shapley values
come from least squares: minimise the sum over coalitions S of w(S) * (v(S) - sum of the values in S)^2, with
w the Shapley kernel, under the condition that all values add up to v(all). The matrix of its normal equations
does not depend on the data, so it is inverted once, in rationals, and applied to the coalition table
as whole numbers.

Null texts count as empty. Rows of one doc_id each count; a repeated doc_id is not smaller than itself. A null
doc_id is neither smaller nor greater than another, so its row is no copy and makes none. Labels repeated for a
doc_id count once, as 1 if any row says so; documents without label are neither good nor toxic. A null or
empty part is the empty string; an empty table gives no rows. Other columns are not read. Texts are
compared by SHA-256.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from math import comb, factorial

from pyspark.sql import Column, DataFrame, functions as F

WORD_BORDER = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = r"[#$%&*|]"
COPIES = "E"


def words_of(text: Column) -> Column:
    """Maximal runs of other characters than blanks, in order."""
    return F.filter(F.split(text, WORD_BORDER), lambda w: w != "")


# Filter to its failure condition over ``text`` and ``words``; ``COPIES`` compares documents and is added by ``failures``.
TESTS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < LEAST_WORDS,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text),
    "D": lambda text, words: text.rlike(SYMBOLS),
}


def coalition_weights(n: int) -> list[dict[int, Fraction]]:
    """For each of ``n`` players, the share of v(S) in its Shapley value, by coalition as a bit mask; v(0) is 0.

    The solution of the constrained normal equations, [A 1; 1' 0] [values; multiplier] = [b; v(all)], with
    A and b summed over the coalitions between none and all by the kernel (n - 1) / (C(n, s) s (n - s)).
    """
    full = (1 << n) - 1
    if n == 1:
        return [{1: Fraction(1)}]
    kernel = {s: Fraction(n - 1, comb(n, k := s.bit_count()) * k * (n - k)) for s in range(1, full)}
    matrix = [[sum((w for s, w in kernel.items() if s >> i & s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    inverse = _inverse([*matrix, [Fraction(1)] * n + [Fraction(0)]])
    return [
        {s: w * sum(inverse[i][j] for j in range(n) if s >> j & 1) for s, w in kernel.items()} | {full: inverse[i][n]}
        for i in range(n)
    ]


def _inverse(matrix: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination without rounding."""
    size = len(matrix)
    rows = [[*row, *(Fraction(i == j) for j in range(size))] for i, row in enumerate(matrix)]
    for k in range(size):
        pivot = next(i for i in range(k, size) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(size):
            if i != k and (factor := rows[i][k]):
                rows[i] = [x - factor * y for x, y in zip(rows[i], rows[k])]
    return [row[size:] for row in rows]


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang", tests: dict = TESTS, copies: str | None = COPIES) -> DataFrame:
    """Documents by (part, mask, good, toxic): ``n``. Bit i of the mask: the document fails filter i; copies are the last one.

    Only ids, flags and hashes move. Copies of one text are summed before they meet, so a text that a third of
    the documents share is a few rows a task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), text.alias("_text"))
    words = words.withColumn("_words", words_of(F.col("_text")))
    mask = sum((F.when(test(F.col("_text"), F.col("_words")), 1 << i).otherwise(0) for i, test in enumerate(tests.values())), F.lit(0))
    marked = words.select("_id", "_part", mask.alias("_mask"), *([F.unhex(F.sha2("_text", 256)).alias("_sum")] if copies else []))
    known = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    told = marked.join(known, "_id", "left").fillna(False, ["_good", "_toxic"])
    keys = ["_part", "_mask", "_good", "_toxic"]
    if not copies:
        return _named(told.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    # The first of a group's ids comes with its number of rows; rows without id stay apart.
    single = told.groupBy("_id", "_sum", *keys).agg(F.count(F.lit(1)).alias("n"))
    groups = single.groupBy("_sum", *keys).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("_id").isNull(), F.col("n")).otherwise(0)).alias("_unnamed"),
        F.min(F.when(F.col("_id").isNotNull(), F.struct(F.col("_id").alias("id"), "n"))).alias("_first"),
    )
    sums = groups.groupBy("_sum").agg(F.min("_first.id").alias("_least"), F.collect_list(F.struct(*keys, "n", "_unnamed", "_first")).alias("_groups"))
    each = sums.select("_least", F.inline("_groups"))
    spared = F.col("_unnamed") + F.when(F.col("_first.id") == F.col("_least"), F.col("_first.n")).otherwise(0)
    bit = 1 << len(tests)
    split = each.select(*keys, F.inline(F.array(
        F.struct(F.lit(0).alias("_bit"), spared.alias("k")), F.struct(F.lit(bit).alias("_bit"), (F.col("n") - spared).alias("k")))))
    return _named(split.where("k > 0").groupBy("_part", (F.col("_mask") + F.col("_bit")).alias("_mask"), "_good", "_toxic").agg(F.sum("k").alias("n")))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"_part": "part", "_mask": "mask", "_good": "good", "_toxic": "toxic"})


def coalitions(counts: DataFrame, n: int) -> DataFrame:
    """Per part: ``all`` documents and ``at``, a map from coalition to what it removes (removed, good, toxic)."""
    size = F.col("n").cast("long")
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0

    def removed(condition: Column) -> Column:
        return F.sum(F.when(condition, size).otherwise(0))

    table = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1)))).groupBy("part", "coalition").agg(
        F.sum(size).alias("all"), removed(hit).alias("removed"), removed(hit & F.col("good")).alias("good"), removed(hit & F.col("toxic")).alias("toxic"))
    return table.groupBy("part").agg(
        F.max("all").alias("all"),
        F.map_from_entries(F.collect_list(F.struct("coalition", F.struct("removed", "good", "toxic")))).alias("at"))


def orders(rows: DataFrame, names: list[str]) -> DataFrame:
    """Every row once with each order of the filters, as text."""
    rows = rows.withColumn("filter_order", F.lit(""))
    for _ in names:
        rest = F.filter(F.array(*map(F.lit, names)), lambda name: ~F.contains(F.col("filter_order"), name))
        rows = rows.withColumn("_next", F.explode(rest)).withColumn("filter_order", F.concat("filter_order", "_next")).drop("_next")
    return rows


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", tests: dict = TESTS, copies: str | None = COPIES) -> DataFrame:
    """One row per part, order and step, with the counts of that step. Filter names are single letters."""
    names = [*tests, *([copies] if copies else [])]
    n, full = len(names), (1 << len(names)) - 1
    table = coalitions(failures(docs, labels, part, tests, copies), n)
    scale = factorial(n)
    shares = []
    for weights in coalition_weights(n):
        whole = {s: int(w * scale) for s, w in weights.items() if w}
        assert all(Fraction(k, scale) == weights[s] for s, k in whole.items())
        shares.append(sum((F.lit(k) * F.col("at")[s]["removed"] for s, k in whole.items()), F.lit(0).cast("long")))
    table = table.withColumn("_shares", F.array(*shares))
    steps = orders(table, names).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))

    def mask(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(name)), 1 << i).otherwise(0) for i, name in enumerate(names)), F.lit(0))

    steps = steps.withColumns({
        "filter": F.substring("filter_order", F.col("step"), F.lit(1)), "_before": mask(F.substring("filter_order", F.lit(1), F.col("step") - 1))})
    steps = steps.withColumn("_bit", mask(F.col("filter")))
    at = F.col("at")
    before, after, alone = at[F.col("_before")], at[F.col("_before") + F.col("_bit")], at[F.col("_bit")]
    gone = after["removed"] - before["removed"]
    place = F.array_position(F.array(*map(F.lit, names)), F.col("filter")).cast("int")
    return steps.select(
        "part", "filter_order", "step", "filter", (F.col("all") - after["removed"]).alias("kept"), gone.alias("removed"),
        (alone["removed"] - gone).alias("redundant"), (at[full]["removed"] - at[F.lit(full) - F.col("_bit")]["removed"]).alias("unique_fails"),
        (after["good"] - before["good"]).alias("good_lost"), (after["toxic"] - before["toxic"]).alias("toxic_lost"),
        F.element_at("_shares", place).alias("shapley"),
    )


def coalition_table(counts: DataFrame, names: list[str]) -> DataFrame:
    """The tabulated coalitions for reading: part, letters of the coalition, and what it removes."""
    rows = coalitions(counts, len(names)).select("part", "all", F.explode("at").alias("mask", "gone"))
    letters = F.concat(*(F.when(F.col("mask").bitwiseAND(1 << i) != 0, name).otherwise("") for i, name in enumerate(names)))
    return rows.select("part", letters.alias("coalition"), "all", "gone.*")

