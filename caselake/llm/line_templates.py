"""Recurring line templates, found with a fixed-depth tree.

A line's tokens are generalised by kind: tokens with a digit, addresses and links become one placeholder. The
tree's levels are the number of tokens, then the ``DEPTH`` leading tokens; a leaf holds templates. Lines of
``LEAST_TOKENS`` and more also stand for the templates in which one token behind the leading ones is variable, so that
a line that differs in one name falls into the same template, however long it is.

Lines that differ in one token have one half in common, so a line is first known by itself and its two halves. Only
where a half stands in ``min_docs`` lines, not all the same, are the templates with a variable token in the other half
written down: no other such template can recur, or all its lines are equal and recur as they are.

A template recurs if at least ``min_docs`` different documents have it, wherever it stands in them. Copies of one
document count once: a document is known by its rarest lines, those that the fewest documents have. Its lines are
dropped everywhere. A document that would lose more than half its characters keeps the lines of templates with a
variable word; if that is not enough, it is a copy or a form and stays whole.

Null texts stay null; lines with fewer than two tokens are no templates; rows with the same doc_id and text are treated
alike; an empty table gives no rows; other columns pass unchanged, but n_lines and n_dropped are replaced by the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselake.llm.store import field, others, write_out

DEPTH = 3
LEAST_TOKENS = 5
MIN_DOCS = 8
ANY = "<*>"
BLANKS = "\t\u000b\f\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _xor(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))


def _tokens(line: Column) -> Column:
    """Hashes of a line's tokens with their places; tokens with a digit, an address or a link are variable."""
    tokens = F.filter(F.split(line, " "), lambda t: t != "")
    variable = lambda t: t.rlike("[0-9@]") | (t.contains("://") & (F.instr(F.substring(t, 2, 1 << 30), "://") > 0))
    masked = F.transform(tokens, lambda t, i: F.xxhash64(F.when(variable(t), F.lit(ANY)).otherwise(t), i))
    return F.when(line.rlike("[0-9@]|://"), masked).otherwise(F.transform(tokens, lambda t, i: F.xxhash64(t, i)))


def _plain(text: Column) -> Column:
    plain = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return plain


# Levels of the tree: number of tokens, leading tokens. A template is a hash of its branch and of its other tokens; the
# tokens carry their places, so they are joined by exclusive or, and without one of them is the number without it.
def _branch() -> Column:
    return F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH))


def _cut() -> Column:
    """Where a line's back begins; its front lies between the leading tokens and here."""
    return F.greatest(F.lit(DEPTH), F.lit(DEPTH) + F.shiftright(F.size("tokens") - DEPTH, 1))


def occurrences(docs: DataFrame) -> DataFrame:
    """(key, line, raws, whole, front, back): a line's number, its template without a variable word, and its halves behind
    the leading tokens (null for lines of fewer than ``LEAST_TOKENS``).

    The first line of a document also has the hashes of the document's distinct lines as they are (``raws``).
    A line's tokens are hashed once, each with its place. Tokens are tested one by one, as a pattern over a
    whole line tries every start in it.
    """
    text = F.col("text").cast("string")
    split = F.split(_plain(text), "\n")
    raws = F.array_remove(F.array_distinct(F.transform(split, lambda t: F.xxhash64(F.trim(t)))), F.xxhash64(F.lit("")))
    rows = docs.select(F.xxhash64("doc_id", text).alias("key"), raws.alias("raws"), F.transform(split, _tokens).alias("lines"))
    rows = rows.select("key", F.explode_outer(F.transform("lines", lambda t, i: F.struct(
        i.alias("line"), F.when(i == 0, F.col("raws")).alias("raws"), t.alias("tokens")))).alias("l"))
    lines = rows.select("key", "l.*").where((F.size("tokens") > 1) | F.col("raws").isNotNull())
    lines = lines.select("key", "line", "raws", F.size("tokens").alias("size"), _branch().alias("branch"),
                         _xor(F.slice("tokens", DEPTH + 1, _cut() - DEPTH)).alias("front"),
                         _xor(F.slice("tokens", _cut() + 1, F.size("tokens"))).alias("back"))
    varies = F.col("size") >= LEAST_TOKENS
    return lines.select("key", "line", "raws", F.when(F.col("size") > 1, F.xxhash64("branch", F.col("front").bitwiseXOR(F.col("back")))).alias("whole"),
                        F.when(varies, F.xxhash64("branch", F.lit("front"), "front")).alias("front"),
                        F.when(varies, F.xxhash64("branch", F.lit("back"), "back")).alias("back"))


def open_lines(found: DataFrame, min_docs: int) -> DataFrame:
    """(key, open): each document's lines whose front or back is shared by ``min_docs`` lines that are not all equal."""
    halves = found.where("front IS NOT NULL").select("key", "line", "whole", F.explode(F.array("front", "back")).alias("half"), "front")
    shared = halves.groupBy("half").agg(F.count("*").alias("n"), (F.min("whole") < F.max("whole")).alias("differ"))
    shared = shared.where((F.col("n") >= min_docs) & F.col("differ")).select("half")
    lines = halves.join(shared, "half").groupBy("key", "line").agg(
        F.max(F.col("half") == F.col("front")).alias("front"), F.max(F.col("half") != F.col("front")).alias("back"))
    return lines.groupBy("key").agg(F.collect_list(F.struct("line", "front", "back")).alias("open"))


def varied(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(key, line, template): templates with one variable token of the given lines, behind their front or before their back."""
    text = F.col("text").cast("string")
    # The keys alone are small, so that only texts with such lines are shuffled where the lines are not.
    keys, _ = write_out(lines.select("key"), "open-keys")
    rows = docs.select(F.xxhash64("doc_id", text).alias("key"), text.alias("text")).join(keys, "key", "left_semi").join(lines, "key")
    rows = rows.select("key", "open", F.split(_plain(F.col("text")), "\n").alias("split"))
    rows = rows.select("key", F.explode(F.transform("open", lambda o: F.struct(
        o["line"].alias("line"), o["front"].alias("front"), o["back"].alias("back"), _tokens(F.get("split", o["line"])).alias("tokens")))).alias("l"))
    rows = rows.select("key", "l.*").select("key", "line", "tokens", _branch().alias("branch"), _xor(F.col("tokens")).alias("all"),
                                            F.when(F.col("back"), F.lit(DEPTH)).otherwise(_cut()).alias("low"),
                                            F.when(F.col("front"), F.size("tokens") - 1).otherwise(_cut() - 1).alias("high"))
    templates = F.transform(F.sequence("low", "high"), lambda i: F.xxhash64("branch", F.lit(ANY), i, F.col("all").bitwiseXOR(F.get("tokens", i))))
    return rows.select("key", "line", F.explode(templates).alias("template"))


def identities(found: DataFrame) -> DataFrame:
    """(key, identity): a hash of the document's rarest lines, equal for copies of one document."""
    lines = found.where("raws IS NOT NULL").select("key", F.explode("raws").alias("raw"))
    counts = lines.groupBy("raw").agg(F.count("*").alias("n")).where("n > 1")
    rare = lines.join(counts, "raw", "left").groupBy("key", F.coalesce("n", F.lit(1)).alias("n")).agg(
        F.array_sort(F.collect_set("raw")).alias("raws"))
    return rare.groupBy("key").agg(F.xxhash64(F.min_by("raws", "n")).alias("identity"))


def recurring(hits: DataFrame, known: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Templates of ``hits`` (key, template) that ``min_docs`` documents of different identity have."""
    each = hits.select("template", "key").distinct().join(known, "key").select("template", "identity").distinct()
    return each.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("template")


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, counts: bool = True) -> DataFrame:
    """``docs`` with the text without recurring lines, and with ``n_lines`` and ``n_dropped``; or only with its own columns."""
    found, _ = write_out(occurrences(docs), "lines")
    some, _ = write_out(open_lines(found, min_docs), "open-lines")
    each = found.where("whole IS NOT NULL").select("key", "line", F.lit(True).alias("sure"), F.col("whole").alias("template"))
    each = each.union(varied(docs, some).select("key", "line", F.lit(False), "template"))
    # Templates that occur less often than min_docs cannot recur; only the others meet the documents' identities.
    often = each.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("template")
    often, _ = write_out(each.join(often, "template").select("key", "line", "sure", "template"), "often")
    hits = often.join(recurring(often, identities(found), min_docs), "template").select("key", "line", "sure")
    gone = hits.groupBy(F.col("key").alias("_key")).agg(F.collect_set("line").alias("_gone"), F.collect_set(F.when(F.col("sure"), F.col("line"))).alias("_sure"))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*map(field, docs.columns)).alias("row"), text.alias("text"), F.xxhash64("doc_id", text).alias("_key"))
    rows = rows.join(gone, "_key", "left").select("row", "text", "_gone", "_sure", F.when(F.col("_gone").isNotNull(), _lines(F.col("text"))).alias("lines"))

    def without(gone: str) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
        return F.when(F.col(gone).isNotNull(), F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))

    def enough(left: str) -> Column:
        return F.col(left).isNotNull() & (2 * F.char_length(left) >= F.char_length("text"))

    rows = rows.withColumn("left", without("_gone"))
    rows = rows.withColumn("least", F.when(~enough("left") & (F.size("_sure") > 0), without("_sure")))
    text = F.when(enough("left"), F.col("left")).when(enough("least"), F.col("least")).otherwise(F.col("text"))
    n_dropped = F.when(enough("left"), F.size("_gone")).when(enough("least"), F.size("_sure")).otherwise(0)
    if not counts:
        return rows.select(*(text.alias(c) if c == "text" else field(c, "row").alias(c) for c in docs.columns))
    return rows.select(*(field(c, "row").alias(c) for c in others(docs, "text", "n_lines", "n_dropped")), text.alias("text"),
                       F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))
