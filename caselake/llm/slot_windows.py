"""Benchmark passages in documents, also with other numbers, names and units.

Tokens of texts and benchmark items are made canonical: numbers, units behind numbers and capitalised words
inside a sentence become typed placeholders. Windows of ``WIDTH`` canonical tokens are joined by hash. A
document is contaminated by an item if enough of the item's windows occur in it and the slots agree: each
value that a slot has in the item must stand for one value in the document, as in a re-parameterised
question; chance matches of a pattern mix values. Slots are judged for each occurrence apart: matches whose
places in document and item differ alike, together with those shifted by less than half the item (words put
in or left out). The best occurrence counts, so more copies or variants never make a document clean, and
enough windows with the item's own slot values always do for an occurrence.

Only windows with ``LEAST_PLAIN`` plain tokens count, in the item as in the document. An item with fewer than
``LEAST_WINDOWS`` of them, too few for the coverage of all its windows, is found where its whole canonical sequence
(but for the first word of a longer one) occurs with consistent slots; with fewer than ``LEAST_PLAIN`` plain tokens in all, which any text with numbers may
match, only with its own slot values. A currency sign before a number is a unit of its own.

Null and empty texts have no windows; an item shorter than a window is one window of its own length; items
without tokens are never found; repeated rows are found alike; empty tables give no rows. Other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caselake.llm.store import free_prefix, write_out

WIDTH = 6
LEAST_PLAIN = 4
LEAST_WINDOWS = 4
COVERAGE = 0.5
CONSISTENCY = 0.75
BROADCAST_WINDOWS = 500_000  # about 40 MB of rows; beyond it the windows are joined by a shuffle
# Unit words.
UNITS = ("kg", "g", "mg", "km", "m", "cm", "mm", "miles", "mile", "feet", "ft", "inches", "inch", "liters", "litres", "l", "ml",
         "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year",
         "dollars", "dollar", "euros", "euro", "cents", "cent", "percent", "%", "$", "€", "£", "degrees", "degree")
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
# All of ASCII but letters, digits, %, $ and white space, one by one.
ASCII_MARKS = "[" + "".join(rf"\x{c:02x}" for c in range(128) if not chr(c).isalnum() and chr(c) not in "%$ \t\n\x0b\f\r") + "]"


def _edges(mark: str) -> str:
    """Marks at the edges of a word; where a sentence ends with them, $1 is its mark."""
    return rf"(?={mark})(?:(?<!\S){mark}+|{mark}*([.!?])(?!\S)|{mark}+(?!\S))"


def _marked(text: Column) -> Column:
    """``text`` without marks around its words, but for one of ".!?" where a word ends with it."""
    sign = text.contains("$") | text.contains("€") | text.contains("£")
    text = F.coalesce(F.when(sign, F.regexp_replace(text, r"([$€£])(?=[.]?[0-9])", " $1 ")).otherwise(text), F.lit(""))
    # Most texts have no marks beyond ASCII; single characters are found faster than classes.
    bare = F.when(text.rlike(r"[^\x00-\x7F\p{L}\p{N}€£]"), F.regexp_replace(text, _edges(r"[^\p{L}\p{N}%$€£\s]"), "$1"))
    return F.btrim(bare.otherwise(F.regexp_replace(text, _edges(ASCII_MARKS), "$1")), F.lit(" \t\n\x0b\f\r"))


def _bare(marked: Column) -> Column:
    return F.regexp_replace(marked, r"[.!?](?!\S)", "")


def _words(marked: Column, bare: Column) -> Column:
    """Words as three arrays of one length: with a sentence's mark behind them, without, and in lower case."""
    none = F.array().cast("array<string>")
    return F.struct(*(F.when(bare == "", none).otherwise(F.split(text, r"\s+")).alias(name)
                      for name, text in (("marked", marked), ("raw", bare), ("low", F.lower(bare)))))


def _tokens(text: Column) -> Column:
    return _words(_marked(text), _bare(_marked(text)))


def _starts_digit(word: Column) -> Column:
    # Strings compare by their bytes, and ":" follows "9".
    return (word < ":") & (word >= "0")


def _canonical(tokens: Column) -> Column:
    marked, words, lows = tokens["marked"], tokens["raw"], tokens["low"]

    def of(raw: Column, i: Column) -> Column:
        # What most words fail at comes first; a word that is its own lower case is no name.
        low, head, before = F.get(lows, i), F.substring(raw, 1, 1), F.get(words, i - 1)
        return (F.when(_starts_digit(raw), F.lit(NUMBER))
                .when(raw.isin("$", "€", "£") & _starts_digit(F.get(words, i + 1)), F.lit(UNIT))
                .when(_starts_digit(before) & low.isin(*UNITS), F.lit(UNIT))
                .when((raw != low) & (i > 0) & (head != F.lower(head)) & (before == F.get(marked, i - 1)), F.lit(NAME))
                .otherwise(low))
    return F.transform(words, of)


def _is_slot(form: Column) -> Column:
    return form.isin(*(F.xxhash64(F.lit(w)) for w in (NUMBER, UNIT, NAME)))


def _hash(i: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *(F.get("forms", i + k) for k in range(width)))


def _places(width: int) -> tuple[Column, Column]:
    """Whether a text has windows, and where they begin."""
    last = F.size("forms") - width
    return last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))


def _matched(texts: DataFrame, windows: DataFrame, width: int) -> DataFrame:
    """``key`` of every text that holds one of ``windows``, once."""
    there, places = _places(width)
    # A column of plain numbers, exploded apart from the lambdas: Spark compiles explosion, join and count as one.
    hashes = texts.select("key", F.when(there, F.transform(places, lambda i: _hash(i, width))).alias("hashes"))
    return hashes.select("key", F.explode_outer("hashes").alias("window")).join(windows, "window", "left_semi").select("key").distinct()


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """Explode ``rows`` (raw, forms, ...) into windows: place, window hash, number of plain tokens, slot values in order."""
    rows = rows.withColumn("s", F.transform("forms", _is_slot))
    there, places = _places(width)
    # Conditions on computed arrays would be pushed below them and compute them again: short texts give null here.

    def window(i: Column) -> Column:
        # Values of this window's slots; most windows have none.
        some = F.get("s", i)
        for k in range(1, width):
            some = some | F.get("s", i + k)
        values = F.filter(F.transform(F.sequence(i, i + width - 1), lambda j: F.when(F.get("s", j), F.get("raw", j))), lambda v: v.isNotNull())
        return F.struct(i.alias("place"), _hash(i, width).alias("window"), F.when(some, values).alias("slots"))

    held = [c for c in rows.columns if c not in ("raw", "forms", "s")]
    return rows.select(*held, F.explode_outer(F.when(there, F.transform(places, window))).alias("w")).select(*held, "w.*")


def _prepared(df: DataFrame, text: str, *held: Column) -> DataFrame:
    """``held``, each token's raw text, and the hash of its canonical form."""
    # One step after the other, so that no text is cleaned once for each use.
    step = df.select(*held, _marked(F.col(text).cast("string")).alias("marked"))
    names = [c for c in step.columns if c != "marked"]
    step = step.select(*names, "marked", _bare(F.col("marked")).alias("bare"))
    step = step.select(*names, _words(F.col("marked"), F.col("bare")).alias("t")).select(*names, "t.*")
    forms = F.transform(_canonical(F.struct("marked", "raw", "low")), lambda w: F.xxhash64(w))
    return step.select(*names, "raw", forms.alias("forms"))


def _merged(parts: Column) -> Column:
    """Matches of alignments near each other: the largest first, each adds the item windows that those before it lack."""
    ordered = F.reverse(F.array_sort(F.transform(parts, lambda p: F.struct(p["n"], p["matches"]))))
    start = F.array().cast("array<struct<item_place:int,seen:array<struct<item_slots:string,slots:string>>,same:boolean>>")

    def add(held: Column, part: Column) -> Column:
        known = F.transform(held, lambda m: m["item_place"])
        return F.concat(held, F.filter(part["matches"], lambda m: ~F.array_contains(known, m["item_place"])))

    return F.aggregate(ordered, start, add)


def _agreement(matches: Column, coverage: float | Column) -> Column:
    """Values that the slots of the item have, by distinct pairs of item and document value; 0 if too few windows are there."""
    places = F.size(F.array_distinct(F.transform(matches, lambda m: m["item_place"])))
    seen = F.array_distinct(F.flatten(F.transform(matches, lambda m: m["seen"])))
    asked = F.size(F.array_distinct(F.transform(seen, lambda p: p["item_slots"])))
    agreement = F.when(F.size(seen) == 0, 1.0).otherwise(asked / F.size(seen))
    return F.when(places >= F.col("n_windows") * coverage, agreement).otherwise(0.0)


def contaminations(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """(key, doc_id, item_id, covered, consistent) of every document and item found in it."""
    items = _prepared(benchmark.dropDuplicates(["item_id", "text"]), "text", F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_text"))
    items = items.where(F.size("forms") > 0).withColumn("width", F.least(F.lit(WIDTH), F.size("forms")))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # 6 values at most
    text = F.col("text").cast("string")
    held = F.xxhash64("doc_id", text).alias("key"), F.col("doc_id").cast("long").alias("doc_id")
    by_item, windows, keys = Window.partitionBy("item_id", "item_text"), {}, None
    for width in widths:
        plain = F.size(F.filter("forms", lambda w: ~_is_slot(w)))
        of_items = items.where(F.col("width") == width).withColumn("total", F.size("forms") - width + 1).withColumn("bare", plain < LEAST_PLAIN)
        of_items = _windows(of_items, width).where(F.col("window").isNotNull())
        of_items = of_items.withColumn("enough", F.lit(width) - F.coalesce(F.size("slots"), F.lit(0)) >= min(LEAST_PLAIN, width))
        of_items = of_items.withColumn("n_enough", F.sum(F.col("enough").cast("int")).over(by_item))
        few = F.col("n_enough") < LEAST_WINDOWS
        of_items = of_items.withColumn("dense", few & (F.col("n_enough") < coverage * F.col("total")))
        # Windows side by side and the last one hold the whole sequence but its first token, whose form depends on what stands before it.
        tiles = (F.col("place") % width == 1) | (F.col("place") == F.col("total") - 1)
        of_items = of_items.where(F.when(F.col("dense"), tiles).otherwise(F.col("enough"))).withColumn("n_joined", F.count("*").over(by_item))
        of_items = of_items.select(
            "window", "item_id", "item_text", F.when(few & ~F.col("dense"), F.col("total")).otherwise(F.col("n_joined")).alias("n_windows"), "dense",
            (F.col("dense") & F.col("bare")).alias("bare"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
        windows[width] = of_items = F.broadcast(of_items) if (small := of_items.count() <= BROADCAST_WINDOWS) else of_items
        known = of_items.select("window").distinct()
        matched = _matched(_prepared(docs, "text", *held), F.broadcast(known) if small else known, width)
        keys = matched if keys is None else keys.union(matched)
    if keys is None:
        return _prepared(docs, "text", *held).select("key", "doc_id", F.col("doc_id").alias("item_id"), F.lit(0.0).alias("covered"), F.lit(1.0).alias("consistent")).limit(0)
    # Most texts hold no window of any item. The others' keys are written, so that their number is known to the join, and
    # only their places and slot values are looked at.
    keys, _ = write_out(keys.distinct(), "matched")
    texts = _prepared(docs.join(keys, F.xxhash64("doc_id", text) == keys["key"], "left_semi"), "text", *held)
    pairs = None
    for width, of_items in windows.items():
        found = _windows(texts, width).join(of_items, "window").select(
            "key", "doc_id", "item_id", "item_text", "n_windows", "dense", "bare", "item_place", "item_slots", "slots", (F.col("place") - F.col("item_place")).alias("shift"))
        pairs = found if pairs is None else pairs.union(found)
    of = ["key", "doc_id", "item_id", "item_text"]
    of += ["n_windows", "dense", "bare"]
    # One row per alignment, with its item windows and their slot assignments; then per document and item.
    pair = F.coalesce(F.arrays_zip("item_slots", "slots"), F.array().cast("array<struct<item_slots:string,slots:string>>"))
    match = F.struct("item_place", pair.alias("seen"), F.coalesce(F.col("item_slots") == F.col("slots"), F.lit(True)).alias("same"))
    each = pairs.groupBy(*of, "shift").agg(F.collect_set(match).alias("matches"))
    near = Window.partitionBy(*of).orderBy((F.col("shift") * 1000 / (F.col("n_windows") + WIDTH)).cast("long")).rangeBetween(-500, 500)
    each = each.withColumn("alone", _agreement(F.col("matches"), F.when(F.col("dense"), 1.0).otherwise(coverage)))
    each = each.withColumn("alone", F.when(F.col("bare") & F.exists("matches", lambda m: ~m["same"]), 0.0).otherwise(F.col("alone")))
    # Only where the alignment itself does not do, the ones around it are put together.
    each = each.withColumn("parts", F.collect_list(F.struct(F.size("matches").alias("n"), "matches")).over(near))
    each = each.withColumn("best", F.when(F.col("dense") | (F.col("alone") >= consistency), F.col("alone")).otherwise(F.greatest("alone", _agreement(_merged(F.col("parts")), coverage))))
    found = each.groupBy(*of).agg(F.max("best").alias("best"), F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"))
    places = lambda some: F.size(F.array_distinct(F.transform(some, lambda m: m["item_place"])))
    found = found.withColumn("covered", places(F.col("matches")) / F.col("n_windows"))
    same = places(F.filter("matches", lambda m: m["same"])) / F.col("n_windows")
    found = found.withColumn("consistent", F.when(F.col("dense"), F.col("best")).when(same >= coverage, 1.0).otherwise(F.greatest("best", _agreement(F.col("matches"), coverage))))
    return found.where((F.col("covered") >= coverage) & (F.col("consistent") >= consistency)).select("key", "doc_id", "item_id", "covered", "consistent")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document: doc_id, the items found, the best coverage and its consistency."""
    found = contaminations(docs, benchmark)
    return found.groupBy("key", "doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("covered").alias("covered"), F.max("consistent").alias("consistent"),
    ).select("doc_id", "item_ids", "covered", "consistent")


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows."""
    key = f"{free_prefix(docs)}key"
    found = contaminations(docs, benchmark).select(F.col("key").alias(key)).distinct()
    rows = docs.withColumn(key, F.xxhash64("doc_id", F.col("text").cast("string")))
    return rows.join(found, key, "left_anti").drop(key)
