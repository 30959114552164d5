"""Licence scan with ordered signature rules.

Texts become lower-case words with one blank between them. Each rule's keyword decides whether its pattern is
tried; a text without any rule's keyword tries none. Every match is a detection with a span and
the rule's priority; a detection inside the span of a higher-ranked one is dropped, so that "gpl version 3
or later" hides the "gpl" in it. All of it are expressions over the row's own text: no shuffle.

Null texts count as empty, repeated rows give repeated results, an empty table none; other columns are
not read. Labels of the base phrases always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Family: label, keyword, name as a pattern over lower-case words. Longer names come first.
FAMILIES = (
    ("agpl-3", "affero", "(?:gnu )?affero general public licen[sc]e (?:version |v )?3(?: 0)?"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e"),
    ("agpl", "agpl", "agpl(?: ?v?3(?: 0)?)?"),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v )?3(?: 0)?"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v )?2 1"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[sc]e"),
    ("lgpl-2", "library", "gnu library general public licen[sc]e"),
    ("lgpl", "lgpl", "lgpl(?: ?v?[23](?: [01])?)?"),
    ("gpl-3", "general public", "gnu general public licen[sc]e (?:version |v )?3(?: 0)?"),
    ("gpl-2", "general public", "gnu general public licen[sc]e (?:version |v )?2(?: 0)?"),
    ("gpl", "general public", "gnu general public licen[sc]e"),
    ("gpl-3", "gpl", "(?:gnu )?gpl ?v?3(?: 0)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl ?v?2(?: 0)?"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gfdl", "documentation", "gnu free documentation licen[sc]e(?: version 1 [0-9])?"),
    ("apache-2", "apache", "apache(?: software)? licen[sc]e version 2(?: 0)?"),
    ("apache-2", "apache", "apache(?: licen[sc]e)? 2 0"),
    ("apache-1.1", "apache", "apache(?: software)? licen[sc]e version 1 1"),
    ("apache", "apache", "apache(?: software)? licen[sc]e"),
    ("mit-0", "mit", "mit no attribution"),
    ("mit", "mit", "mit(?: x11)? licen[sc]e"),
    ("x11", "x11", "x11 licen[sc]e"),
    ("bsd-4-clause", "bsd", "(?:4 clause bsd|bsd 4 clause|original bsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", "(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd)(?: licen[sc]e)?"),
    ("bsd-2-clause", "bsd", "(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd)(?: licen[sc]e)?"),
    ("bsd", "bsd", "bsd(?: style)? licen[sc]e"),
    ("isc", "isc", "isc licen[sc]e"),
    ("mpl-2", "mozilla", "mozilla public licen[sc]e(?: version| v)? 2(?: 0)?"),
    ("mpl-1.1", "mozilla", "mozilla public licen[sc]e(?: version| v)? 1 1"),
    ("mpl", "mozilla", "mozilla public licen[sc]e"),
    ("epl-2", "eclipse", "eclipse public licen[sc]e(?: version| v)? 2(?: 0)?"),
    ("epl-1", "eclipse", "eclipse public licen[sc]e(?: version| v)? 1(?: 0)?"),
    ("epl", "eclipse", "eclipse public licen[sc]e"),
    ("eupl", "european union", "european union public licen[sc]e(?: (?:version |v )?1 [0-9])?"),
    ("cddl", "common development", "common development and distribution licen[sc]e(?: (?:version |v )?1 [01])?"),
    ("cpl-1", "common public", "common public licen[sc]e(?: (?:version |v )?1 0)?"),
    ("artistic", "artistic", "artistic licen[sc]e(?: (?:version |v )?[12](?: 0)?)?"),
    ("bsl-1", "boost", "boost software licen[sc]e(?: (?:version |v )?1 0)?"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("unlicense", "unlicen", "unlicen[sc]e"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1.1", "open font", "(?:sil )?open font licen[sc]e(?: (?:version |v )?1 [01])?"),
    ("odbl", "open database", "open (?:data commons open )?database licen[sc]e(?: (?:version |v )?1 0)?"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e"),
    ("psf-2", "python", "python software foundation licen[sc]e(?: (?:version |v )?2)?"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by", "cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc by", "cc by(?: [1-4] [05])?"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?"),
)
# Wording around a family's name: priority and pattern; the higher priority ranks first.
WORDINGS = (
    (90, "spdx license identifier {name}"),
    (80, "(?:re ?)?licen[sc]ed (?:to you )?under (?:the )?(?:terms of )?(?:the )?{name}(?: or (?:any )?later(?: version)?)?"),
    (75, "(?:released|distributed|available|published|provided) (?:to you )?under (?:the )?(?:terms of )?(?:the )?{name}"),
    (70, "under the terms of (?:the )?{name}(?: as published by the free software foundation)?"),
    (50, "{name}"),
)
PHRASES = (
    ("public-domain", 70, "public domain", "(?:released into|dedicated to|placed in|in) the public domain"),
    ("proprietary", 60, "rights reserved", "all rights reserved"),
    ("no-warranty", 30, "warrant", "without warrant(?:y|ies) (?:or conditions )?of any kind"),
    ("copyleft", 20, "copyleft", "copyleft"),
    # Bodies and notices that need not name their licence.
    ("mit", 65, "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsl-1", 65, "hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("isc", 65, "hereby granted", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", 64, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 65, "endorse or promote", "neither the names? of [a-z0-9 ]{1,120}? may be used to endorse or promote products"),
    ("apache", 65, "in compliance with", "you may not use this (?:file|work|software) except in compliance with the licen[sc]e"),
    ("gpl", 65, "redistribute it", "you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("mpl-2", 65, "source code form", "this source code form is subject to the terms of the mozilla public licen[sc]e v ?2 0"),
    ("unlicense", 75, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 65, "do what the", "do what the f[a-z]+ you want to public licen[sc]e"),
    ("zlib", 65, "altered source", "altered source versions must be plainly marked as such"),
    ("no-warranty", 30, "without any", "without any (?:express or implied )?warranty"),
)


def rules() -> list[tuple[str, int, str, str]]:
    """Label, priority, keyword and pattern of every rule: each wording of each family, then single phrases."""
    named = [(label, priority, key, wording.format(name=name)) for priority, wording in WORDINGS for label, key, name in FAMILIES]
    return named + [(label, priority, key, pattern) for label, priority, key, pattern in PHRASES]


def _count(text: Column, part: str = " ") -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(part), F.lit("")))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _spans(padded: Column, rule: Column) -> Column:
    """Where a rule matches, from the lengths of the matches and of what lies between them."""
    def of(found: Column, between: Column) -> Column:
        return F.transform(found, lambda m, k: F.struct(
            (_sum(F.slice(between, F.lit(1), k + 1)) + _sum(F.slice(found, F.lit(1), k))).alias("low"), m.alias("size"),
            rule["priority"].alias("priority"), rule["label"].alias("label")))

    lengths = F.transform(F.regexp_extract_all(padded, rule["pattern"], F.lit(0)), F.char_length)
    gaps = F.transform(F.split(padded, rule["pattern"]), F.char_length)
    return F.flatten(F.transform(F.array(F.struct(lengths.alias("m"), gaps.alias("g"))), lambda p: of(p["m"], p["g"])))


def _outranked(spans: Column):
    def lost(s: Column) -> Column:
        return F.exists(spans, lambda t: (t["low"] <= s["low"]) & (t["low"] + t["size"] >= s["low"] + s["size"]) & (
            (t["priority"] > s["priority"]) | ((t["priority"] == s["priority"]) & (t["size"] > s["size"]))))
    return lost


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: words, places of the base phrases, labels and the best priority as a score."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    step = docs.select("doc_id", F.trim(F.regexp_replace(text, NO_WORD, " ")).alias("words"))
    step = step.select("doc_id", F.when(F.col("words") == "", " ").otherwise(F.concat(F.lit(" "), "words", F.lit(" "))).alias("padded"))
    padded, gate = F.col("padded"), F.lit(False)
    for key in sorted({key for _, _, key, _ in rules()}):
        gate = gate | F.contains(padded, F.lit(key))
    none = F.array().cast("array<string>")
    cuts = {f"cut{i}": F.when(F.contains(padded, F.lit(f" {p} ")), F.split(padded, f" {p}(?= )")).otherwise(none) for i, p in enumerate(BASE)}
    table = F.array(*(F.struct(F.lit(la).alias("label"), F.lit(pr).alias("priority"), F.lit(k).alias("key"), F.lit(f" (?:{p})(?= )").alias("pattern"))
                      for la, pr, k, p in rules()))
    empty = F.array().cast("array<struct<low:int,size:int,priority:int,label:string>>")
    spans = F.flatten(F.transform(F.filter(table, lambda r: F.contains(padded, r["key"])), lambda r: _spans(padded, r)))
    step = step.select("doc_id", (_count(padded) - 1).cast("long").alias("n_words"), *(c.alias(k) for k, c in cuts.items()),
                       F.when(gate, spans).otherwise(empty).alias("spans"))
    firsts, lasts, places, found = [], [], [], []
    for (phrase, label), cut in zip(BASE.items(), cuts):
        there = F.size(cut) > 0
        firsts.append(F.when(there, _count(F.get(cut, F.lit(0)))))
        lasts.append(F.when(there, F.col("n_words") - (_count(F.element_at(F.when(there, F.col(cut)), -1)) - 1) - len(phrase.split())))
        places.append(F.when(there, F.size(cut) - 1).otherwise(0))
        found.append(F.when(there, F.array(F.lit(label))).otherwise(none))
    step = step.withColumn("kept", F.filter("spans", lambda s: ~_outranked(F.col("spans"))(s)))
    base = F.array_sort(F.array_distinct(F.concat(*found)))
    both = F.array_sort(F.array_distinct(F.concat(base, F.transform("kept", lambda s: s["label"]))))
    top = F.greatest(F.coalesce(F.array_max(F.transform("kept", lambda s: s["priority"])), F.lit(0)), F.when(F.size(base) > 0, 50).otherwise(0))
    total = places[0] + places[1] + places[2]
    return step.select("doc_id", "n_words", total.cast("long").alias("n_base"), F.least(*firsts).cast("long").alias("first_word"),
                       F.greatest(*lasts).cast("long").alias("last_word"), F.array_join(base, ",").alias("base_labels"),
                       F.array_join(both, ",").alias("labels"), (top / 100.0).cast("double").alias("score"))
