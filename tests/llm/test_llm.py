"""Operators on training data against brute force, round trips and held-out accuracy, with odd rows."""

import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import (components, divergence, hyperdim, line_templates, packing, page_templates, queries, sentence_spans, signatures,
                          slot_windows, token_planes, vertical_join)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row string"
WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} of" for i in range(30_000))
PASSAGE = "Seven grey ships left port at dawn. They carried salt and timber for the north. No one on the quay knew when they would return. A bell rang twice."
ODD = [(-1, None), (-2, ""), (None, "no id here"), (-4, "A  b\n\n"), (-5, " \t\n"), (-6, LONG), (-7, "x y\r\nz <|endoftext|> it's 'sabc"), (-8, "a b c a b c a b c"),
       (-8, "a b c a b c a b c"), (-9, PASSAGE), (-10, "Before it all. " + PASSAGE + " After it all."), (-11, "under the MIT License, CC BY-NC cc by nc 4.0; under the mit license")]


@pytest.fixture(scope="module")
def docs(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, None, 0) for i, t in ODD], given.schema)
    return given.unionByName(odd).withColumn("key", F.lit("k")).withColumn("row", F.lit("r")).repartition(4).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r[0], r[1] or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def encoded(name, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file(name))
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [end], "<u4") for t in texts]


@pytest.mark.parametrize("bits", [False, True])
def test_token_planes_round_trip(spark, docs, none, texts, bits, tmp_path):
    file = queries.tokenizer_file(queries.BYTE_VOCABULARY)
    token_planes.write_tokens(docs, str(tmp_path / "t"), file, 0, bits)
    got = {(r[0], r[1]): r[2:] for r in token_planes.token_digests(spark, str(tmp_path / "t")).collect()}
    start, ordered = 0, sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (doc, _), ids in zip(ordered, encoded(queries.BYTE_VOCABULARY, [t for _, t in ordered], 0)):
        assert got[doc, start] == (len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    token_planes.write_tokens(none, str(tmp_path / "e"), file, 0, bits)
    assert token_planes.token_digests(spark, str(tmp_path / "e")).count() == 0


PARTS = ["a", "B", "word", "İ", "İstanbul", "ı", "ß", "e\u0301", "é", "漢字", "🙂", "1", "23", "_", "²", ".", ",", "!", "'s", "\n", "\n\n", " ", "  ", "\t", "\r\n",
         "\u00a0", "\u2028", "\x1c", "\x00", "<|endoftext|>", "<|startoftext|>", "<|endoftext|", "</w>", "Ġ", "ﬁ", "\u0307", "-", "zz", "of"]


@pytest.mark.parametrize("name", [queries.BYTE_VOCABULARY, queries.WORD_VOCABULARY])
def test_ids_equal_the_plain_call(name):
    from tokenizers import Tokenizer

    from caselake.llm.tokens import PieceEncoder

    pick = np.random.default_rng(3)
    odd = ["".join(PARTS[i] + " " * int(pick.integers(2)) for i in pick.integers(len(PARTS), size=pick.integers(14))) for _ in range(10_000)]
    odd += ["İ,", "İstanbul İ, a", "wordİ, x", ""]
    file = queries.tokenizer_file(name)
    want = [e.ids for e in Tokenizer.from_file(file).encode_batch(odd, add_special_tokens=False)]
    got = [p.tolist() for _, flat, sizes in PieceEncoder(file).encode(odd) for p in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == want


def test_packing_covers_every_id_once(docs, none, texts):
    file = queries.tokenizer_file(queries.WORD_VOCABULARY)
    rows = packing.pack(docs, file, 2, 512).collect()
    sums = Counter((d, len(i), zlib.crc32(i.tobytes())) for (d, _), i in zip(texts, encoded(queries.WORD_VOCABULARY, [t for _, t in texts], 2)))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(n * k for (_, n, _), k in sums.items())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        assert sum(p.length for p in pieces) <= 512
    padding = sum(512 - n for s in by_sequence.values() if (n := sum(p.length for p in s)) & (n - 1))
    assert padding < 0.05 * sum(r.length for r in rows)
    whole = [r for r in rows if r.start == 0 and r.length == r.doc_tokens]
    assert whole and all((r.doc_id, r.length, r.ids_crc32) in sums for r in whole)
    assert packing.pack(none, file, 2).count() == 0


def test_best_cuts_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(30):
        positions = np.cumsum(rng.integers(1, 8, 9))
        penalties = rng.integers(0, 10, 9)
        best = {0: 0}
        for at, cost in zip(positions.tolist(), penalties.tolist()):
            best[at] = min(v + 12 - (at - i) + cost for i, v in best.items() if at - i <= 12)
        total, before = 0, 0
        for j in packing.best_cuts(positions, penalties, 12):
            total += 12 - (positions[j] - before) + penalties[j]
            before = positions[j]
        assert total == best[int(positions[-1])]


def shingles(text):
    words = WORD.findall(text.translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for a, b in {(l[i], l[j]) for l in where.values() for i in range(len(l)) for j in range(i)}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            root[find(a)] = find(b)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[find(i)] = min(doc, lowest.get(find(i), doc))
    return Counter((doc, len(s), lowest.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def test_jaccard_join_equals_brute_force(spark, docs, none, texts):
    got = vertical_join.similar_components(docs)
    assert Counter(map(tuple, got.collect())) == brute_components(texts)
    assert vertical_join.similar_components(none).count() == 0


def test_jaccard_join_of_a_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.choice(200, int(rng.integers(0, 12)), replace=False):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    got = vertical_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute_components(rows)


def test_keep_one_leaves_a_row_of_each_component(spark, docs):
    found = {r[0]: r[1] for r in vertical_join.similar_components(docs).select("doc_id", "component_id").collect()}
    kept = vertical_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r[0] for r in kept.select("doc_id").where("doc_id IS NOT NULL").distinct().collect()]
    assert sorted(ids) == sorted({c for d, c in found.items() if d is not None})


def test_keep_one_keeps_rows_not_ids(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcde")
    rows = [(1, a), (5, a), (5, b), (None, a), (None, c), (None, d), (None, d), (7, e), (7, e), (7, e), (8, ""), (8, ""), (None, None)]
    kept = vertical_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, kept.collect())) == Counter([(1, a), (5, b), (None, c), (None, d), (7, e), (8, ""), (8, ""), (None, None)])


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51), (None, 3)], "a long, b long")
    assert dict(components.components(links).collect()) == {**{i: 0 for i in range(21)}, 50: 50, 51: 50}


def test_quality_counts_equal_brute_force(docs, none, texts):
    expected = Counter()
    for doc, text in texts:
        words, lines = WORD.findall(text), [s for s in text.split("\n") if WORD.search(s)]
        runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        often = Counter(runs)
        covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        expected[doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed] += 1
    report = divergence.quality_report(docs).collect()
    assert Counter(tuple(r[:7]) for r in report) == expected
    assert not any(r.kept and r.base_failed for r in report)
    kept = divergence.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in report)
    assert divergence.quality_report(none).count() == divergence.keep_good(none).count() == 0


def test_js_distance(spark):
    row = spark.range(1).select(divergence.js_distance(F.array(F.lit(1.0), F.lit(1.0)), (0.5, 0.5)).alias("same"),
                                divergence.js_distance(F.array(F.lit(1.0), F.lit(0.0)), (0.0, 1.0)).alias("far")).first()
    assert row.same == 0 and abs(row.far - 1) < 1e-12


def test_license_places_equal_brute_force(docs, none, texts):
    word, expected = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), Counter()
    for doc, text in texts:
        words, places, labels = word.findall(text.translate(LOWER)), [], set()
        for phrase, label in signatures.BASE.items():
            phrase = phrase.split()
            found = [k for k in range(len(words)) if words[k:k + len(phrase)] == phrase]
            places += found
            labels |= {label} if found else set()
        expected[doc, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    assert Counter(tuple(r[:6]) for r in signatures.scan(docs).collect()) == expected
    assert signatures.scan(none).count() == 0


def test_license_suppression(spark):
    rows = spark.createDataFrame([(1, "Licensed under the GNU General Public License, version 3 or later. All rights reserved."),
                                  (2, "the bsd style of painting")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in signatures.scan(rows).collect()}
    assert got == {1: ("gpl-3,proprietary", 0.8), 2: ("", 0.0)} and len(signatures.rules()) > 200


def test_license_names_and_bodies_are_found_without_other_words(spark):
    texts = {"released under the AGPL v3": "agpl", "distributed under LGPL v3": "lgpl", "it has the 3-clause BSD": "bsd-3-clause", "as in FreeBSD": "bsd-2-clause",
             "under 0BSD": "0bsd", "available under Apache 2.0": "apache-2", "WTFPL": "wtfpl", "MIT No Attribution": "mit-0", "without warranties of any kind": "no-warranty",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of it": "mit",
             "Redistribution and use in source and binary forms, with or without\nmodification, are permitted": "bsd"}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in signatures.scan(rows).collect()} == dict(enumerate(texts.values()))


def test_language_id_on_held_out_rows(docs, none):
    fold = hyperdim.held_out_fold()
    profiles = hyperdim.learn_prototypes(docs.where(~fold))
    found = hyperdim.predict(docs, profiles, fold)
    assert found.count() == docs.count()
    tested = found.where("held_out").join(docs.where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id")
    assert tested.where("lang = lang_pred").count() >= 0.95 * tested.count() > 0
    odd = {r.doc_id: (r.lang_pred, r.score) for r in found.where("doc_id IN (-1, -2, -5)").collect()}
    assert odd == {-1: ("und", 0.0), -2: ("und", 0.0), -5: ("und", 0.0)}
    assert hyperdim.learn_prototypes(none) == {} and hyperdim.predict(none, profiles, fold).count() == 0
    assert {r[0] for r in hyperdim.predict(docs, {}, fold).select("lang_pred").distinct().collect()} == {"und"}


def test_main_text_of_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "nonsense", ""), (-2, "nonsense", ""), (-3, "http://h.example/a", "<p>a &amp; b<br>c <b>d</b><div class='comments'>no</div>")], pages.schema)
    got = {r.page_id: (r.text, r.n_chars) for r in page_templates.main_texts(pages.unionByName(odd)).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id][0] == "\n".join(filter(None, parts))
    assert got[-1] == got[-2] == ("", 0) and got[-3] == ("a & b c d", 9)
    assert page_templates.main_texts(pages.limit(0)).count() == 0


def test_host_template_is_dropped(spark):
    page = "<body><div class='top'><p>Welcome to our site</p></div><p>Story {} of the day</p><div class='low'><p>All the best</p></div>"
    rows = spark.createDataFrame([(i, f"http://one.example/{i}", page.format(i)) for i in range(8)], "page_id long, url string, html string")
    assert {r.text for r in page_templates.main_texts(rows).collect()} == {f"Story {i} of the day" for i in range(8)}


def test_recurring_lines_are_dropped(spark, none):
    rows = [(i, f"A story number {i} about matter {i * 7}.\nPosted by user{i} on day {i}\nIt ends with word{i}x and more to say {i}.") for i in range(20)]
    rows += [(100, "Nothing here recurs.\nNot at all."), (101, None), (102, "")]
    got = {r.doc_id: r for r in line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].n_dropped == 0 and got[101].text is None and got[102].text == ""
    same = [(i, f"Opening words {chr(97 + i) * 3} alone go here.\nShare this page with friends\nMany closing words {chr(97 + i) * 4} are found there.") for i in range(12)]
    got = line_templates.drop_lines(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert all(r.n_dropped == 1 and "Share" not in r.text and r.n_lines == 3 for r in got)
    copies = spark.createDataFrame([(i, "First line of it\nSecond line of it\nThird line of it") for i in range(30)], "doc_id long, text string")
    assert line_templates.drop_lines(copies).where("n_dropped > 0").count() == 0
    assert line_templates.drop_lines(none).count() == 0


def test_lines_between_recurring_or_blank_lines_are_dropped(spark):
    foot = ["Read more on our site", "Posted by user{} on day {}", "All content belongs to the publisher", "Imprint and contact"]
    body = [f"{w} {w}s own words of {w} fill this long line, and only the words of {w} do so\nand {w}s second line is {w} alone, as {w} has it" for w in (f"{a}{b}q" for a in "abcd" for b in "xyz")]
    rows = [(i, f"{b}\n" + "\n".join(foot).format(i, i)) for i, b in enumerate(body)]
    rows += [(100 + i, f"{b} elsewhere\n\nSubscribe to the weekly letter\n\nand {b} ends") for i, b in enumerate(body)]
    # Two articles in many copies each are two documents; eight articles are eight.
    rows += [(1000 + i, f"Article {'pq'[i % 2] * 5} tells a long story of its own\nCopied by two only\nThe end of it") for i in range(20)]
    rows += [(2000 + i, f"Article {'stuvwxyz'[i % 8] * 5} tells a long story of its own\nCopied by eight") for i in range(80)]
    got = {r.doc_id: r for r in line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].text == b and got[i].n_dropped == 4 for i, b in enumerate(body))
    assert all("Subscribe" not in got[100 + i].text and got[100 + i].n_dropped == 1 for i in range(len(body)))
    assert all(got[1000 + i].n_dropped == 0 for i in range(20))
    assert all("Copied" not in got[2000 + i].text for i in range(80))


def test_repeated_sentences_are_removed(spark, docs, none):
    got = {r.doc_id: r for r in sentence_spans.deduplicate(docs).where("doc_id < 0").collect()}
    assert got[-10].text == "Before it all. " + PASSAGE + " After it all." and got[-10].n_removed == 0
    assert got[-9].first_docs == [-10] and got[-9].n_removed == 4 and got[-9].text == ""
    assert sentence_spans.deduplicate(docs).count() == docs.count() and sentence_spans.deduplicate(none).count() == 0
    for text in (PASSAGE, LONG, "a.b c.\n\nD! e", "\n\n", ""):
        assert "".join(sentence_spans.sentences(text)) == text


def test_benchmark_text_is_found(spark, none):
    item = "A train leaves the old station at 40 km per hour and another leaves at 60 km per hour after Peter waves goodbye"
    other = item.replace("40", "35").replace("60", "90").replace("Peter", "Maria")
    mixed = "5 km per hour and another leaves at 7 of the old boats"
    rows = [(1, f"Some words before. {item}. Some words after."), (2, f"Here is a task: {other}, they say."), (3, mixed), (4, None), (5, ""), (6, "unrelated text of no interest to anyone at all")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9, item), (10, None), (11, "too short")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in slot_windows.contaminated(docs, bench).collect()}
    assert got == {1: [9], 2: [9]}
    kept = slot_windows.keep_uncontaminated(docs, bench)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [3, 4, 5, 6] and kept.columns == docs.columns
    assert slot_windows.contaminated(none, bench).count() == slot_windows.contaminated(docs, bench.limit(0)).count() == 0


def test_benchmark_text_is_found_beside_its_variants(spark):
    item = "A train leaves the old station at 40 km per hour and another leaves at 60 km per hour after Peter waves goodbye"
    variant = lambda a, b, name: item.replace("40", a).replace("60", b).replace("Peter", name)
    split = lambda text: text.replace("and another", "and then quite soon another")
    rows = [(1, f"First: {item}. Then: {variant('35', '90', 'Maria')}."),
            (2, f"One: {variant('35', '90', 'Maria')}. Two: {variant('25', '80', 'Anna')}. Three: {variant('15', '70', 'Olaf')}."),
            (3, f"One: {split(variant('35', '90', 'Maria'))}. Two: {split(variant('25', '80', 'Anna'))}."),
            (4, f"At 5 km per hour and another leaves at 7 km per hour. {item}. So at 8 km per hour and another leaves at 9 km per hour after Jo waves.")]
    twice = "We paid 40 coins at the gate of the town and 40 coins at the door of the inn and 40 coins at the end of the road"
    rows += [(5, f"Once {twice.replace('40', '7', 1).replace('40', '8', 1).replace('40', '9', 1)}."), (6, f"Once {twice.replace('40', '7')} and {twice.replace('40', '6')}.")]
    bench = spark.createDataFrame([(9, item), (8, twice)], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in slot_windows.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: [9], 2: [9], 3: [9], 4: [9], 6: [8]}


def test_items_dense_in_numbers_and_money_are_found(spark):
    dense = "Add 3 kg 4 g and 5 kg 6 g then 7 kg 8 g plus 9 kg 2 g"
    money = "She pays $40 for apples, $60 for pears, $25 for plums and keeps the rest of the coins in a small jar"
    bench = spark.createDataFrame([(1, dense), (2, "Compute 12 times 17"), (3, money), (3, money), (4, "What is 5 plus 7")], "item_id long, text string")
    rows = [(1, f"Task: {dense}. Good luck."), (2, f"Task: {dense.replace('3', '11').replace('8', '13')}."), (3, f"Task: {dense.replace('plus', 'minus')}."),
            (4, "Please compute 12 times 17 now"), (5, "Please compute 13 times 19 now"), (6, f"Here: {money.replace('40', '41').replace('60', '62').replace('25', '27')}."),
            (7, "So what is 5 plus 7 then")]
    got = {r.doc_id: r.item_ids for r in slot_windows.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: [1], 2: [1], 4: [2], 6: [3], 7: [4]}
    forms = spark.createDataFrame([("It costs $40 or US$.50 today",)], "text string").select(slot_windows._canonical(slot_windows._tokens(F.col("text")))).first()[0]
    assert forms == ["it", "costs", "<unit>", "<number>", "or", "<name>", "<unit>", "<number>", "today"]


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns[:3] == ["doc_id", "start", "length"]
    good = {r.doc_id for r in divergence.quality_report(docs).where("kept").collect()}
    assert 0 < rows.select("doc_id").distinct().count() <= len(good) and {r[0] for r in rows.select("doc_id").distinct().collect()} <= good
