"""Recurring line templates against brute force, with lines of any length."""

import random
from collections import defaultdict

from caselake.llm import line_templates
from caselake.llm.line_templates import DEPTH, LEAST_TOKENS, MIN_DOCS


def templates(line):
    tokens = line.split()
    yield tuple(tokens)
    if len(tokens) >= LEAST_TOKENS:
        yield from (tuple(None if i == j else t for j, t in enumerate(tokens)) for i in range(DEPTH, len(tokens)))


def test_lines_of_any_length_equal_brute_force(spark):
    rng = random.Random(7)
    bases = [[rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(n)] for n in (2, 3, 4, 5, 6, 7, 12, 16, 17, 18, 25, 60, 300)]
    rows = []
    for i in range(140):
        lines = [f"{chr(97 + i % 26) * 3}{'xyzuvw'[i // 26] * 4}" * 900]
        for base in rng.sample(bases, 3):
            tokens = list(base)
            # Some lines vary in one token at a place that few or many others vary at, some in two.
            for place in rng.sample([2, 3, len(base) // 2, len(base) - 1], rng.choice([0, 1, 1, 1, 2])):
                if place < len(base):
                    tokens[place] = rng.choice("pqrstuvw") * rng.randint(1, 3)
            lines.insert(rng.randint(0, len(lines)), " ".join(tokens))
        rows.append((i, "\n".join(lines)))
    having = defaultdict(set)
    for i, text in rows:
        for line in text.split("\n"):
            for t in templates(line):
                having[t].add(i)
    wanted = {i: "\n".join(x for x in text.split("\n") if all(len(having[t]) < MIN_DOCS for t in templates(x))) for i, text in rows}
    got = line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == wanted
    gone = [x for i, text in rows for x in set(text.split("\n")) - set(wanted[i].split("\n"))]
    assert {len(x.split()) for x in gone} >= {5, 16, 17, 60, 300} and any(len(having[next(templates(x))]) < MIN_DOCS for x in gone if len(x.split()) > 16)
