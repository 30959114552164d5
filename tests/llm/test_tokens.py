"""The encoder's ids against the plain call, on every common character, first pieces and small runs; its steps per piece."""

import sys

import numpy as np
import pytest

from caselake.llm import queries, tokens

FILE = queries.tokenizer_file(queries.BYTE_VOCABULARY)


def ids(encoder, texts):
    return [p.tolist() for _, flat, sizes in encoder.encode(texts) for p in np.split(flat, np.cumsum(sizes)[:-1])]


def plain(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(FILE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def new_words(count):
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzéß"))
    pick = np.random.default_rng(5)
    return ["".join(letters[pick.integers(len(letters), size=9)]) + end for _ in range(count // 4) for end in ("", ".", ",", "##")]


@pytest.mark.parametrize("words, chars, cached", [(5_000, 6_000_000, 1_000_000), (3, 200, 50)])
def test_every_common_character_and_first_piece(monkeypatch, words, chars, cached):
    monkeypatch.setattr(tokens, "WORDS_AT_ONCE", words)
    monkeypatch.setattr(tokens, "BYTE_CHARS_AT_ONCE", chars)
    monkeypatch.setattr(tokens, "CACHED_PIECES", cached)
    each = [chr(c) for c in [*range(0x300), 0x7FF, 0x800, 0x2019, 0x2028, 0x3000, 0xFFFD, 0x1F642]]
    texts = [t for c in each for t in (c, f"{c}b a{c} {c} a{c}b {c}{c} 1{c}#", f"a{c}\nb{c}", f"{c}\n{c} x")]
    texts += ["", None, " ", "\n", "\nb", "a \nb", "\n\nb", "a\n\nb c", "b", "a b", "a b\n", "\nb b\nb \nb", "<|endoftext|>", "a <|endoftext|> b", "it's 'sa", "don’t x"]
    texts += [" ".join(new_words(40)), "\n".join(new_words(40))]
    assert ids(tokens.PieceEncoder(FILE), texts) == plain(texts)


def test_new_pieces_that_spell_a_special_token_side_by_side():
    encoder = tokens.PieceEncoder(FILE)
    encoder.special = ["b’ a’"]
    encoder.tokenizer.add_special_tokens(encoder.special)
    texts = ["c b’", "c a’", "a’ c"]
    assert ids(encoder, texts) == plain(texts)


def test_no_step_takes_one_new_piece_at_a_time():
    words = new_words(20_000)
    texts = [" ".join(words[low:low + 100]) for low in range(0, len(words), 100)]
    assert len(set(words)) == len(words)
    encoder, steps = tokens.PieceEncoder(FILE), 0

    def count(frame, event, arg):
        nonlocal steps
        steps += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        for _ in encoder.encode(texts):
            pass
    finally:
        sys.setprofile(None)
    assert steps < len(words) / 4
    assert ids(encoder, texts) == plain(texts)
