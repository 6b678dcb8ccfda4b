"""Words and hashes against Python's own regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa

from tablesync.llm import words as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def texts():
    rng = random.Random(3)
    parts = ["Ab", "c3", "É", "ß9", " ", "\n", "--", "\t", "_", "漢字", "x" * 40, "\x00", "~"]
    found = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(200)]
    # a word longer than a block, and a text of many blocks
    return [*found, None, "", "a" * (W.BLOCK + 10) + " b", "one two, " * 90_000, "end"]


def test_words_are_those_of_the_pattern():
    given = texts()
    for column in (pa.array(given, pa.string()), pa.array(given, pa.large_string()), pa.array([None, *given], pa.string())[1:]):
        seen = 0
        for block in W.word_blocks(column):
            for k in range(block.hi - block.lo):
                want = split(given[block.lo + k])
                a, b = block.offsets[k], block.offsets[k + 1]
                assert block.joined(a, b).decode() == " ".join(want)
                assert block.normalised(k).decode() == " ".join(want)
                seen += 1
        assert seen == len(given)


def test_equal_words_have_equal_hashes_wherever_they_lie():
    rows = ["alpha beta", "x" * 1000 + " alpha  BETA", "beta", "be ta"]
    block = next(W.word_blocks(pa.array(rows)))
    h = block.hashes
    assert h[0] == h[3] and h[1] == h[4] == h[5]
    assert len(set(h.tolist())) == 5
    assert len(W.run_hashes(h, 2)) == len(h) - 1 and W.run_hashes(h, 2)[0] == W.run_hashes(h, 2)[3]
    assert len(W.run_hashes(h[:1], 2)) == 0


def test_no_texts():
    assert list(W.word_blocks(pa.array([], pa.string()))) == []
    assert [len(b.hashes) for b in W.word_blocks(pa.array([None, ""], pa.string()))] == [0]
    assert np.array_equal(W.text_bytes(pa.array([None, "é"], pa.string()))[1], [0, 0, 2])
