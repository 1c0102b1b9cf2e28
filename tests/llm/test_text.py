from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm.text import Memo, Words, blocks, kept
from tests.llm.helpers import mirrored


@pytest.mark.parametrize("size", [2**n for n in range(4, 17)])
def test_mirrored_words_have_other_hashes(size):
    for letters in ("ab", "in", "x7"):
        (_, block), = blocks(pa.array([" ".join(mirrored(letters, size))]))
        assert len(set(Words(block).hashes.tolist())) == 2


def test_memo_forgets_the_rare_and_keeps_results_right():
    asked = []

    def lengths(words):
        asked.extend(words)
        return np.array([[len(w)] for w in words])

    pick, memo = random.Random(5), Memo(lengths, 1, np.int64, limit=40)
    for _ in range(50):
        words = ["common"] + ["w" * pick.randint(1, 300) for _ in range(10)]
        (_, block), = blocks(pa.array([" ".join(words)]))
        found = Words(block)
        assert memo.lookup(found.hashes, found.text)[:, 0].tolist() == [len(w) for w in words]
        assert len(memo.index) <= 31
    assert asked.count("common") == 1


def test_kept_objects_change_with_their_key():
    made = [kept("test", key, lambda: object()) for key in ("a", "a", "b", "a")]
    assert made[0] is made[1] and made[2] is not made[1] and made[3] is not made[0]
