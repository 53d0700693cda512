"""What the pieces of op8 send: each distinct bigram once, and small numbers in few bytes."""

import numpy as np
import pytest

from ordermill.llm import word_lm


@pytest.mark.parametrize("numbers", [[], [0], [1, 2, 255], [3, 256, 70_000], [-1, 5], [2**62, 0]])
def test_numbers_come_back_from_their_bytes(numbers):
    given = np.array(numbers, np.int64)
    assert word_lm._numbers(word_lm._bytes(given), len(given)).tolist() == numbers


def test_a_part_answers_with_the_sums_of_all_pieces_and_marks_a_key_once():
    keys = [np.array([5, 9], np.uint64), np.array([9], np.uint64)]
    asked = [row for p, k in enumerate(keys) for row in word_lm._questions(p, word_lm.GRAMS, k, [np.full(len(k), 300), np.full(len(k), p)], 1)]
    assert sum(len(data[0]) for *_, data, _ in asked) == 8 * 3  # eight bytes a bigram
    answers = [m for batch in word_lm._answer(iter([word_lm._messages(asked)])) for m in batch.to_pylist()]
    found = [[word_lm._numbers(x, m["sums"][-1]).tolist() for x in m["data"]] for m in answers]
    assert found == [[[300, 600], [0, 1], [1, 1]], [[600], [1], [0]]]
    assert [m["sums"] for m in answers] == [[2, 900, 1, 1, 2], [0, 0, 0, 0, 1]]
