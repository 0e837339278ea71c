"""Counts of bits, held against a loop."""

import numpy as np

from ragset.llm import mixing


def test_add_bits_counts_each_bit_once_more():
    code = mixing.Code([b"", b"a", b"bb", b"the"], [9, 7, 5, 3], 4, [1 + i % 3 for i in range(256)], 8)
    total = np.zeros((mixing.CONTEXTS, 2 << 8), np.int32)
    want = np.zeros_like(total)
    for texts in ([[b"a", b"bb", b"spelt"] * 40, []], [[b"the"] * 300]):
        bits = mixing.bits_of(code, texts)
        for k in range(mixing.CONTEXTS):
            for slot, bit in zip(bits.slots[k].tolist(), bits.bits.tolist()):
                want[k, 2 * slot + bit] += 1
        mixing.add_bits(total, bits)
    assert (total == want).all() and total.dtype == np.int32 and total.max() > 100
