"""The binary Golay code of length 23: 4,096 codewords, any two at least 7 bits apart.

Each 23-bit word has exactly one codeword within 3 bits. Words whose nearest codeword is 3 bits
away have five more at 4 bits. Two words that differ in at most 2 bits share one of these one or six:

* If one word is within 2 bits of a codeword, that codeword is within 4 bits of the other word.
* Else both are 3 bits from their nearest. Should these differ, say the first word is c + {a, b, c'} and
  the second adds bits x and y. The codeword that covers a, b, c' and x (one does, as any four places lie
  in one codeword of weight 7) is 4 bits from the first word and 4 or 2 bits from the second.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS, CHECK_BITS = 23, 11
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for shift in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECK_BITS)
    return word


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each bit; for each syndrome the errors that lead to codewords within 4 bits; their number."""
    single = np.array([_remainder(1 << i) for i in range(BITS)], dtype=np.int64)
    errors = np.zeros((1 << CHECK_BITS, 6), dtype=np.int64)
    count = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    nearest = np.full(1 << CHECK_BITS, -1, dtype=np.int64)
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            syndrome = int(np.bitwise_xor.reduce(single[list(places)])) if places else 0
            if weight <= 3:
                nearest[syndrome] = weight
            if weight <= 3 or nearest[syndrome] == 3:
                errors[syndrome, count[syndrome]] = sum(1 << i for i in places)
                count[syndrome] += 1
    return single, errors, count


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the codewords within 4 bits of each word: an n x 6 array and how many of each row count."""
    single, errors, count = _tables()
    words = words.astype(np.int64)
    syndrome = np.zeros(len(words), dtype=np.int64)
    for i in range(BITS):
        syndrome ^= np.where(words >> i & 1, single[i], 0)
    return (words[:, None] ^ errors[syndrome]) >> CHECK_BITS, count[syndrome]
