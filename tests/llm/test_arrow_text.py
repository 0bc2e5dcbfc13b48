import random

import numpy as np
import pyarrow as pa

from retentide.llm import arrow_text
from retentide.llm.arrow_text import TOKENS, slices, windows, words


def test_words_are_those_of_bytes_split(monkeypatch):
    monkeypatch.setattr(arrow_text, "BLOCK_BYTES", 64)
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab cÉ\t\n,.0X\x00\x85") for _ in range(draw.randrange(300))) for _ in range(200)]
    texts += [None, "", "x" * 500, " ", "a" * 64 + " " + "b" * 64]
    names = {}
    for first, last, data, at in slices(pa.array(texts), 500):
        found = words(data, at, TOKENS)
        bounds = found.per_text(last - first)
        for k in range(last - first):
            own = slice(bounds[k], bounds[k + 1])
            got = [bytes(data[s:e]).lower() for s, e in zip(found.starts[own], found.ends[own], strict=True)]
            assert got == (texts[first + k] or "").encode().lower().split()
            for word, name in zip(got, found.hashes[own], strict=True):
                assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


def test_windows_depend_on_order_and_size():
    hashes = np.array([1, 2, 3, 2, 1], np.uint64)
    assert len({*windows(hashes, 2), *windows(hashes, 3)}) == 7
    assert len(windows(hashes, 6)) == 0
