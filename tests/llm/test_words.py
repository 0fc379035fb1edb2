"""Word splitting and window hashes against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from croptide.llm.words import (Words, chunks, text_buffers, window_hashes, window_starts)

TEXTS = ["a b  c\n", None, "", "a b c", " ab c", "é ü\tß", "\x0b\x0c", "x" * 3000, "b a", "c b a"]


def test_words_match_split():
    offsets, data = text_buffers(pa.array(TEXTS))
    words = Words.split(offsets, data)
    for i, text in enumerate(TEXTS):
        own = [data[words.start[k]:words.end[k]].tobytes()
               for k in range(words.first[i], words.first[i + 1])]
        assert own == (text or "").encode().split()


def test_sliced_arrays():
    array = pa.array(["zz", *TEXTS, "yy"]).slice(1, len(TEXTS))
    offsets, data = text_buffers(array)
    assert data.tobytes() == "".join(t or "" for t in TEXTS).encode()
    assert len(offsets) == len(TEXTS) + 1


@pytest.mark.parametrize("size", [1, 3, 5])
def test_equal_hashes_mean_equal_windows(size):
    rng = random.Random(size)
    texts = [" ".join(rng.choices(["a", "b", "ab", "ba", "abc"], k=rng.randrange(0, 30)))
             for _ in range(40)]
    offsets, data = text_buffers(pa.array(texts))
    words = Words.split(offsets, data)
    hashes = window_hashes(words.hashes(), size)
    inside = window_starts(words.first, size)[:len(hashes)]
    want = [tuple(t.split()[k:k + size]) for t in texts for k in range(len(t.split()) - size + 1)]
    got = hashes[inside]
    assert len(got) == len(want)
    assert len(set(zip(want, got.tolist(), strict=True))) == len(set(want)) == len(
        set(got.tolist()))


def test_chunks_cover_everything():
    offsets = np.array([0, 5, 5, 500, 501, 502])
    assert list(chunks(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(chunks(np.array([0]), 10)) == []
