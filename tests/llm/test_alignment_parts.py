"""A slice is aligned part by part: the same result as at once, in a fraction of the memory."""

import tracemalloc

import numpy as np
import public_tokenizers

from provisio.llm import token_alignment as ta


def test_parts_of_a_slice_give_the_whole_in_less_memory():
    a, b = ta.ByteLevel(public_tokenizers.path("byte_bpe_50k.json")), ta.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [None, "", "a", *[f"Some words, {i} of them; naïve café 東京 {i * 7919}. " * (i % 40) for i in range(900)], "x" * 20_000, None]
    peak = {}
    for chars in (10 ** 9, 30_000):
        tracemalloc.start()
        found = ta.align_slice(a, b, texts, chars)
        peak[chars] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        if chars == 10 ** 9:
            whole = found
    assert all(np.array_equal(whole[c], found[c]) for c in whole) and set(whole) == set(found)
    at_once = ta.align(a, b, texts)
    own, times = np.unique((at_once["text"] << 40) | at_once["pair"], return_counts=True)
    assert np.array_equal(own, found["own"]) and np.array_equal(times, found["times"]) and at_once["digests"] == found["digests"]
    assert peak[30_000] < peak[10 ** 9] / 3, peak
    assert [len(v) for v in ta.align_slice(a, b, []).values()] == [0] * 7
