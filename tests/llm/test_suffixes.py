import numpy as np
import pytest

from axonlake.llm import suffixes


def texts():
    r = np.random.default_rng(1)
    yield np.array([0], np.uint8)
    yield np.array([5, 0], np.uint8)
    for alphabet in (1, 2, 3, 20, 254):
        for n in (1, 2, 7, 60, 900):
            yield np.append(r.integers(1, alphabet + 1, n), 0).astype(np.uint8)
    for _ in range(6):
        block = r.integers(97, 101, 80).astype(np.uint8)
        parts = [np.append(block[int(r.integers(0, 40)) : int(r.integers(41, 80))], 1) for _ in range(12)]
        yield np.concatenate([*parts, [0]]).astype(np.uint8)
    yield np.frombuffer(b"abababababababababababab\1abababab\1" * 3 + b"\0", np.uint8)


def whole(*args):
    parts = list(suffixes.sorted_suffixes(*args))
    return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


@pytest.mark.parametrize("limit", [3, 10, 50])
@pytest.mark.parametrize("in_memory", [10**6, 50, 5])
def test_order_and_common_prefixes(limit, in_memory):
    for text in texts():
        places, common = whole(text.copy(), limit, in_memory)
        b = text.tobytes()
        assert sorted(places.tolist()) == list(range(len(b)))
        keys = [b[p : p + limit] for p in places.tolist()]
        assert keys == sorted(keys)

        def lcp(x, y):
            n = 0
            while n < min(len(x), len(y)) and x[n] == y[n]:
                n += 1
            return n

        assert common.tolist() == [0, *(lcp(x, y) for x, y in zip(keys[:-1], keys[1:], strict=True))]


def test_a_text_many_times_larger_than_memory(tmp_path):
    """A text of 1.2 million bytes in a file is sorted with 60,000 tuples in memory."""
    import tracemalloc

    r = np.random.default_rng(7)
    part = r.integers(97, 123, 40_000).astype(np.uint8)
    text = np.concatenate([r.integers(97, 123, 600_000).astype(np.uint8)] + [part] * 15 + [np.zeros(1, np.uint8)])
    text.tofile(tmp_path / "text")
    mapped = np.memmap(tmp_path / "text", np.uint8, "r")
    limit = 60_000
    store = suffixes.Store(limit)
    tracemalloc.start()
    n = sum(len(places) for places, _ in suffixes.sorted_suffixes(mapped, 50, limit, store))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(text) and store.spilled > len(text) and store.most <= 2 * limit + 1
    assert peak < 8 * len(text)  # a suffix array alone has eight bytes a place, and the sort in memory holds over thirty

    def strings(places, common):  # equal strings come in any order
        return common, places[np.lexsort((places, np.cumsum(common < 50)))]

    for a, b in zip(strings(*whole(mapped, 50, limit)), strings(*whole(text, 50, 10**8)), strict=True):
        assert np.array_equal(a, b)
