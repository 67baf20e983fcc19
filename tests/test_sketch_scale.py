"""The sketch: the smallest keys of a row, without sorting all of them."""

import numpy as np

from repforge.operators import cluster as clu

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def test_smallest_keys_equal_a_full_sort():
    rng = np.random.default_rng(3)
    for letters in (b"A", b"AC", LETTERS.encode()):
        lengths = rng.integers(0, 900, size=40)
        data = rng.choice(np.frombuffer(letters, np.uint8), size=lengths.sum())
        for k, m in ((10, 20), (3, 5), (1, 1)):
            row, key, place = clu.kmer_keys(data, lengths, k)
            expect = []
            for i in range(len(lengths)):
                first = {}
                for kk, p in zip(key[row == i].tolist(), place[row == i].tolist()):
                    first.setdefault(kk, p)
                expect += [(i, kk, first[kk]) for kk in sorted(first)[:m]]
            assert list(zip(*(x.tolist() for x in clu.smallest_per_row(row, key, place, m)))) == expect


def test_long_rows_are_not_sorted_whole(monkeypatch):
    seen = []
    monkeypatch.setattr(clu, "_sorted_smallest", lambda r, k, p, m, f=clu._sorted_smallest: (seen.append(len(r)), f(r, k, p, m))[1])
    lengths = np.full(20, 5000)
    data = np.random.default_rng(1).choice(np.frombuffer(LETTERS.encode(), np.uint8), size=lengths.sum())
    clu.smallest_per_row(*clu.kmer_keys(data, lengths), 20)
    assert sum(seen) < 20 * 200
