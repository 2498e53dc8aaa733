"""Vectorised parts against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tollgate.llm import dac
from tollgate.llm import textvec as tv
from tollgate.llm.fm_index import FMIndex, WaveletTree, suffix_array
from tollgate.llm.jaccard_join import _forest, least_matches, shingles, signatures


@pytest.mark.parametrize("cls, pattern", [(tv.NON_SPACE, r"[^\x20\x09-\x0D]+"), (tv.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_and_hashes(cls, pattern):
    random.seed(1)
    texts = [None, "", "a", " a  b ", "é ß中", "\x0b\x0c\r\n\t"] + ["".join(random.choice("ab1 é\n.Z") for _ in range(random.randint(0, 40))) for _ in range(300)]
    data, offsets = tv.text_bytes(pa.array(texts))
    starts, ends, first = tv.word_spans(data, offsets, cls)
    fold = cls is tv.ALNUM  # these words are folded first
    hashes = tv.word_hashes(data, starts, ends, tv.FOLDED_VALUES if fold else tv._VALUES)
    raw, seen = data.tobytes().lower() if fold else data.tobytes(), {}
    for k, t in enumerate(texts):
        want = re.findall(pattern, (t or "").replace("Z", "z") if fold else t or "")
        got = [raw[starts[i]:ends[i]].decode() for i in range(first[k], first[k + 1])]
        assert got == want
        for i, w in zip(range(first[k], first[k + 1]), want):
            assert seen.setdefault(w, hashes[i]) == hashes[i]
    assert len(set(seen.values())) == len(seen)


def test_word_hash_does_not_depend_on_the_segment():
    word = "abc" * 200_000
    data, offsets = tv.text_bytes(pa.array([word + " x " + word, word]))
    starts, ends, _ = tv.word_spans(data, offsets, tv.NON_SPACE)
    h = tv.word_hashes(data, starts, ends)
    assert h[0] == h[2] == h[3] != h[1]


def test_sliced_arrow_column():
    column = pa.array(["x y", "a b c", None, "d"]).slice(1, 3)
    data, offsets = tv.text_bytes(column)
    assert data.tobytes() == b"a b cd" and offsets.tolist() == [0, 5, 5, 6]


def test_suffix_array_and_fm_index():
    rng = np.random.default_rng(2)
    for n, sigma in ((1, 3), (50, 3), (400, 4), (300, 40)):
        text = rng.integers(1, sigma, n)
        whole = [*text.tolist(), 0]
        assert suffix_array(np.array(whole)).tolist() == sorted(range(n + 1), key=lambda i: whole[i:])
        index = FMIndex(text, sigma)
        for size in (1, 2, 3):
            patterns = rng.integers(1, sigma, (30, size))
            lo, hi = index.search(patterns)
            for p, a, b in zip(patterns, lo, hi):
                want = [i for i in range(n - size + 1) if text[i:i + size].tolist() == p.tolist()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_wavelet_rank_and_access():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 11, 500)
    tree = WaveletTree(s, 11)
    i = rng.integers(0, 501, 200)
    c = rng.integers(0, 11, 200)
    assert tree.rank(c, i).tolist() == [int((s[:b] == a).sum()) for a, b in zip(c, i)]
    assert tree.access(np.arange(500)).tolist() == s.tolist()


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**24, 2**32 - 1], list(range(0, 70_000, 7)), [300] * 2000])
def test_dac_round_trip_and_random_access(ids):
    reader = dac.Reader(dac.encode(np.array(ids, np.uint32)))
    assert reader.decode().tolist() == ids and len(reader) == len(ids)
    for i in random.Random(4).sample(range(len(ids)), min(len(ids), 500)):
        assert reader[i] == ids[i]
    with pytest.raises(IndexError):
        reader[len(ids)]


def test_dac_rejects_other_bytes():
    with pytest.raises(ValueError):
        dac.Reader(b"xxxx" + b"\0" * 12)


def test_minhash_estimates_jaccard():
    words = [f"w{k}" for k in range(400)]
    column = pa.array([" ".join(words), " ".join(words[40:]), " ".join(words[300:]), "a b", "a b", ""])
    _, _, hashes, at = shingles(column)
    sign = signatures(hashes, at)
    sets = [set(hashes[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    assert [len(s) for s in sets] == [396, 356, 96, 1, 1, 0]
    for i, j in ((0, 1), (0, 2), (3, 4)):
        exact = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
        assert abs((sign[i] == sign[j]).mean() - exact) < 0.12


def test_pruning_bounds_are_exact_tails():
    from fractions import Fraction
    from math import comb
    t = Fraction(4, 5)
    for n, m in least_matches(0.8, 1e-6).items():
        def tail(k):
            return sum(comb(n + 1, i) * t**i * (1 - t)**(n + 1 - i) for i in range(k + 1))
        assert tail(m) >= Fraction(1, 10**6) > tail(m - 1)


def test_forest():
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 60, 40), rng.integers(0, 60, 40)
    root = _forest(60, left, right)
    group = list(range(60))
    for _ in range(60):
        for a, b in zip(left, right):
            group[a] = group[b] = min(group[a], group[b])
    assert root.tolist() == group
