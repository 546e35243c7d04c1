import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from prepwise.llm.common import Scratch, components, get_array, put_array
from prepwise.llm.elias_fano import EliasFano
from prepwise.llm.words import hashed_words

from .brute import roots, words


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, 1000 + k) for k in range(1, 200)]
    edges += [(2000 + k, 2001 + k) for k in range(40)] + [(5, 5), (1000, 1001)]
    found = components(Scratch(spark, "test"), spark.createDataFrame(edges, "a long, b long"))
    want = roots({x for e in edges for x in e}, edges)
    single = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in found.collect()} == {n: c for n, c in want.items() if n not in single}
    assert components(Scratch(spark, "test"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_shared_arrays_round_trip(tmp_path):
    for path in (f"{tmp_path}/x/a.npy", f"file://{tmp_path}/x/b.npy"):
        put_array(path, np.arange(5))
        put_array(path, np.arange(5))
        assert get_array(path).tolist() == [0, 1, 2, 3, 4]
    assert len(list((tmp_path / "x").iterdir())) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300), st.lists(st.integers(0, 2**41), max_size=50))
def test_elias_fano(values, others):
    values = np.array(sorted(set(values)), np.uint64)
    ef = EliasFano.of(EliasFano.encode(values).arrays().__getitem__)
    assert ef.access(np.arange(len(values))).tolist() == values.tolist()
    place = {int(v): i for i, v in enumerate(values)}
    ask = np.array([*values.tolist(), *others], np.uint64)
    assert ef.find(ask).tolist() == [place.get(int(v), -1) for v in ask]


def test_elias_fano_with_repeats():
    values = np.array([0, 0, 0, 5, 5, 9, 1000, 1000], np.uint64)
    assert EliasFano.encode(values).access(np.arange(8)).tolist() == values.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBc é\t\n\x0b\u00a0漢", max_size=60)), max_size=8))
def test_hashed_words(texts):
    h, counts = hashed_words(texts)
    want = [words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len({*zip(flat, h.tolist())}) == len(set(flat)) == len(set(h.tolist()))


def test_elias_fano_finds_across_words():
    rng = np.random.default_rng(2)
    for values in (np.arange(500), np.arange(64) + 3, np.arange(300) * 2, np.unique(rng.integers(0, 2**40, 900)), np.concatenate((np.arange(200) + 7, [10**6, 10**9]))):
        asked = np.concatenate((values, values + 1, rng.integers(0, int(values[-1]) * 3, 200), [0])).astype(np.uint64)
        place = {int(x): i for i, x in enumerate(values)}
        seq = EliasFano.encode(values)
        assert seq.find(asked).tolist() == [place.get(int(x), -1) for x in asked]
        assert (seq.access(np.arange(len(values))) == values).all()
