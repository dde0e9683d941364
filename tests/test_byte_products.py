import numpy as np
import pytest

from narrascope.functions import byte_products as products
from narrascope.operators import retrieval

pytest.importorskip("onnxruntime")


def unit(rows):
    return (rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.float32)


def drawn(kind, n, dim, seed):
    rng = np.random.default_rng(seed)
    if kind == "words":  # counts of words, some rows of a single one
        rows = rng.poisson(0.1, (n, dim)).astype(float)
        rows[:: 7] = 0
        rows[np.arange(n), rng.integers(0, dim, n)] += 1
        return unit(rows)
    rows = rng.normal(size=(n, dim))
    return unit(rows * 10 ** rng.normal(size=(n, 1)))


@pytest.mark.parametrize("kind", ["words", "signs"])
@pytest.mark.parametrize("dim", [1, 70, 384])
def test_no_pair_above_its_floor_is_left_out(kind, dim):
    asked, held = drawn(kind, 300, dim, 1), drawn(kind, 1300, dim, 2)
    held[40:60], asked[5] = held[3], held[3]
    true = asked.astype(float) @ held.astype(float).T
    for floor in (np.sort(true, axis=1)[:, -5], np.full(300, -1.0), np.full(300, 0.2)):
        cuts, met = products.columns(held), []
        for cut in cuts:
            flags = products.may_reach(products.Asked.of(asked), cut, floor)
            reached = true[:, cut.places] >= floor[:, None]
            assert flags[reached].all()
            assert true[:, cut.places][flags].size == 0 or (true[:, cut.places] - floor[:, None])[flags].min() > -0.15
            met += cut.places.tolist()
        assert sorted(met) == list(range(1300))


def test_bytes_leave_out_nearly_all_pairs():
    asked, held = drawn("words", 512, 384, 3), drawn("words", 4096, 384, 4)
    floor = np.sort(asked @ held.T, axis=1)[:, -5]
    flags = [products.may_reach(products.Asked.of(asked), cut, floor) for cut in products.columns(held)]
    assert 512 * 5 <= sum(map(np.count_nonzero, flags)) < 0.02 * 512 * 4096


def lists(rows):
    import pyarrow as pa

    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], np.int32), rows.ravel())


@pytest.mark.parametrize("library", [True, False])
def test_answers_are_those_of_double_precision(monkeypatch, library):
    import pyarrow as pa

    asked, held = drawn("words", 700, 384, 5), drawn("words", 6000, 384, 6)
    held[2000:2300] = held[7]
    asked[3] = held[7]
    calls, reach = [], retrieval.may_reach
    monkeypatch.setattr(retrieval, "may_reach", lambda *given: calls.append(1) or reach(*given))
    if not library:
        monkeypatch.setattr(retrieval, "byte_products", lambda dim: False)
    best = retrieval._Best(retrieval._Questions(pa.array(range(700)), pa.nulls(700, pa.list_(pa.string())), asked), 5)
    for at in range(0, 6000, 2500):
        part = held[at : at + 2500]
        best.offer(pa.table({"chunk_id": pa.array(range(at, at + len(part))), "chunk_vector": lists(part)}))
    found = best.table().to_pandas().sort_values(["question_id", "distance", "chunk_id"])
    long = lambda rows: rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    far = np.rint((1 - long(asked) @ long(held).T) * 1e6)
    for question, mine in found.groupby("question_id"):
        assert mine["chunk_id"].tolist() == np.lexsort((np.arange(6000), far[question]))[:5].tolist()
    assert bool(calls) == library


def test_without_the_library_or_with_very_long_vectors_there_are_none(monkeypatch):
    assert products.byte_products(384) and not products.byte_products(1 << 20)
    monkeypatch.setitem(__import__("sys").modules, "onnxruntime", None)
    products._session.cache_clear()
    try:
        assert not products.byte_products(384)
    finally:
        products._session.cache_clear()


def test_a_processor_that_stops_at_16_bits_is_found_out():
    class Stops:
        def run(self, _, given):
            pairs = (given["a"].astype(int)[:, :, None] - int(given["zero"])) * given["b"].astype(int)
            two = np.clip(pairs[:, ::2] + pairs[:, 1::2], -(1 << 15), (1 << 15) - 1)
            return [two.sum(axis=1) >= given["bound"]]

    assert products._exact(products._session()) and not products._exact(Stops())
