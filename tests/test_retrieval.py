import numpy as np
import pytest
from pyspark.sql import functions as F

from narrascope.operators import retrieval
from narrascope.sources import chunk_store
from narrascope.schema import CATEGORY

DIM = 8
STORE = f"chunk_id string, {CATEGORY} string, embedding array<float>"
ASKED = "question_id long, wanted string, embedding array<float>"


def vectors(n, seed=0):
    return np.random.default_rng(seed).normal(size=(n, DIM)).astype(np.float32)


def brute(questions, store, k):
    found = set()
    for qid, wanted, q in questions:
        ranked = []
        for cid, category, c in store:
            if c is None or len(c) != len(q) or (wanted and wanted != category):
                continue
            a, b = np.asarray(q, np.float64), np.asarray(c, np.float64)
            norms = np.linalg.norm(a) * np.linalg.norm(b)
            if norms:
                ranked.append((round(1 - a @ b / norms, 6), cid))
        found |= {(qid, i, cid, abs(d)) for i, (d, cid) in enumerate(sorted(ranked)[:k], 1)}
    return found


def rows(df):
    return {(r.question_id, r["rank"], r.chunk_id, abs(r.distance)) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    store = [
        (f"c{i:03}", ["x", "y", None][i % 3], v.tolist()) for i, v in enumerate(vectors(120))
    ]
    # A third of the store is copies of one vector; some vectors cannot be used.
    store += [(f"d{i:03}", "x", store[0][2]) for i in range(60)]
    # Squares of these leave the range of single precision.
    store += [(f"s{p}", "x", (v * 10.0**p).tolist()) for p, v in zip((-25, 25), vectors(2, 3))]
    store += [("zero", "x", [0.0] * DIM), ("short", "x", [1.0]), ("none", "x", None)]
    asked = [(i, [None, "x", "y", "", "nothing"][i % 5], v.tolist()) for i, v in enumerate(vectors(23, 1))]
    asked += [(98, None, store[0][2]), (99, None, [0.0] * DIM)]
    return asked, store


@pytest.mark.parametrize("limit", [1000, 7], ids=["resident", "blocks"])
@pytest.mark.parametrize("parts", [1, 5])
def test_exact_search(spark, data, limit, parts):
    asked, store = data
    found = retrieval.nearest_chunks(
        spark.createDataFrame(asked, ASKED),
        spark.createDataFrame(store, STORE).repartition(parts),
        4, question_category="wanted", resident_limit=limit,
    )
    assert rows(found) == brute(asked, store, 4)


def test_many_batches(spark, data):
    asked, store = data
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = retrieval.nearest_chunks(
            spark.createDataFrame(asked, ASKED), spark.createDataFrame(store, STORE).coalesce(1), 3
        )
        assert rows(found) == brute([(q, None, v) for q, _, v in asked], store, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_k_defaults_and_may_exceed_the_store(spark, data):
    asked, store = data
    questions, chunks = spark.createDataFrame(asked[:1], ASKED), spark.createDataFrame(store[:9], STORE)
    for k, n in ((None, 5), (0, 5), (50, 9)):
        assert retrieval.nearest_chunks(questions, chunks, k).count() == n


def test_sql_distance_agrees(spark, data):
    asked, store = data
    pair = F.col("a.embedding"), F.col("b.embedding")
    chunks = spark.createDataFrame(store, STORE)
    found = chunks.alias("a").join(chunks.alias("b"), F.col("a.chunk_id") == "c001").select(
        F.col("b.chunk_id"), retrieval.cosine_distance(*pair).alias("d")
    )
    wanted = {c: d for _, _, c, d in brute([(1, None, store[1][2])], store, 1000)}
    assert {r.chunk_id: abs(r.d) for r in found.collect() if r.d is not None} == wanted


@pytest.mark.parametrize("limit", [1000, 20])
def test_cells(spark, data, limit, tmp_path):
    asked, store = data
    chunks = spark.createDataFrame(store, STORE)
    questions = spark.createDataFrame(asked, ASKED)
    centres = retrieval.train_cells(chunks, 6)
    chunk_store.write_cells(chunks, centres, str(tmp_path / "index"))
    celled, read = chunk_store.read_cells(spark, str(tmp_path / "index"))
    assert np.array_equal(read, centres) and celled.where("cell = -1").count() == 3
    every = retrieval.nearest_chunks_by_cell(
        questions, celled, centres, 4, 6, question_category="wanted", resident_limit=limit
    )
    assert rows(every) == brute(asked, store, 4)
    some = rows(retrieval.nearest_chunks_by_cell(questions, celled, centres, 4, 3))
    exact = brute([(q, None, v) for q, _, v in asked], store, 4)
    recall = len({(q, c) for q, _, c, _ in some} & {(q, c) for q, _, c, _ in exact}) / len(exact)
    assert 0.5 < recall <= 1


@pytest.mark.parametrize("limit", [1000, 1])
def test_questions_of_different_lengths_are_an_error(spark, data, limit):
    asked = spark.createDataFrame([(1, None, [1.0] * DIM), (2, None, [1.0])], ASKED)
    with pytest.raises(ValueError, match="different lengths"):
        retrieval.nearest_chunks(asked, spark.createDataFrame(data[1], STORE), 2, resident_limit=limit)


def test_category_prunes_partitions(spark, data, tmp_path):
    asked, store = data
    path = str(tmp_path / "store")
    spark.createDataFrame(store, STORE).where(f"{CATEGORY} is not null").write.partitionBy(CATEGORY).parquet(path)
    questions = spark.createDataFrame([a for a in asked if a[1] == "x"], ASKED)
    hits = retrieval.nearest_chunks(questions, spark.read.parquet(path), 2, question_category="wanted")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(product_category" in plan
    assert rows(hits) == brute([a for a in asked if a[1] == "x"], [s for s in store if s[1]], 2)


@pytest.mark.parametrize("wanted", [None, "wanted"])
def test_probes_are_chosen_by_recall(spark, data, wanted):
    asked, store = data
    chunks = spark.createDataFrame(store, STORE)
    questions = spark.createDataFrame(asked, ASKED)
    centres = retrieval.train_cells(chunks, 6)
    celled = retrieval.assign_cells(chunks, centres)
    exact = rows(retrieval.nearest_chunks(questions, chunks, 4, question_category=wanted))

    def recall(found):
        return len({(q, c) for q, _, c, _ in rows(found)} & {(q, c) for q, _, c, _ in exact}) / len(exact)

    by_cell = lambda probes: retrieval.nearest_chunks_by_cell(questions, celled, centres, 4, probes, question_category=wanted)
    probes, measured = retrieval.enough_probes(questions, celled, centres, 4, question_category=wanted)
    assert measured >= 0.9 and recall(by_cell(None)) >= 0.9
    assert abs(recall(by_cell(probes)) - measured) < 0.01
    assert probes == 1 or recall(by_cell(probes - 1)) < 0.9


def test_query_of_measured_probes_reaches_its_recall(spark):
    from verification.queries import QUERIES

    path = "/root/testdata/sf0.01"
    pairs = [{(r[0], r[2]) for r in QUERIES[n](spark, path).collect()} for n in ("knn_ivf_measured", "knn_exact")]
    assert len(pairs[0] & pairs[1]) >= 0.9 * len(pairs[1])


def test_codes_reach_their_recall(spark):
    from verification.queries import QUERIES

    path = "/root/testdata/sf0.01"
    exact = {(r[0], r[2]) for r in QUERIES["knn_exact"](spark, path).collect()}
    for name in ("knn_codes", "knn_ivf"):
        found = {(r[0], r[2]) for r in QUERIES[name](spark, path).collect()}
        assert len(found & exact) >= 0.9 * len(exact), name


def test_codes(spark, data):
    asked, store = data
    chunks = spark.createDataFrame(store, STORE)
    questions = spark.createDataFrame(asked, ASKED)
    books = retrieval.train_codes(chunks, 2)
    codes = chunks.select("chunk_id", CATEGORY, retrieval.vector_codes(F.col("embedding"), books).alias("code"))
    assert {len(r.code) for r in codes.collect() if r.code is not None} == {2}
    every = retrieval.nearest_chunks_by_code(questions, codes, chunks, books, 4, 10_000, question_category="wanted")
    assert rows(every) == brute(asked, store, 4)
    with pytest.raises(ValueError, match="cannot be cut"):
        retrieval.train_codes(chunks, 7)


def numbered(spark, n):
    return spark.createDataFrame(list(enumerate(vectors(n).tolist())), "id long, embedding array<float>")


def test_questions_of_a_few_blocks_are_asked_in_one_job(spark, monkeypatch):
    table = numbered(spark, 60)
    written, pinned = [], retrieval.pinned
    monkeypatch.setattr(retrieval, "pinned", lambda df, name: written.append(name) or pinned(df, name))
    found = retrieval.nearest_chunks(table, table, 3, question_id="id", chunk_id="id", resident_limit=10)
    whole = retrieval.nearest_chunks(table, table, 3, question_id="id", chunk_id="id")
    assert rows(found) == rows(whole)
    assert written.count("block-answers") == 1


def test_a_question_is_held_once_however_many_cells_it_probes(spark, monkeypatch):
    table = numbered(spark, 60)
    centres = retrieval.train_cells(table, 4)
    celled = retrieval.assign_cells(table, centres)
    held, score = [], retrieval._score_resident
    monkeypatch.setattr(retrieval, "_score_resident", lambda block, *rest: held.append(block.num_rows) or score(block, *rest))
    found = retrieval.nearest_chunks_by_cell(table, celled, centres, 3, 4, question_id="id", chunk_id="id", resident_limit=60)
    whole = retrieval.nearest_chunks(table, table, 3, question_id="id", chunk_id="id")
    assert rows(found) == rows(whole)
    assert held[0] == 60


def test_small_blocks_share_a_scan(spark, data, monkeypatch):
    asked, store = data
    scans, score = [], retrieval._score_resident
    monkeypatch.setattr(retrieval, "_score_resident", lambda block, *rest: scans.append(block.num_rows) or score(block, *rest))
    arguments = spark.createDataFrame(asked, ASKED), spark.createDataFrame(store, STORE).repartition(3), 4
    found = retrieval.nearest_chunks(*arguments, question_category="wanted", resident_limit=2)
    assert rows(found) == brute(asked, store, 4)
    assert scans == [len(asked)]
    monkeypatch.setattr(retrieval, "RESIDENT_QUESTIONS", 6)
    found = retrieval.nearest_chunks(*arguments, question_category="wanted", resident_limit=2)
    assert rows(found) == brute(asked, store, 4)
    assert len(scans) <= 1 + -(-len(asked) // 6)


def test_few_pairs_are_scored_twice_and_ties_go_to_the_least_id(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    asked, chunks = rng.normal(size=(300, 16)), rng.normal(size=(6000, 16)).astype(np.float32)
    chunks[3000:5000] = chunks[17]  # copies of one chunk
    asked[7] = chunks[17]
    scored, places = [], retrieval._places
    monkeypatch.setattr(retrieval, "_places", lambda similar: scored.append(similar.size) or places(similar))
    order = rng.permutation(6000)
    ids = np.array([f"c{i:04}" for i in range(6000)])

    def lists(rows):
        return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), 16).cast(pa.list_(pa.from_numpy_dtype(rows.dtype)))

    block = retrieval._Questions(pa.array(range(300)), pa.nulls(300, pa.list_(pa.string())), asked)
    best = retrieval._Best(block, 5)
    for at in range(0, 6000, 2500):
        part = order[at : at + 2500]
        best.offer(pa.table({"chunk_id": ids[part], "chunk_vector": lists(chunks[part])}))
    pairs, scored = sum(scored), scored.clear()
    found = best.table().to_pandas().sort_values(["question_id", "distance", "chunk_id"])
    unit = lambda rows: rows / np.linalg.norm(rows, axis=1)[:, None]
    far = np.rint((1 - unit(asked) @ unit(chunks.astype(float)).T) * 1e6)
    for question, mine in found.groupby("question_id"):
        assert mine["chunk_id"].tolist() == ids[np.lexsort((ids, far[question]))[:5]].tolist()
    assert pairs < 300 * 6000 / 2


def _block(asked):
    import pyarrow as pa

    return retrieval._Questions(pa.array(range(len(asked))), pa.nulls(len(asked), pa.list_(pa.string())), asked)


def _part(chunks, first=0):
    import pyarrow as pa

    return retrieval._Chunks(pa.array(range(first, first + len(chunks))), chunks)


def _first_five(asked, chunks):
    unit = lambda rows: rows / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    far = np.rint((1 - unit(asked) @ unit(chunks).T) * 1e6)
    return {(q, int(c)) for q in range(len(asked)) for c in np.lexsort((np.arange(len(chunks)), far[q]))[:5]}


def test_first_chunks_of_a_task_are_scored_in_double_precision_only_where_near(monkeypatch):
    rng = np.random.default_rng(6)
    asked, chunks = rng.normal(size=(300, 16)), rng.normal(size=(512, 16)).astype(np.float32)
    chunks[100:103] = chunks[17]  # copies, and chunks that single precision does not tell apart
    chunks[200:203] = chunks[18] * (1 + 1e-6 * rng.normal(size=(3, 16)))
    asked[7], asked[8] = chunks[17], chunks[18]
    best = retrieval._Best(_block(asked), 5)
    row, column = best._near(np.arange(300), _part(chunks))
    assert 300 * 5 <= len(row) < 300 * 8
    best.add(None, _part(chunks[:3]))  # fewer chunks than are wanted, then the others
    best.add(None, _part(chunks[3:], 3))
    found = best.table().to_pydict()
    assert set(zip(found["question_id"], found["chunk_id"])) == _first_five(asked, chunks)


def test_pairs_that_are_scored_again_are_fetched_few_at_a_time():
    import tracemalloc

    rng = np.random.default_rng(7)
    asked, chunks = rng.normal(size=(2000, 384)), rng.normal(size=(1024, 384)).astype(np.float32)
    best = retrieval._Best(_block(asked), 5)
    best.add(None, _part(chunks[:512]))
    part = _part(chunks[512:], 512)
    assert part.double.size and part.single.size
    tracemalloc.start()
    try:
        question, _, _ = best._candidates(np.arange(2000), part)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(question) > 4000
    assert peak < 20e6
    best.add(None, part)
    found = best.table().to_pydict()
    assert set(zip(found["question_id"], found["chunk_id"])) == _first_five(asked, chunks)


@pytest.mark.parametrize("shape", [(0, 5), (1, 7), (3, 8), (13, 21)])
def test_places_of_set_flags(shape):
    flags = np.random.default_rng(8).random(shape) < 0.1
    flags.ravel()[-1:] = True
    assert retrieval._true_places(flags).tolist() == np.flatnonzero(flags).tolist()


@pytest.mark.parametrize("limit", [7, 12])
def test_a_few_chunks_bound_the_answers_of_many_questions(spark, data, limit, monkeypatch):
    asked, store = data
    # Ids repeat and are null; such questions share their k answers.
    twice = [(None if i % 4 == 0 else i % 3, *row[1:]) for i, row in enumerate(asked)]
    table, chunks = spark.createDataFrame(twice, ASKED), spark.createDataFrame(store, STORE).repartition(3)
    whole = retrieval.nearest_chunks(table, chunks, 4, question_category="wanted")
    given, score = [], retrieval._score_resident
    monkeypatch.setattr(retrieval, "_score_resident", lambda block, *rest: given.append(block) or score(block, *rest))
    monkeypatch.setattr(retrieval, "RESIDENT_QUESTIONS", 6)
    monkeypatch.setattr(retrieval, "_FIRST_OF", 8)
    monkeypatch.setattr(retrieval, "_LEAST_FIRST", 1)
    found = retrieval.nearest_chunks(table, chunks, 4, question_category="wanted", resident_limit=limit)
    key = lambda r: (str(r.question_id), r["rank"], r.chunk_id, abs(r.distance))
    assert sorted(map(key, found.collect())) == sorted(map(key, whole.collect()))
    bounds = [block for block in given if "worst" in block.column_names]
    assert sum(block.num_rows for block in bounds) == len(asked) and 2 * len(bounds) == len(given)
    assert any(np.isfinite(block.column("worst").to_numpy()).any() for block in bounds)
    monkeypatch.undo()
    unique = retrieval.nearest_chunks(spark.createDataFrame(asked, ASKED), chunks, 4, question_category="wanted", resident_limit=limit)
    assert rows(unique) == brute(asked, store, 4)
