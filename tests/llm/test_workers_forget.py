"""A Python worker keeps nothing of one task's texts for the tasks that follow."""

import pyarrow as pa

from sheetloom.llm import pieces as P
from sheetloom.llm.common import on_workers


def test_segments_are_forgotten_at_the_end_of_a_task(spark):
    docs = spark.createDataFrame([(i, f"words of text {i} und so weiter, №{i * 7}") for i in range(400)], "doc_id long, text string").repartition(8)
    path = P.default_path()
    want = {i: len(P.lattice(path).encode(t)[0]) for i, t in docs.collect()}
    assert {r.doc_id: r.pieces.n_pieces for r in P.encode(docs).collect()} == want

    def left(batches):
        for _ in batches:
            pass
        model = P.lattice(path)
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(model.known) + len(model.searched)], pa.int64())})

    assert [r.n for r in on_workers(spark.range(8).repartition(8)).mapInArrow(left, "n long").collect()] == [0] * 8
