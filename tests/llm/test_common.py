import pyarrow as pa
import pytest

from tablesync.llm.common import tidied
from tablesync.llm.packing import packed_documents
from tablesync.llm.parity_join import linked


@pytest.mark.parametrize("operator", [linked, packed_documents])
def test_workers_hold_no_words_after_a_task(spark, documents, prose, operator):
    def held(batches):
        from tablesync.llm import packing, parity_join

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(parity_join._words) + sum(map(len, packing._memos.values()))]})

    operator(documents([(i, prose(i, 80)) for i in range(40)])).collect()
    found = spark.range(0, 64, 1, 32).mapInArrow(held, "n long").collect()
    assert len(found) >= 32 and {r.n for r in found} == {0}


def test_memos_are_emptied_however_a_task_ends():
    calls = []

    def work(items):
        for x in items:
            if x < 0:
                raise ValueError
            yield x

    assert [*tidied(work, lambda: calls.append("end"))([1, 2])] == [1, 2] and calls == ["end"]
    with pytest.raises(ValueError):
        [*tidied(work, lambda: calls.append("error"))([1, -1])]
    part = tidied(work, lambda: calls.append("left"))([1, 2])
    next(part)
    part.close()
    assert calls == ["end", "error", "left"]
