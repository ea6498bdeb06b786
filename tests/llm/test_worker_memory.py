"""What a reused Python worker keeps from one task to the next."""

import shutil
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from pyspark import cloudpickle

from drillspark.llm import common, packing


@pytest.fixture
def loads(monkeypatch):
    """Paths of the tokenizers that are loaded, of tasks that run here."""
    seen, real = [], tokenizers.Tokenizer
    monkeypatch.setattr(tokenizers, "Tokenizer", SimpleNamespace(from_file=lambda path: seen.append(path) or real.from_file(path)))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    return seen


def task(path: str) -> list[dict]:
    texts = ["one two three", None, "", "Four 55 words, five"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(4), pa.int64()), "text": pa.array(texts, pa.string())})
    return [row for out in packing._tokenize_and_pack(packing.Packing(path))(iter([batch])) for row in out.to_pylist()]


def test_tasks_of_a_process_share_one_tokenizer(loads, tmp_path):
    path = shutil.copy(public_tokenizers.path("word_bpe_49k.json"), tmp_path / "tokenizer.json")
    first = task(str(path))
    assert [r["length"] > 1 for r in sorted(first, key=lambda r: r["doc_id"])] == [True, False, False, True]
    assert task(str(path)) == first == task(str(path))
    assert len(loads) == 1


def test_a_replaced_file_is_loaded_again(loads, tmp_path):
    path = tmp_path / "tokenizer.json"
    shutil.copy(public_tokenizers.path("word_bpe_49k.json"), path)
    first = task(str(path))
    path.write_text(path.read_text() + "\n")
    assert task(str(path)) == first
    assert len(loads) == 2


def test_freed_memory_is_given_back_when_a_task_is_done(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    run = common.giving_back(lambda batches: (2 * x for x in batches))
    assert list(run(iter([1, 2]))) == [2, 4] and calls == [1]
    # also of a task that is not read to its end
    cut = run(iter([1, 2]))
    assert next(cut) == 2 and calls == [1]
    cut.close()
    assert calls == [1, 1]


def test_tasks_that_come_by_value_share_one_tokenizer(tmp_path):
    import drillspark.llm.packing as module

    path = shutil.copy(public_tokenizers.path("word_bpe_49k.json"), tmp_path / "tokenizer.json")
    sent = cloudpickle.dumps(module._tokenizer)
    assert cloudpickle.loads(sent)(str(path)) is cloudpickle.loads(sent)(str(path))
