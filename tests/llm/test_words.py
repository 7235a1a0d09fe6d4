from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quadrille.llm import line_dedup, words
from quadrille.llm.ngram_join import _share, _spread


def buffers(texts):
    return words.text_buffers(pa.array(texts))


@pytest.mark.parametrize("block", [1, 7, 1 << 17])
def test_word_hashes_depend_on_the_word_alone(monkeypatch, block):
    monkeypatch.setattr(words, "_BLOCK", block)
    found = words.find_words(*buffers(["One two  three", "", "two\n" * 50]))
    alone = [words.find_words(*buffers([w])).hash[0] for w in ["one", "TWO", "three", *["two"] * 50]]
    assert found.hash.tolist() == alone


def peak_of(run):
    run()
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_words_and_runs():
    """Bytes in use at once beside the texts, for a chunk of words and for a batch of several megabytes of runs."""
    text = " ".join(f"word{k * 7919 % 10007}" for k in range(100_000))
    assert peak_of(lambda: words.find_words(*buffers([text]))) < 24 * len(text)
    batch = pa.RecordBatch.from_pydict({"text": [text[k : k + 50_000] for k in range(0, len(text), 50_000)] * 4})
    assert peak_of(lambda: list(line_dedup._anchoring(16, 51)(iter([batch])))) < 24 << 20


def test_shared_ngrams_of_a_fragment():
    texts = ["a b c d", "b c d e", "x y z", "a b c d", None]
    batch = pa.RecordBatch.from_pydict({"_number": pa.array(range(5), pa.int64()), "_doc_id": pa.array(range(5), pa.int64()), "text": texts})
    table = pa.Table.from_batches(list(_spread(2, 1)(iter([batch]))))
    found = _share(1)(table.filter(pa.compute.is_valid(table["hashes"])))
    counts = words.joined(found["counts"], np.int32)
    owners = words.joined(found["numbers"], np.int64)
    # (a b) twice, (b c) and (c d) three times; (d e), (x y) and (y z) stay away.
    assert dict(zip(owners.tolist(), counts.tolist())) == {0: 3, 1: 2, 3: 3}


def test_what_another_stage_kept_goes(monkeypatch):
    kept, cleared = [], []

    class Keeper:
        def __init__(self, name):
            self.name = name

        def cache_clear(self):
            cleared.append(self.name)

    one, two = Keeper("one"), Keeper("two")
    monkeypatch.setattr(words, "KEEPERS", [one, two])

    def run(batches):
        kept.append(list(cleared))
        yield from batches

    assert list(words.releasing(run, one)(iter([1, 2]))) == [1, 2]
    assert kept == [["two"]] and "one" not in cleared


def test_batches_of_the_session_are_bounded(spark):
    from quadrille.llm.tables import BATCH_ROWS, small_batches

    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "4096")
        small_batches(spark)
        assert int(spark.conf.get(name)) == BATCH_ROWS
        spark.conf.set(name, "10")
        small_batches(spark)
        assert spark.conf.get(name) == "10"
    finally:
        spark.conf.set(name, before)
