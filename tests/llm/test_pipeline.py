"""The stages of the pipeline on the small tables, each against what its operator says about its own input."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from quadrille.llm import decontaminate, line_dedup, ngram_join
from quadrille.llm.queries import QUERIES
from quadrille.llm.tables import read_table, stored
from tests.conftest import SF
from tests.llm.test_operators import contaminated, groups, without_passages


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stored(stage(spark, docs, SF), "stage")
        if name != "best-fit packing":
            assert docs.columns == columns, name
    texts = {name: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()] for name, df in seen.items()}
    good, one, cut, clean = (texts[n] for n in ("n-gram jaccard join", "substring dedup", "benchmark decontamination", "best-fit packing"))
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    gone = {d for d, _ in texts["quality classifier"]} - {d for d, _ in good}
    assert gone and sum(labels.get(d, 0) == 0 for d in gone) >= 0.9 * len(gone)
    assert sorted(d for d, _ in one) == sorted(d for d, _, c in groups(good) if d == c)
    assert dict(cut) == without_passages(one)
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    assert sorted(d for d, _ in clean) == sorted(r[0] for r in contaminated(cut, items) if not r[-1])
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {d for d, _ in clean}
    assert max(r.n for r in docs.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()) <= 2048


def test_rows_with_repeated_and_null_ids(spark):
    words = lambda tag, n=40: " ".join(f"{tag}{k}" for k in range(n))
    item = next(r.text for r in read_table(spark, SF, "benchmark").collect() if len((r.text or "").split()) >= 13)
    copies = [(5, words("a")), (5, words("a")), (5, words("a") + " end"), (None, words("a")), (9, words("a")), (None, words("b")), (None, words("b")), (7, words("c"))]
    both = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for table in (both(copies), stored(both(copies), "copies")):
        kept = corpus_pipeline.keep_one_of_each_group(spark, table, SF).collect()
        assert sorted((str(r.doc_id), r.text[:1]) for r in kept) == [("5", "a"), ("7", "c"), ("None", "b")]
    mixed = [(1, item), (1, words("clean")), (None, item), (None, words("other")), (2, item)]
    assert sorted(r.text[:5] for r in corpus_pipeline.keep_clean(spark, both(mixed), SF).collect()) == ["clean", "other"]


#: Names that the operators use themselves.
CLASH = ("_score", "_quality", "score", "spans", "_spans", "_number", "number", "_own", "_gone_id", "mark", "_row", "file", "file_path", "row_index", "_path", "_place", "_file", "_at", "start", "_metadata")


def test_clashing_names_keep_their_values(spark):
    docs = read_table(spark, SF, "documents").limit(60)
    for k, name in enumerate(CLASH):
        docs = docs.withColumn(name, F.lit(k))
    table = stored(docs, "clash")
    for name, stage in corpus_pipeline.STAGES:
        table = stored(stage(spark, table, SF), "clash")
        if name != "best-fit packing":
            assert table.columns == docs.columns, name
            assert {tuple(r) for r in table.select(*CLASH).distinct().collect()} == {tuple(range(len(CLASH)))}, name
    assert table.count() > 0


def test_empty_tables_and_long_texts(spark):
    docs = read_table(spark, SF, "documents")
    table = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        table = stored(stage(spark, table, SF), "empty")
        assert table.count() == 0, name
    long = " ".join(f"word{k % 9001}x{k % 77}" for k in range(120_000))
    rows = [(1, long, "en", "a", len(long)), (2, "short " + long, "en", "a", 0), (3, None, None, None, 7), (4, "", "en", "a", 0)]
    table = stored(spark.createDataFrame(rows, docs.schema), "long")
    assert corpus_pipeline.keep_one_of_each_group(spark, table, SF).count() == 3
    cut = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, table, SF).collect()}
    assert cut == {1: (long, len(long)), 2: ("short", 5), 3: (None, 7), 4: ("", 0)}
    assert corpus_pipeline.keep_clean(spark, table, SF).count() == 4
    assert corpus_pipeline.keep_good(spark, table, SF).count() <= 4


def test_of_equal_rows_one_keeps_its_text(spark):
    words = " ".join(f"w{k}" for k in range(60))
    rows = [(1, words), (1, words), (None, "x " + words), (None, "x " + words), (0, words + " end")]
    for table in (spark.createDataFrame(rows, "doc_id long, text string").repartition(3), stored(spark.createDataFrame(rows, "doc_id long, text string"), "equal")):
        got = line_dedup.without_repeats(table, unit="passage").collect()
        assert sorted(((str(r.doc_id), r.text) for r in got)) == [("0", words + " end"), ("1", ""), ("1", ""), ("None", ""), ("None", "x")]
        lines = line_dedup.without_repeats(table.where("doc_id = 1")).collect()
        assert sorted(r.text for r in lines) == ["", words]


def test_every_query_is_listed():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert decontaminate.SHINGLE <= 13 and ngram_join.ORDER_FRAGMENTS > 1
