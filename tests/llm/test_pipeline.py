"""The pipeline, stage by stage on its own input, and the registered queries."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from shelfwise.llm import common
from tests.llm.test_near import lines_expected, near_expected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == columns
        before, after = docs.collect(), made.collect()
        out.append((before, after))
        docs = spark.createDataFrame(after, made.schema)
    return dict(zip([n for n, _ in corpus_pipeline.STAGES], out))


def test_quality_rejects(steps):
    before, after = steps["quality rules"]
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    assert 0 < len(after) < len(before) and all(words[r.doc_id] >= 50 for r in after)
    assert set(after) <= set(before)


def test_lines_go(steps):
    before, after = steps["line dedup"]
    gone = lines_expected([(r.doc_id, r.text) for r in before])
    want = {
        r.doc_id: "\n".join(x for i, x in enumerate(r.text.split("\n")) if (r.doc_id, i) not in gone)
        for r in before
    }
    assert gone and {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_stays(steps):
    before, after = steps["MinHash near-dedup"]
    flags = near_expected([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(k for k, *_, kept in flags if kept)


def test_mix_and_encode(steps):
    before, after = steps["mixing"]
    assert max(Counter(r.doc_id for r in after).values()) <= 3 and {*after} <= {*before}
    before, after = steps["byte-level BPE"]
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in after) == sorted(
        (r.doc_id, r.text) for r in before
    )


def test_run_equals_the_stages(spark, steps):
    made = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in made) == sorted(r.doc_id for r in steps["byte-level BPE"][1])


ODD = ["key", "row", "id", "body", "at", "size", "copies", "origin", "token", "set_key", "found"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents of the test table with nulls in every column, empty, long and repeated ones, and
    columns named like those used inside."""
    path = tmp_path_factory.mktemp("odd")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    at = {c: i for i, c in enumerate(docs.columns)}

    def changed(row, **values):
        out = list(row)
        for c, v in values.items():
            out[at[c]] = v
        return tuple(out)

    good = max(rows, key=lambda r: len(r[at["text"]] or ""))
    more = [changed(good, **{c: None}) for c in docs.columns] + [(None,) * len(at)]
    more += [changed(good, doc_id=10**6, text=""), changed(good, doc_id=10**6 + 1, text=" \n\t"), good, good]
    more += [changed(good, doc_id=10**6 + 2, text="\n".join([good[at["text"]]] * 20))]
    frame = spark.createDataFrame(rows + more, docs.schema)
    for name in ODD:
        frame = frame.withColumn(name, F.lit("x"))
    frame.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_odd_documents_go_through(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, odd)
        assert made.columns == columns, name
        rows = made.collect()
        assert rows and all(r[c] == "x" for r in rows for c in ODD)
        docs = spark.createDataFrame(rows, made.schema)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, odd).collect()
    assert len(final) == docs.count()


def test_empty_table_goes_through(spark, odd, tmp_path):
    spark.read.parquet(f"{odd}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_tables_of_earlier_stages_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    corpus_pipeline.run(spark, SF).count()
    kept = {p.name.split("-", 1)[1] for p in tmp_path.glob("llm-*/*")}
    # What the last stage reads, and the tables of the last stage that made any.
    assert "stage-3" in kept and not kept & {"stage-0", "stage-1", "described", "lines", "first-links"}


def test_every_operator_has_one_query():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
