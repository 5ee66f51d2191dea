"""Queries against DuckDB's SQL, and the pipeline against brute force stage by stage."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from aislane.llm import exact, quality
from aislane.llm.common import table
from aislane.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.common import awkward, empty, frame, prose
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_quality import KINDS, junk
from tests.llm.test_simhash import brute_groups, brute_print


def _rows(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_same_rows(spark, sf_dir, name):
    connection = duckdb.connect()
    for view in ("documents", "benchmark"):
        connection.execute(f"create view {view} as select * from '{sf_dir}/{view}.parquet'")
    result = connection.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    assert _rows(found.columns, found.collect()) == _rows(columns, result.fetchall())


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_registered():
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.fixture
def folder(spark, tmp_path):
    """Documents of every kind that a stage looks for, and benchmark items."""
    words = prose(900, 300).split()
    near = list(words)
    near[150] = "changed"
    longer = prose(903, 4000)
    rows = [(i, prose(i)) for i in range(200)]
    rows += [(300 + i, junk(KINDS[i % 4], 300 + i)) for i in range(40)]
    rows += [(400, prose(3).replace(" ", "  ")), (401, prose(4)), (402, prose(4))]
    rows += [(500, " ".join(words)), (501, " ".join(near)), (503, longer), (504, longer + " end"), (502, prose(901) + " " + prose(1000, 20) + " " + prose(902))]
    docs, odd = awkward(spark)
    items = [(1, prose(1000, 20)), (2, None)]
    frame(spark, rows + [(i and 600 + i, t) for i, t in odd]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), items


def test_pipeline_stage_by_stage(spark, folder):
    path, items = folder
    docs = table(spark, path, "documents")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, path)
        got[name] = after.collect()
        if name != "pieces":
            assert after.columns == docs.columns
            docs = spark.createDataFrame(got[name], docs.schema)
    everything = table(spark, path, "documents").collect()

    kept = [r.doc_id for r in got["quality"]]
    assert set(range(200)) <= set(kept) and len([i for i in kept if i and 300 <= i < 340]) <= 2
    assert not any(r.text is None or not r.text.split() for r in got["quality"])

    texts = [exact_key(r.text) for r in got["exact copies"]]
    assert sorted(texts) == sorted({exact_key(r.text) for r in got["quality"]})
    assert 400 in {r.doc_id for r in got["exact copies"]}

    before = got["exact copies"]
    prints = [brute_print(r.text) for r in before]
    label = brute_groups(len(before), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    first = [min((r.doc_id for k, r in enumerate(before) if label[k] == own and r.doc_id is not None), default=None) for own in set(label)]
    assert sorted(map(str, first)) == sorted(str(r.doc_id) for r in got["near copies"])
    assert len(first) < len(before) and 502 in first

    clean = [r.doc_id for r in got["near copies"] if not brute_hits(r.text, items)[1]]
    assert sorted(map(str, clean)) == sorted(str(r.doc_id) for r in got["decontamination"])
    assert 502 not in clean

    assert len(got["pieces"]) == len(got["decontamination"]) and all(r.lossless for r in got["pieces"])
    assert all(len(r.piece_ids) == r.n_pieces for r in got["pieces"])
    assert len(everything) > len(kept) > len(got["pieces"])


def exact_key(text):
    return (text or "").encode().translate(None, exact.WHITE_SPACE)


def test_run_is_the_stages(spark, folder):
    path, _ = folder
    docs = table(spark, path, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    again = corpus_pipeline.run(spark, path)
    assert _rows(again.columns, again.collect()) == _rows(docs.columns, docs.collect())


def test_pipeline_over_nothing(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert quality.KEEP_FROM == 0.5
