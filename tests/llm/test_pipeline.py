"""The stages one by one against plain computations, the whole run, and the registered SQL."""

from __future__ import annotations

import os
import re
from collections import defaultdict

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from loanrisk.llm import langid, packing, queries, secret_scan
from tests.llm.test_near_copies import plain_fingerprint, plain_roots
from tests.llm.test_text_operators import check_packing


def test_all_are_registered():
    names = entry_point.queries()
    assert [name for name in names if re.match(r"op\d+_", name)] == list(queries.queries())
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(entry_point.oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_exact_dedup_matches_its_sql(spark, scale_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{scale_dir}/documents.parquet'")
    df = entry_point.queries()["op3_exact_dedup"](spark, scale_dir)
    relation = connection.sql(entry_point.oracle_sql()["op3_exact_dedup"]).select(*map(duckdb.ColumnExpression, df.columns))
    assert sorted(relation.fetchall()) == sorted(tuple(row) for row in df.collect())


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_stages_one_by_one(spark, scale_dir, documents, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    docs, given = documents, {row["doc_id"]: row for row in documents.collect()}

    predicted = langid.predict(docs, queries.language_model(docs)).collect()
    docs = written(stages["language_id"](spark, docs, scale_dir), tmp_path / "0")
    assert docs.columns == documents.columns
    assert {r["doc_id"] for r in docs.collect()} == {
        r["doc_id"] for r in predicted if r["lang_pred"] != "und" and r["score"] >= 0.5
    }

    before = docs.collect()
    best = defaultdict(int)
    for row in before:
        normal = row["text"].encode().lower()
        best[normal] = max(best[normal], row["doc_id"])
    docs = written(stages["exact_dedup"](spark, docs, scale_dir), tmp_path / "1")
    assert docs.columns == documents.columns and {r["doc_id"] for r in docs.collect()} == set(best.values())

    before = docs.collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in before}
    roots, first = plain_roots(prints.values()), {}
    for doc_id in sorted(prints):
        first.setdefault(roots[prints[doc_id]], doc_id)
    docs = written(stages["near_dedup"](spark, docs, scale_dir), tmp_path / "2")
    assert docs.columns == documents.columns and {r["doc_id"] for r in docs.collect()} == set(first.values())
    assert all(row == given[row["doc_id"]] for row in docs.collect())

    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = written(stages["secret_scan"](spark, docs, scale_dir), tmp_path / "3")
    assert docs.columns == documents.columns
    after = {r["doc_id"]: r for r in docs.collect()}
    assert set(after) == set(before)
    for doc_id, text in before.items():
        clean = re.sub(r'(?i)(token = ")[0-9a-f]{40}"', lambda m: f'{m.group(1)}{secret_scan.REPLACEMENT}"', text)
        assert after[doc_id]["text"] == clean and after[doc_id]["n_chars"] == len(clean)

    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.BPE_FILE))
    packed = stages["packing"](spark, docs, scale_dir)
    check_packing(packed.collect(), docs, tokenizer, packing.CAPACITY)


def test_run_gives_what_its_stages_give(spark, scale_dir, documents, tmp_path):
    docs = documents
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, scale_dir), tmp_path / str(number))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, scale_dir)
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, docs.select(columns).collect()))
    # Of the tables between the stages only the last is left.
    folders = {os.path.dirname(file.replace("file://", "")) for file in whole.inputFiles()}
    (left,) = folders
    assert os.listdir(os.path.dirname(left)) == [os.path.basename(left)] == ["4_packing"]


def test_stages_take_odd_and_empty_tables(spark, scale_dir, odd_documents, no_documents, tmp_path):
    for name, docs in (("odd", odd_documents), ("none", no_documents)):
        columns = docs.columns
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            alone = stage(spark, odd_documents if name == "odd" else no_documents, scale_dir)
            docs = written(stage(spark, docs, scale_dir), tmp_path / f"{name}{number}")
            assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == alone.columns == columns
        assert (docs.count() > 0) == (name == "odd")
