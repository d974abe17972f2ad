"""The pipeline's stages on a small table, and the registration without the folder."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import corpus_pipeline
import pytest
from fixtures import PASSAGE, prose

from rosterline.llm.common import staged_folders

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def corpus():
    """Clean documents, copies, near copies, a shared passage, personal data and junk."""
    clean = [f"{prose(i, 150)}" for i in range(12)]
    near = clean[0].split()
    near[70] = "other"
    texts = [
        *clean,
        clean[1],
        " ".join(near),
        f"{prose(50, 120)} {PASSAGE} {prose(51, 60)}",
        f"{prose(52, 120)} {PASSAGE} {prose(53, 60)}",
        f"{prose(54, 80)} write to someone@mail.example.com or +1 (386) 555-8773",
        "short",
        "buy now " * 100,
        None,
        "",
    ]
    return [(i, t, "xx", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], "").cache())
    return out


def test_stages_have_the_columns_of_documents(stages):
    for df in stages[:-1]:
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [tuple(c.split()) for c in SCHEMA.split(", ")]


def test_quality_drops_what_it_rejects(stages):
    assert {r.doc_id for r in stages[1].collect()} == set(range(17))
    assert Counter(map(tuple, stages[1].collect())) <= Counter(corpus())


def test_one_of_each_group_stays(stages):
    assert {r.doc_id for r in stages[2].collect()} == {*range(12), 14, 15, 16}


def test_passages_go_and_other_texts_stay(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    for i, text in before.items():
        if i in (14, 15):
            assert "passage" not in after[i].text and after[i].text.split() == [
                w for w in text.split() if not w.startswith("passage")
            ]
        else:
            assert after[i].text == text
        assert after[i].n_chars == len(after[i].text)


def test_personal_data_is_masked(stages):
    after = {r.doc_id: r for r in stages[4].collect()}
    assert after[16].text.endswith("write to <EMAIL> or <PHONE>") and after[16].n_chars == len(after[16].text)
    before = {r.doc_id: r.text for r in stages[3].collect()}
    assert all(after[i].text == t for i, t in before.items() if i != 16)


def test_every_document_left_is_packed(stages):
    assert {r.doc_id for r in stages[5].collect()} == {r.doc_id for r in stages[4].collect()}


def test_run_applies_the_stages(spark, tmp_path, stages):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    with staged_folders() as folders:
        found = corpus_pipeline.run(spark, str(tmp_path))
    left = [folder for folder in folders if os.path.exists(folder)]
    assert len(left) < len(folders) / 3 and found.inputFiles()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(
        map(tuple, stages[5].select(columns).collect())
    )


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_works_without_the_folder(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = (
        "import __spark_entry__ as e; q = e.queries(); assert 'timeline_merge' in q and 'pipeline' not in q;"
        " assert set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})


def test_entry_registers_every_operator():
    import __spark_entry__ as contract

    names = list(contract.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)
