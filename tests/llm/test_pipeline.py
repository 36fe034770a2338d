"""The pipeline's stages, each against brute force on its own input, and the driver's contract."""

import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_dedup_shards_counts import UP
from tests.llm.test_near_copies import slow_near
from tests.llm.test_packing_decontamination import check_round_trip, slow_matches
from tidepanel.llm import decontaminate, toxicity

OWN = [f"op{n}_" for n in range(1, 14)]


@pytest.fixture(scope="module")
def folder(spark, docs, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.unionByName(given.selectExpr("doc_id + 5000 AS doc_id", "text", "lang", "source", "n_chars"), allowMissingColumns=True).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id + 5000 AS doc_id", "quality", "toxic").write.parquet(f"{path}/labels.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage(spark, folder):
    from tokenizers import Tokenizer

    from tests.llm.test_packing_decontamination import PATH

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = spark.read.parquet(f"{folder}/labels.parquet"), [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    longest = max(len(decontaminate.terms(t)) for _, t in items)
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, folder)
        if name == "packing":
            check_round_trip(out.collect(), before, Tokenizer.from_file(PATH))
            break
        assert out.columns == docs.columns
        after = [(r["doc_id"], r["text"]) for r in out.collect()]
        if name == "toxicity":
            score = toxicity._scorer(*toxicity.fit(docs, labels).gram_scores())
            assert Counter(after) == Counter(x for x in before if score(x[1]) < 0.5)
        elif name == "exact dedup":
            key = lambda t: (t or "").translate(UP)
            best = {}
            for i, t in before:
                best[key(t)] = max(-1 if i is None else i, best.get(key(t), -1))
            assert Counter((key(t), -1 if i is None else i) for i, t in after) == Counter(best.items())
        elif name == "near dedup":
            assert Counter(after) == slow_near(before)
        else:
            assert Counter(after) == Counter(x for x in before if not slow_matches(x[1], items, longest))
        assert 0 < len(after) <= len(before)
        out.write.parquet(path := f"{folder}/{name.replace(' ', '-')}.parquet")
        docs = spark.read.parquet(path)


def test_stages_on_empty_documents(spark, folder, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0, name


def test_registered_queries(spark, folder, sf_dir):
    names = entry.queries()
    for prefix in OWN:
        assert sum(n.startswith(prefix) for n in names) == 1
    assert names["pipeline"](spark, folder).count() > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    for name in ("op3_suffix_tree_repeats", "op5_sparse_suffix_passages", "op7_bloom_exact_dedup", "op11_sibling_shift_merkle", "op12_cap_filter_links"):
        df = names[name](spark, sf_dir)
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
        assert Counter(map(tuple, df.collect())) == Counter(want), name


def test_the_entry_works_without_the_text_operators():
    import subprocess

    code = "import sys; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; assert len(e.queries()) > 100 and 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0])
