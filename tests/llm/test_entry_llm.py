"""Registry, oracles and the pipeline."""

import hashlib
import struct

import brute
import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from mutualis.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, res.fetchall()))


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage's rows, by its predecessor's rows."""
    from tokenizers import Tokenizer

    from mutualis.llm import bpe
    texts = brute.awkward_texts()
    passage = " ".join(f"p{i}" for i in range(70))
    texts += [f"{passage} " + " ".join(f"q{j}x{i}" for i in range(90)) for j in range(4)]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[5])
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs, got = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "bpe_encode":
            assert docs.dtypes == spark.createDataFrame([], schema).dtypes
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        got.append(docs.collect())
    good = sorted((r for r in rows if brute.kept(r[1])), key=lambda r: r[0])
    assert sorted(map(tuple, got[0])) == good
    low = brute.groups([brute.fingerprint(r[1]) for r in good])
    one = [r for i, r in enumerate(good) if low[i] == i]
    assert sorted(map(tuple, got[1])) == one
    cut = []
    for r in one:
        later, _ = brute.repeats([(x[0], x[1]) for x in one], 50)[r[0]]
        left = [w for i, w in enumerate(brute.words(r[1])) if i not in later]
        if left or not later:
            cut.append((r[0], left))
    assert sorted((r["doc_id"], brute.words(r["text"])) for r in got[2]) == cut
    assert any(len(w) < len(brute.words(dict((r[0], r[1]) for r in one)[i])) for i, w in cut)
    assert all(r["n_chars"] == len(r["text"]) for r in got[2])
    assert {r["doc_id"] for r in got[3]} == {r["doc_id"] for r in got[2]}
    assert max(sum(x["doc_id"] == r["doc_id"] for x in got[3]) for r in got[2]) <= 2
    library = Tokenizer.from_file(bpe.default_tokenizer())
    text = {r["doc_id"]: r["text"] for r in got[3]}
    assert len(got[4]) == len(got[3])
    for r in got[4]:
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_pipeline_without_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
