"""The corpus pipeline against its parts by brute force, and the registered queries' SQL."""

import hashlib
import os

import duckdb
import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from sluice.llm.decontaminate import SuffixAutomaton
from sluice.llm.common import alnum_words
from sluice.llm.prefix_bpe import load_ranks
from sluice.llm.queries import ORACLE_SQL, QUERIES, SURROGATE_KEY
from sluice.llm.surrogates import Replacer

from .test_decontaminate import brute as hits
from .test_jaccard_join import brute as classes
from .test_quality_cascade import counted

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    frame, rows = docs, {r.doc_id: r for r in docs.collect()}
    items = [(str(r.item_id), alnum_words((r.text or "").encode())) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    *first, (_, last) = corpus_pipeline.STAGES
    got = {}
    for name, stage in first:
        frame = stage(spark, frame, SMALL)
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        assert frame.schema.names == docs.schema.names
        got[name] = {r.doc_id: r for r in frame.collect()}
    assert set(got["quality"]) == {i for i, r in rows.items() if counted(r.text)[-1]}
    members = classes([(i, r.text) for i, r in got["quality"].items()])
    assert set(got["near_duplicates"]) == {i for i, _, comp in members if i == comp}
    automaton = SuffixAutomaton(items, 13)
    for i, r in got["near_duplicates"].items():
        words = alnum_words(r.text.encode())
        hit, _ = hits(words, [x for x in items if x[0] in automaton.matches(words)[1]], 13)
        if hit and 20 * len(hit) >= len(words):
            left = got["decontamination"].get(i)
            assert left is None or (left.text != r.text and left.n_chars == len(left.text))
        else:
            assert got["decontamination"][i] == r
    replace = Replacer(SURROGATE_KEY).replace
    assert {i: r.text for i, r in got["private_data"].items()} == {i: replace(r.text)[0] for i, r in got["decontamination"].items()}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    final = {r.doc_id: r for r in last(spark, frame, SMALL).collect()}
    assert set(final) == set(got["private_data"])
    for i, r in final.items():
        ids = library.encode_ordinary(got["private_data"][i].text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(got["private_data"][i].text.encode()).hexdigest()
    assert {tuple(map(str, r)) for r in corpus_pipeline.run(spark, SMALL).collect()} == {tuple(map(str, r)) for r in final.values()}


def test_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    df = E.queries()[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(res.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_whole_table(spark, name):
    table = {"op7": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    df = E.queries()[name](spark, SMALL)
    df = df.where("component = 1") if table == "embeddings" else df
    ident = df.columns[0]
    want = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(ident).collect())
    assert sorted(r[0] for r in df.select(ident).collect()) == want
