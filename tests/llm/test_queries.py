"""The registered queries against their SQL, and against plain Python where there is none."""

import hashlib
from pathlib import Path

import duckdb
import pytest
import sentencepiece

from gabarito.llm.queries import PIECES, QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in sorted(DATA.glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in result.fetchall())
    assert got


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op5_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op5_pieces"](spark, str(DATA)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "")
        want = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_op6_sums_over_pre_tokens(spark):
    from gabarito.llm.token_counts import MARK, PRE_TOKEN, Trie, Unigram

    model = Unigram(open(PIECES, "rb").read())
    alone = {}

    def count(word):
        if word not in alone:
            trie = Trie(model)
            trie.insert([word])
            alone[word] = trie.terminal[word]
        return alone[word]

    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 600").select("doc_id", "text").collect())
    found = {r["doc_id"]: r for r in QUERIES["op6_token_counts"](spark, str(DATA)).collect()}
    for i, text in texts.items():
        words = PRE_TOKEN.findall(MARK + text.replace(" ", MARK))
        assert (found[i]["n_pretokens"], found[i]["n_tokens"]) == (len(words), sum(map(count, words)))


def test_op8_holds_its_law(spark):
    rows = QUERIES["op8_shards"](spark, str(DATA)).collect()
    sizes = [sum(r["shard"] == s for r in rows) for s in range(16)]
    assert sum(sizes) == spark.read.parquet(f"{DATA}/documents.parquet").count() and max(sizes) - min(sizes) <= 1
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s in range(16) for k in range(sizes[s])]
