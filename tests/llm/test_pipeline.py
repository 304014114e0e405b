"""The stages on a small table, and the registration of the queries."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from prefshare.llm import catalog, mixing
from prefshare.llm.oracle import PERIODIC_RUNS
from prefshare.sources.scratch import stage

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark):
    rows = [(i, f"the cat number {i} sat on its own mat {i} times and more", "en", f"src{i % 3}", 1) for i in range(40)]
    rows += [(100 + i, rows[0][1], "en", "src0", 1) for i in range(5)]
    rows += [(200, "12 34", None, None, 5), (201, None, "de", "src1", 0)]
    rows += [(202, "write to ab.12@mail.example.com about the dog that ran away", "en", "src2", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    left = docs
    for name, work in corpus_pipeline.STAGES[:-1]:
        left = work(spark, left, SF_DIR).cache()
        assert left.columns == docs.columns
        ids = sorted(r.doc_id for r in left.collect())
        if name == names[0]:
            assert ids == [*range(40), *range(100, 105), 202]
        else:
            assert ids == [*range(40), 202]
    one = left.filter("doc_id = 202").first()
    assert one.text == "write to [EMAIL] about the dog that ran away" and one.n_chars == len(one.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF_DIR)
    assert sorted(r.doc_id for r in packed.collect()) == [*range(40), 202]


def test_empty_tables_pass_all_stages(spark):
    docs = catalog.table(spark, SF_DIR, "documents").limit(0)
    for name, work in corpus_pipeline.STAGES:
        docs = stage(work(spark, docs, SF_DIR), name)
        assert docs.count() == 0
    assert "sequence_id" in docs.columns


def test_mix_decides_the_order_of_the_sequences(spark):
    """The last stage numbers its sequences by the order the mix was written in."""
    docs = catalog.table(spark, SF_DIR, "documents")
    mixed = stage(corpus_pipeline.mix_sources(spark, docs, SF_DIR), "mixed")
    place = {
        r.doc_id: r.mix_position
        for r in mixing.mix(docs, catalog.MIX_WEIGHTS, catalog.MIX_REST).collect()
    }
    packed = corpus_pipeline.pack_sequences(spark, mixed, SF_DIR).filter("offset = 0")
    leads = [r.doc_id for r in packed.orderBy("sequence_id").collect()]
    assert [place[i] for i in leads] == sorted(place[i] for i in leads)


def test_pipeline_on_the_tables(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    docs = catalog.table(spark, SF_DIR, "documents").collect()
    assert ids <= {r.doc_id for r in docs} and len(ids) >= 0.7 * len(docs)
    assert corpus_pipeline.ORACLE_SQL is None


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names if x.startswith("op")}
    assert "pipeline" in names and set(catalog.ORACLE) <= names


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF_DIR}/{name_}.parquet'")
    connection.execute(f"CREATE VIEW twin AS {catalog.ORACLE[name]}")
    result = connection.execute("SELECT * FROM twin")
    want = result.fetchall()
    df = catalog.QUERIES[name](spark, SF_DIR)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and got


def test_runs_equal_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    result = connection.execute(PERIODIC_RUNS)
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    df = catalog.QUERIES["op13_periodic_runs"](spark, SF_DIR)
    assert set(df.columns) == {*columns, "runs"}
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(r[1] for r in got)


def test_texts_of_one_id_are_judged_separately(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "x"])
    texts = [(1, "one clean text of its own"), (1, "another clean text that is not alike"), (2, " ".join(words)),
             (5, near), (5, "yet another text of a reused number"), (5, "yet another text of a reused number"),
             (6, "yet another text of a reused number"), (7, ""), (7, None), (None, near)]
    rows = [(i, t, "en", "s", 1) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    assert got == sorted((i or 0, t or "") for i, t in [*texts[:3], texts[4], *texts[7:]])
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SF_DIR).count() == 0
