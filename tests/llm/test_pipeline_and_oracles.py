"""The registered queries against SQL, and the corpus pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import queries
from marketlake.llm.common import connected_components

TABLES = "documents embeddings pages benchmark labels conversations".split()


def found_by_sql(sql, sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    out = db.execute(sql)
    names = [c[0] for c in out.description]
    return sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in out.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    df = queries.registered()[name](spark, sf_dir)
    rows = sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    assert rows == found_by_sql(queries.ORACLES[name], sf_dir)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["accept_quality", "drop_near_duplicates", "mix_to_targets", "encode_tokens"]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf_dir).cache()
    assert good.columns == corpus_pipeline.COLUMNS
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").join(docs, "doc_id", "left_semi")
    assert labels.join(good, "doc_id", "left_semi").count() >= 0.97 * labels.count()  # clean documents stay
    one = stages["near_duplicates"](spark, good, sf_dir).cache()
    assert one.columns == corpus_pipeline.COLUMNS and one.count() == one.select("doc_id").distinct().count()
    again = stages["near_duplicates"](spark, one, sf_dir)
    assert sorted(r[0] for r in again.select("doc_id").collect()) == sorted(r[0] for r in one.select("doc_id").collect())
    assert good.join(one.select("text"), "text", "left_anti").count() == good.count() - good.join(one.select("text"), "text", "left_semi").count()
    mixed = stages["mixing"](spark, one, sf_dir).cache()
    assert mixed.columns == corpus_pipeline.COLUMNS
    tokens = stages["tokens"](spark, mixed, sf_dir)
    texts = lambda df: sorted(r["text"] for r in df.select("text").collect())
    assert texts(tokens) == texts(mixed)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, tokens.collect()))


def test_stages_on_awkward_tables(spark, sf_dir, awkward_docs, no_docs):
    clash = awkward_docs.withColumn("score", F.lit(1)).withColumn("one", F.lit("x")).withColumn("_key", F.lit(2))
    for docs in (clash, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).collect()
    kept = corpus_pipeline.drop_near_duplicates(spark, clash, sf_dir).select("doc_id").collect()
    assert sorted((r[0] for r in kept), key=repr) == [1, 2, 3, 4, 5, 8, 9, None]


def test_components_of_any_shape(spark, rows):
    n = 200
    edges = [(i, i + 1) for i in range(n)] + [(1000, 2000 + i) for i in range(n)] + [(5000, 5000)]
    found = rows(connected_components(spark.createDataFrame(edges, "a long, b long")))
    wanted = [(i, 0) for i in range(n + 1)] + [(1000, 1000)] + [(2000 + i, 1000) for i in range(n)]
    assert found == sorted(wanted, key=repr)


def test_near_duplicates_go_by_row(spark, sf_dir, docs_schema):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, b), (2, a + " more"), (2, c), (None, b + " more"), (None, "z " + c), (None, "no copy of any other row"), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs_schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).select("doc_id", "text").collect()
    wanted = [(1, a), (2, b), (2, c), (None, "no copy of any other row"), (3, "")]
    assert sorted(map(tuple, kept), key=repr) == sorted(wanted, key=repr)
    nameless = docs.where("text <> ''").withColumn("doc_id", F.lit(None).cast("long"))
    assert corpus_pipeline.drop_near_duplicates(spark, nameless, sf_dir).count() == 4
