"""The registered text queries, the pipeline, and the pipeline's stages against brute force."""

import collections

import duckdb
import pyarrow as pa
import pytest
from cases import docs, empty, odd_rows
from test_shard_mix import brute_targets
from test_simhash import brute_components, brute_fingerprint, near_rows

import __spark_entry__ as entry
import corpus_pipeline
from compare import canonical
from stockcast.llm import queries
from stockcast.session import ARROW_BYTES, TEXT_BATCH

FOLDER = "/root/testdata/sf0.001"
ROWS = {"op1": "pages", "op2": "documents", "op3": "documents", "op4": "documents", "op6": "documents", "op7": "documents",
        "op9": "documents", "op10": "documents", "op12": "documents", "op13": "documents"}


def test_all_are_registered():
    names = {n.split("_")[0] for n in queries.registered()}
    assert names == {f"op{n}" for n in range(1, 14)} | {"pipeline"} and set(queries.registered()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in queries.registered() if n.split("_")[0] in ROWS])
def test_one_row_per_input_row(spark, name):
    got = entry.queries()[name](spark, FOLDER)
    assert got.count() == spark.read.parquet(f"{FOLDER}/{ROWS[name.split('_')[0]]}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, FOLDER)
    assert canonical(df.collect(), df.columns) == canonical(cur.fetchall(), names)


def test_pipeline_runs(spark):
    got = entry.queries()["pipeline"](spark, FOLDER)
    rows = got.select("sequence_id", "length").collect()
    assert len({r.sequence_id for r in rows}) == len(rows) > 0
    assert all(r.length & (r.length - 1) == 0 for r in rows)


def test_stages_bear_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (docs(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, str(tmp_path))
            assert out.columns == rows.columns, name
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)).count() >= rows.count()


def test_stages_against_brute_force(spark, tmp_path):
    rows = near_rows() + odd_rows()
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["simhash_near_dedup"](spark, stages["toxicity"](spark, docs(spark, rows), str(tmp_path)), str(tmp_path)).collect()
    groups = brute_components(list(range(len(rows))), [brute_fingerprint(r[1]) for r in rows])
    assert len(kept) == len(set(groups))
    left = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in kept]
    cut = [tuple(r) for r in stages["suffix_array_dedup"](spark, docs(spark, left, clashes=False), str(tmp_path)).collect()]
    assert all(r[4] == len(r[1]) for r in cut if r[1] is not None) and len(cut) == len(left)
    mixed = stages["source_mixing"](spark, docs(spark, cut, clashes=False), str(tmp_path)).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in cut:
        sizes[r[3]] += len((r[1] or "").encode().split())
    for r in mixed:
        taken[r.source] += len((r.text or "").encode().split())
    largest = max(len((r[1] or "").encode().split()) for r in cut)
    want = brute_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes)
    assert {tuple(r) for r in mixed} <= set(cut)


def test_stages_send_texts_in_small_batches(spark, tmp_path):
    """Each batch of a stage has about the bound at most; a session's own bound stays."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [len(batch)], "bytes": [batch.nbytes]})

    @corpus_pipeline.stage
    def measured(spark, rows, folder):
        return rows.mapInArrow(sizes, "rows long, bytes long")

    long = spark.range(200, numPartitions=1).selectExpr("id AS doc_id", "repeat('x', 100000) AS text")
    spark.conf.unset(ARROW_BYTES)
    found = measured(spark, long, str(tmp_path)).collect()
    assert sum(r.rows for r in found) == 200 and all(r.bytes <= TEXT_BATCH + 200_000 for r in found)
    for own, most in ("1000", 1), ("1g", 200):
        spark.conf.set(ARROW_BYTES, own)
        assert max(r.rows for r in measured(spark, long, str(tmp_path)).collect()) == most
    spark.conf.unset(ARROW_BYTES)


def test_mixing_starts_no_python_worker(spark, tmp_path):
    docs(spark, clashes=False).write.parquet(f"{tmp_path}/docs")
    mixed = dict(corpus_pipeline.STAGES)["source_mixing"](spark, spark.read.parquet(f"{tmp_path}/docs"), str(tmp_path))
    plan = mixed._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "BroadcastHashJoin" in plan
