"""Each stage against a plain version on its own input, and the queries with SQL against it."""

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_ORACLE, SF_SMALL
from llm_helpers import components, edge_docs, fingerprint, no_docs  # noqa: F401
from test_decontaminate import leaks
from test_exact_dedup import expected as exact_groups
from test_exact_dedup import normal
from tidepool.llm import toxicity
from tidepool.llm.common import materialize, table
from tidepool.llm.oracle import ORACLE_SQL
from tidepool.llm.queries import QUERIES, id_remainder, tokenizer_path
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module", autouse=True)
def short_training():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "LEAST_STEPS", 20)
        yield


@pytest.fixture(scope="module")
def stages(spark, short_training):
    """Input and output of every stage over the small tables."""
    docs, out = table(spark, SF_SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF_SMALL), name)
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_names_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup",
                                                      "decontamination", "bpe"]
    columns = table(spark, SF_SMALL, "documents").columns
    assert all(after.columns == columns for n, (_, after) in stages.items() if n != "bpe")


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    labels = table(spark, SF_SMALL, "labels").where(id_remainder("doc_id", 5) != 0)
    scored = toxicity.score(before, toxicity.fit(before, labels))
    assert ids(after) == ids(scored.where(~F.col("toxic")))


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    groups = exact_groups([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == sorted(i for i, _ in groups.values())
    assert len({normal(r["text"]) for r in after.collect()}) == after.count()


def test_simhash_stage(stages):
    before, after = stages["simhash_near_dedup"]
    fps = {r["doc_id"]: fingerprint(r["text"]) for r in before.collect()}
    nodes = sorted(fps)
    near = [(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if (fps[a] ^ fps[b]).bit_count() <= 3]
    assert ids(after) == sorted(set(components(nodes, near).values()))


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    hit = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in before.collect()], items)}
    assert ids(after) == sorted(set(ids(before)) - hit)


def test_bpe_stage(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(tokenizer_path())
    want = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids for r in before.collect()}
    assert {r["doc_id"]: r["ids"] for r in after.collect()} == want


def test_run_is_the_stages_in_turn(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages["bpe"][1].select("doc_id", "ids_sha256").collect()))


def test_stages_take_edge_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF_SMALL), f"edge-{name}")
        assert stage_ids(docs) <= set(range(1, 23)) | {None}
        assert corpus_pipeline.encode(spark, docs, SF_SMALL).count() == docs.count()


def stage_ids(docs):
    return {r["doc_id"] for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF_ORACLE).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert digest(got) == digest(want)


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
