"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from searchlake.plans import registry
from searchlake.plans.compare import diff
from searchlake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
registry.load_all()
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    problem = diff(sdf.columns, srows, dcols, res.fetchall())
    assert problem is None, problem


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["domain", "keyword", "search_volume", "kw_rank"]


def test_d8_rows_for_every_client(spark, con):
    """D8 row by row for all clients (the registered check compares summaries)."""
    from searchlake.plans import q_logs
    from searchlake.plans.checks import scalar_output
    from searchlake.plans.oracle_views import with_views
    sdf = scalar_output(q_logs.d8_rows(spark, SF))
    res = con.execute(with_views(q_logs.D8_ROWS_SQL, "v_data", "v_client_domains", "v_domains"))
    drows = res.fetchall()
    assert len(drows) > 0
    problem = diff(sdf.columns, [tuple(r) for r in sdf.collect()],
                   [c[0] for c in res.description], drows)
    assert problem is None, problem


def test_f14_to_create_is_asked_for_all_rows(spark, con, monkeypatch):
    """Targets with an id that come back as to be created are seen."""
    from searchlake.operators import entities
    right = entities.resolve_domains

    def wrong(domains, targets):
        resolved, unknown, create = right(domains, targets)
        return resolved, unknown, create.unionByName(unknown.select("target"))
    monkeypatch.setattr(entities, "resolve_domains", wrong)
    sdf = QUERIES["f14_resolve_domains_to_create"](spark, SF)
    res = con.execute(ORACLES["f14_resolve_domains_to_create"])
    assert diff(sdf.columns, [tuple(r) for r in sdf.collect()], [c[0] for c in res.description], res.fetchall()) is not None


@pytest.mark.parametrize("name", ["k1_stream_events", "k2_stream_attempts"])
def test_landing_files_grow_with_the_input(spark, con, monkeypatch, name):
    from searchlake.plans import q_streaming
    from searchlake.streaming import jobs
    monkeypatch.setattr(q_streaming, "FILE_BYTES", 4_000, raising=False)
    files, run = [], "stream_ingest" if name.startswith("k1") else "stream_attempts"
    stream = getattr(jobs, run)

    def seen(spark, landing, *args, **options):
        files.append(len(spark.read.parquet(landing).inputFiles()))
        return stream(spark, landing, *args, **options)
    monkeypatch.setattr(jobs, run, seen)
    sdf = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    assert diff(sdf.columns, [tuple(r) for r in sdf.collect()], [c[0] for c in res.description], res.fetchall()) is None
    assert min(files) > 4
