"""Entity, catalog and reconciliation operators on the reference's cases."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.functions.domains import suffix_rules
from searchlake.operators import catalog as E
from searchlake.operators import entities as Fx
from searchlake.operators import reconcile as H
from searchlake.schemas import SENTINEL

DOM_SCHEMA = "domain_id bigint, domain string, domain_name string, is_active boolean, notes string"
LINK_SCHEMA = "client_id bigint, domain_id bigint, is_competitor boolean, priority string, notes string"


def test_add_domains_twice_gives_one_id(spark):
    domains = spark.createDataFrame([], DOM_SCHEMA)
    links = spark.createDataFrame([], LINK_SCHEMA)
    batch = spark.createDataFrame([("https://www.acme.com/", 0), ("acme.com", 1)], "raw string, pos bigint")
    rules = suffix_rules(spark)
    res, new_domains, new_links = Fx.add_domains(domains, links, batch, rules, client_id=1)
    r = res.collect()
    assert len(r) == 1 and r[0].domain == "acme.com" and r[0].domain_name == "Acme" and not r[0].skipped
    assert new_domains.count() == 1 and new_links.count() == 1
    res2, nd2, nl2 = Fx.add_domains(new_domains, new_links, batch, rules, client_id=1)
    r2 = res2.collect()
    assert r2[0].domain_id == r[0].domain_id and r2[0].skipped
    assert nd2.count() == 0 and nl2.count() == 0
    with pytest.raises(ValueError):
        Fx.add_domains(domains, links, batch, rules, client_id=1, priority="URGENT")
    clients = spark.createDataFrame([(2,)], "client_id bigint")
    with pytest.raises(ValueError):
        Fx.add_domains(domains, links, batch, rules, clients, client_id=1)


def test_patch_priority_and_fields(spark):
    links = spark.createDataFrame([(1, 10, False, "LOW", None)], LINK_SCHEMA)
    ch = spark.createDataFrame([(1, 10, "high")], "client_id bigint, domain_id bigint, priority string")
    ch = ch.withColumn("priority", Fx.normalize_priority(F.col("priority")))
    assert Fx.patch(links, ch, ["client_id", "domain_id"]).first().priority == "HIGH"
    bad = ch.withColumn("priority", Fx.normalize_priority(F.lit("urgent")))
    assert Fx.patch(links, bad, ["client_id", "domain_id"]).first().priority == "NORMAL"


def test_orphans(spark):
    clients = spark.createDataFrame([(1,), (2,)], "client_id bigint")
    domains = spark.createDataFrame([(10,), (11,)], "domain_id bigint")
    cd = spark.createDataFrame([(1, 10), (3, 10), (1, 99)], "client_id bigint, domain_id bigint")
    cds = spark.createDataFrame([(1, None, "ds")], "client_id bigint, domain_id bigint, dataset_id string")
    out = H.orphans([("bad_client", cd, ["client_id"], clients, ["client_id"]),
                     ("bad_domain", cd, ["domain_id"], domains, ["domain_id"]),
                     ("ds_bad_domain", cds.select("domain_id"), ["domain_id"], domains, ["domain_id"])])
    got = sorted((r.check, r.child_key) for r in out.collect())
    assert got == [("bad_client", "3,10"), ("bad_domain", "1,99")]


def test_align_schema(spark):
    old = spark.createDataFrame([(1, [1, 2], 5)], "a bigint, arr array<bigint>, i bigint")
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("arr", T.StringType()),
                           T.StructField("i", T.DoubleType()), T.StructField("b", T.BooleanType()),
                           T.StructField("ts", T.TimestampType())])
    r = H.align_schema(old, target).first()
    assert (r.a, r.arr, r.i, r.b, r.ts) == (1, "[1,2]", 5.0, None, None)


def test_fill_metadata(spark):
    df = spark.createDataFrame([(None, "u", None, "x.com")],
                               "job_id string, upload_id string, ingest_timestamp timestamp, domain string")
    keep = H.fill_metadata(df, keep_domain=True, now="2025-01-01 00:00:00").first()
    assert keep.job_id == SENTINEL and keep.upload_id == "u" and keep.domain == "x.com"
    assert str(keep.ingest_timestamp).startswith("2025-01-01") and keep.endpoint_mode == "live"
    assert H.fill_metadata(df, keep_domain=False).first().domain is None


def test_backfill_keeps_real_values(spark):
    df = spark.createDataFrame([(SENTINEL, "real-up", "2024-01-01 10:15:00"),
                                ("real-job", SENTINEL, "2024-01-01 10:45:00")],
                               "job_id string, upload_id string, ingest_timestamp string") \
        .withColumn("ingest_timestamp", F.col("ingest_timestamp").cast("timestamp"))
    rows = H.backfill_ids_by_hour(df, "t").collect()
    assert rows[0].upload_id == "real-up" and rows[0].job_id != SENTINEL
    assert rows[1].job_id == "real-job" and rows[1].upload_id != SENTINEL
    r2 = H.backfill_upload_by_job_hour(df, "t").collect()
    assert r2[1].job_id == "real-job" and len(r2[1].upload_id) == 36
    assert r2[0].job_id == SENTINEL   # job ids never change


def test_intents_to_json(spark):
    df = spark.createDataFrame([("commercial,navigational",), ("  ",), (",",)], "s string")
    out = [r.j for r in df.select(H.intents_to_json(F.col("s")).alias("j")).collect()]
    assert out == ['[{"label":"commercial"},{"label":"navigational"}]', None, "[]"]


def test_catalog_diff_new_table(spark):
    cat = spark.createDataFrame([], "dataset string, table_name string, row_count bigint, size_bytes bigint, "
                                    "is_active boolean, status_changed_at timestamp, notes string, "
                                    "last_indexed_at timestamp")
    scan = spark.createDataFrame([("d", "t1", 10, 100)], "dataset string, table_name string, row_count bigint, "
                                                         "size_bytes bigint")
    assert [r.change for r in E.catalog_diff(cat, scan).collect()] == ["new"]
    r = E.apply_catalog_diff(cat, scan, "2025-01-01 00:00:00").first()
    assert (r.row_count, r.size_bytes, r.is_active) == (10, 100, True)


def test_drift_counts_duplicates_and_normalizes(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id bigint, v double")
    b = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 2.0)], "id bigint, v double")
    b = b.withColumn("id", F.col("id").cast("double"))
    d = H.drift(a, b, ["id", "v"]).collect()
    assert len(d) == 1 and d[0].side == "only_b" and d[0].n == 1


def test_parse_decisions(spark):
    df = spark.createDataFrame([("a.com", "MATCH 5", "a.com"), ("b.com", "CREATE", None),
                                ("c.com", "CREATE c2.com", None), ("d.com", "SKIP", None),
                                ("e.com", "", None), ("f.com", "maybe", None)],
                               "raw_domain string, decision string, meta_match_domain string")
    got = {r.raw_domain: r for r in H.parse_decisions(df).collect()}
    assert got["a.com"].domain_id == 5 and got["b.com"].provision_target == "b.com"
    assert got["c.com"].provision_target == "c2.com" and got["d.com"].action == "SKIP"
    assert got["e.com"].error == "no decision for e.com" and got["f.com"].error == "cannot read the decision for f.com: maybe"


def test_match_datasets_rules(spark):
    domains = spark.createDataFrame(
        [(1, "acme.com", None, True, None), (2, "acme.com.au", None, True, None),
         (3, "www.bolt.co.nz", None, True, None), (4, "minibolt.co.nz", None, True, None),
         (5, "rival.com", None, True, None), (6, "gone.com", None, False, None)], DOM_SCHEMA)
    cd = spark.createDataFrame([(10, 1, False, "LOW", None), (10, 2, False, "LOW", None),
                                (11, 3, False, "LOW", None), (12, 4, False, "LOW", None),
                                (10, 5, True, "LOW", None), (13, 6, False, "LOW", None)], LINK_SCHEMA)
    catalog = spark.createDataFrame([
        ("analytics_1", "ga4", "www.acme.com"),            # exact host
        ("jepto_gsc_acme", "gsc", None),                   # fuzzy: shortest of acme.com / acme.com.au
        ("sc_x_sc_domain_www_bolt_co_nz", "gsc", None),    # name after _sc_domain_, www. removed
        ("misc_minibolt_co_nz_data", "other", None),       # substring: longest contained domain
        ("analytics_2", "ga4", "rival.com"),               # competitor domains are not candidates
        ("jepto_gsc_gone_com", "gsc", None),               # inactive domains are not candidates
        ("linked_ds", "other", None)], "dataset string, dataset_type string, hostname string")
    links = spark.createDataFrame([(13, None, "linked_ds", True, None, None)],
                                  "client_id bigint, domain_id bigint, dataset_id string, is_active boolean, "
                                  "notes string, created_at timestamp")
    got = {r.dataset: (r.match_rule, r.domain, r.client_id)
           for r in E.match_datasets(catalog, links, cd, domains).collect()}
    assert got["analytics_1"] == ("host", "acme.com", 10)
    assert got["jepto_gsc_acme"] == ("jepto_gsc", "acme.com", 10)
    assert got["sc_x_sc_domain_www_bolt_co_nz"] == ("sc_domain", "www.bolt.co.nz", 11)
    assert got["misc_minibolt_co_nz_data"] == ("substring", "minibolt.co.nz", 12)
    assert got["analytics_2"][0] is None and got["jepto_gsc_gone_com"][0] is None
    assert got["linked_ds"][0] == "known"


def test_dense_index_is_dense(spark):
    from searchlake.operators.ids import dense_index
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("k")).repartition(7)
    got = sorted((r.k, r.i) for r in dense_index(df, ["k"], start=5, name="i").collect())
    assert [i for _, i in got] == list(range(5, 1005))
    assert dense_index(df.limit(0), ["k"], name="i").collect() == []


def test_match_long_domains(spark):
    """The substring rule takes domains of any length, with paths."""
    long = "a" * 300 + ".com/" + "p" * 40
    doms = spark.createDataFrame([(1, long, True), (2, "x.io", True), (3, "b", True)], "domain_id bigint, domain string, is_active boolean")
    links = spark.createDataFrame([(7, 1, False), (8, 2, False), (9, 3, False)], "client_id bigint, domain_id bigint, is_competitor boolean")
    cat = spark.createDataFrame([("zz_" + long, "other", None), ("qx_io_q", None, None), ("ccc", None, "host.net"), ("g", "ga4", "Www.X.io")],
                                "dataset string, dataset_type string, hostname string")
    none = spark.createDataFrame([], "dataset_id string, client_id bigint, domain_id bigint")
    got = {r.dataset: (r.domain_id, r.status, r.hostname) for r in E.match_datasets(cat, none, links, doms).collect()}
    assert got["zz_" + long] == (1, "proposed", long) and got["qx_io_q"] == (2, "proposed", "x.io")
    assert got["ccc"] == (None, "unmatched", None) and got["g"] == (2, "proposed", "x.io")


def test_rarest_grams_match_brute_force(spark):
    """Each domain lies under the gram that fewest others hold; names make one gram row a
    character and size in use; the longest contained domain is that of all pairs."""
    stems = ["shop", "the.shop", "big-data", "a", "xy", "abc", "aaaaaaaaaaaa", "日本語.jp"]
    keys = sorted({f"{s}{n}.{t}" for s in stems for n in ("", "1", "22") for t in ("com", "com.au")} | {"a", "xy", "t.co", ""})
    names = [f"{p}.{k}.{q}" for i, k in enumerate(keys) for p, q in [("", ""), ("zz", "www"), (keys[-1 - i], "9")]] + ["", "none", "aa"]
    kd = spark.createDataFrame([(k,) for k in keys + keys[:3]], "key string")
    nd = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "dataset string, nm string")
    grams = lambda k, n: {k[i:i + n] for i in range(len(k) - n + 1)}
    size = {k: max(g for g in E.GRAMS if g <= len(k)) for k in keys if k}
    held = Counter((n, g) for k, n in size.items() for g in grams(k, n))
    want = {k: (n, min((held[n, g], g) for g in grams(k, n))[1]) for k, n in size.items()}
    index = E.rarest_grams(kd)
    assert {r.key: (r.size, r.gram) for r in index.collect()} == want and index.count() == len(want)
    rows = Counter(r.dataset for r in E.name_grams(nd, index).collect())
    assert all(rows[str(i)] == sum(max(0, len(n) - s + 1) for s in set(size.values())) for i, n in enumerate(names))
    got = {r.dataset: r.key for r in E._longest_contained(nd, kd).collect()}
    assert got == {str(i): min((-len(k), k) for k in size if k in n)[1]
                   for i, n in enumerate(names) if any(k in n for k in size)}


def test_split_reports_equal_domains(spark):
    p = spark.createDataFrame([(1, "a.com_001"), (1, "a.com_002"), (1, "b.com_001"), (2, "c.com_001")], "project_id bigint, project_name string")
    links = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "project_id bigint, domain_id bigint")
    doms = spark.createDataFrame([(10, "a.com"), (11, "b.com"), (12, "c.com")], "domain_id bigint, domain string")
    projects, new_links, remap, duplicates = H.split_collided(p, links, doms)
    assert sorted((r.project_id, r.project_name) for r in projects.collect()) == [
        (1, "a.com_001"), (2, "c.com_001"), (3, "a.com_002"), (4, "b.com_001")]
    assert sorted(tuple(r) for r in new_links.collect()) == [(1, 10), (2, 12), (4, 11)]
    assert sorted(tuple(r) for r in remap.collect()) == [(3, 1), (4, 1)]
    assert [tuple(r) for r in duplicates.collect()] == [(1, "a.com", 2)]


def test_drift_of_text_and_number_keys_in_one_column(spark):
    a = spark.createDataFrame([(i,) for i in range(9)], "k bigint")
    mixed = a.select(F.when(F.col("k") % 3 == 0, F.col("k").cast("string").cast("variant"))
                     .when(F.col("k") == 4, F.lit(4.0).cast("variant")).otherwise(F.col("k").cast("variant")).alias("k"))
    got = sorted((r.k, r.side, r.n) for r in H.drift(a, mixed, ["k"]).collect())
    assert got == [(k, side, 1) for k in "036" for side in ("only_a", "only_b")]
