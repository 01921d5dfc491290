"""Response flatteners on the reference's response shapes."""

import json

import pytest

from searchlake.operators import flatten as B
from searchlake.schemas import ENDPOINTS


def responses(spark, docs, target="seedword"):
    return spark.createDataFrame([(target, json.dumps(d) if not isinstance(d, str) else d) for d in docs],
                                 "target string, raw string")


SUGG = {"status_code": 20000, "tasks": [{"id": "t1", "status_code": 20000, "status_message": "Ok.",
        "cost": 0.0101, "result": [{"se_type": "google", "seed_keyword": "seedword", "location_code": 2840,
        "language_code": "en", "items": [{"keyword": "bus rental", "keyword_info": {"search_volume": 100}}]}]}]}


def test_suggestions_one_item(spark):
    rows = B.flatten_keyword_suggestions(responses(spark, [SUGG])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.keyword, r.search_volume, r.location_code, r.language_code, r.task_id) == \
        ("bus rental", 100, 2840, "en", "t1")


def test_suggestions_empty_result_and_garbage(spark):
    empty = json.loads(json.dumps(SUGG))
    empty["tasks"][0]["result"] = []
    df = B.flatten_keyword_suggestions(responses(spark, [empty, {"random": "garbage"}, "not json"]))
    assert df.count() == 0
    assert len(df.columns) == len(ENDPOINTS["keyword_suggestions"].columns) + 1


def test_suggestions_missing_key_vs_null(spark):
    doc = json.loads(json.dumps(SUGG))
    doc["tasks"][0]["result"] = [{"se_type": "google"}, {"location_code": 2840, "items": [
        {"keyword": "a"}, {"keyword": "b", "location_code": None}, {"keyword_data": {"keyword": "c"}},
        {"keyword": ""}]}]
    rows = {r.keyword: r for r in B.flatten_keyword_suggestions(responses(spark, [doc])).collect()}
    assert rows["a"].location_code == 2840          # missing key: block value
    assert rows["b"].location_code is None          # explicit null stays null
    assert rows["c"].seed_keyword == "seedword"      # missing in block: requested target
    assert "" not in rows and rows["a"].se_type == "google"


def test_related_one_item_keeps_null_keyword(spark):
    doc = {"tasks": [{"id": "t2", "result": [{"seed_keyword": "garden", "items": [
        {"keyword_data": {"keyword": "garden hose", "keyword_info": {"search_volume": 50}}, "depth": 1},
        {"keyword_data": {}, "depth": 2}]}]}]}
    rows = B.flatten_related_keywords(responses(spark, [doc])).orderBy("depth").collect()
    assert rows[0].related_keyword == "garden hose" and rows[0].search_volume == 50
    assert rows[1].related_keyword is None
    assert B.flatten_related_keywords(responses(spark, [doc])).columns[0] == "task_id"


def test_ranked_keywords_drops_and_int_rule(spark):
    def item(kw, rank, url, vol):
        return {"keyword_data": {"keyword": kw, "keyword_info": {"search_volume": vol}},
                "ranked_serp_element": {"serp_item": {"rank_group": rank, "url": url}}}
    doc = {"tasks": [{"id": "t", "data": {"location_code": 2840}, "result": [{"items": [
        item("a", 1, "u", 0), item("b", 1, "u", "2.0"), item("c", 1, "u", 1.5), item("", 1, "u", 3),
        item("d", None, "u", 3), item("e", 1, "", 3), item("f", 1, "u", None)]}]}]}
    rows = {r.keyword: r for r in B.flatten_ranked_keywords(responses(spark, [doc])).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].search_volume == 0 and rows["b"].search_volume == 2 and rows["c"].search_volume is None
    assert rows["a"].national_location_code == 2840


def test_bulk_pages_skips_null_items_and_counts_nofollow(spark):
    doc = {"tasks": [{"id": "t", "result": [{"items": [None, {}, {"url": "x", "backlinks": 10,
           "referring_links_attributes": {"nofollow": 3}}, {"url": "y"}]}]}]}
    rows = {r.url: r for r in B.flatten_bulk_pages(responses(spark, [doc])).collect()}
    assert set(rows) == {"x", "y"}
    assert (rows["x"].nofollow, rows["x"].dofollow) == (3, 7)
    assert (rows["y"].nofollow, rows["y"].dofollow) == (0, 0)
    assert json.loads(rows["x"].referring_links_attributes) == {"nofollow": 3}


def test_summary_target_fallback_and_type(spark):
    doc = {"tasks": [{"id": "t", "result": [{"target": "", "rank": 5, "info": {"target_spam_score": 7}}]}]}
    r = B.flatten_backlinks_summary(responses(spark, [doc], target="https://x.com/page")).first()
    assert (r.target, r.target_type, r.target_spam_score) == ("https://x.com/page", "url", 7)


def test_serp_data_without_items_and_paa(spark):
    doc = {"tasks": [{"id": "s1", "data": {"location_code": 2840, "device": "desktop"},
           "result": [{"se_domain": "google.com", "datetime": "2024-01-02 03:04:05 +00:00", "items": [
               {"type": "organic", "rank_group": 1, "url": "u"},
               {"type": "people_also_ask", "items": [
                   {"title": "q1", "expanded_element": [{"description": "a1"}], "url": "w"},
                   {"title": "q2"}]}]}]}]}
    serp = B.flatten_serp(responses(spark, [doc], target="kw"))
    rows = serp.orderBy("rank_group").collect()
    assert len(rows) == 2 and rows[0].keyword == "kw" and rows[0].device == "desktop"
    assert json.loads(rows[0].data) == {"se_domain": "google.com", "datetime": "2024-01-02 03:04:05 +00:00"}
    paa = {r.question: r for r in B.extract_paa(serp).collect()}
    assert paa["q1"].answer == "a1" and paa["q2"].answer == "" and paa["q2"].url == ""


def test_search_volume_location_fallback(spark):
    doc = {"tasks": [{"id": "v", "data": {"location_code": 2840}, "result": [
        {"keyword": "a", "location_code": None, "monthly_searches": []},
        {"keyword": "b", "location_code": 2036, "monthly_searches": [{"year": 2024}]}, {"keyword": ""}]}]}
    rows = {r.keyword: r for r in B.flatten_search_volume(responses(spark, [doc])).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].location_code == 2840 and rows["a"].monthly_searches is None
    assert rows["b"].location_code == 2036


def test_keyword_count(spark):
    doc = {"tasks": [{"id": "d", "result": [{"items": [
        {"location_code": 2840, "metrics": {"organic": {"count": 12}}},
        {"location_code": 2036, "metrics": {"organic": {"count": 3}}}]}]}]}
    dr = B.flatten_domain_rank(responses(spark, [doc], target="x.com"), with_position=True)
    targets = spark.createDataFrame([("x.com",), ("y.com",)], "target string")
    got = {r.target: r.keyword_count for r in B.keyword_count(dr, targets).collect()}
    assert got == {"x.com": 12, "y.com": -1}


def test_column_pruned_flatten_keeps_rules(spark):
    doc = {"tasks": [{"id": "t", "result": [{"items": [None, {"url": "x", "backlinks": 10,
           "referring_links_attributes": {"nofollow": 3}}]}]}]}
    df = B.flatten(responses(spark, [doc]), "bulk_pages_summary", columns=["url", "dofollow"])
    r = df.first()
    assert df.count() == 1 and (r.url, r.dofollow) == ("x", 7)
    assert set(df.columns) >= {"url", "dofollow", "task_id"}


def test_read_responses_json_files(spark):
    import os
    import tempfile
    from searchlake.sources.responses import read_responses
    base = tempfile.mkdtemp(prefix="sl-land-")
    for target, doc in (("x.com", SUGG), ("y.com", {"random": "garbage"})):
        d = os.path.join(base, "keyword_suggestions", target)
        os.makedirs(d)
        with open(os.path.join(d, "0.json"), "w") as f:
            json.dump(doc, f, indent=2)
    landed = read_responses(spark, os.path.join(base, "*", "*", "*.json"), fmt="json")
    got = {r.target: r for r in landed.collect()}
    assert set(got) == {"x.com", "y.com"} and got["x.com"].endpoint == "keyword_suggestions"
    rows = B.flatten_keyword_suggestions(landed, keep=("target",)).collect()
    assert [(r.target, r.keyword) for r in rows] == [("x.com", "bus rental")]


def test_items_are_parsed_once(spark):
    """B2: no test of the items' size, with the whole parsing in it, is pushed below the explode."""
    raw = '{"tasks":[{"id":"t","result":[{"items":[{"type":"people_also_ask","items":[{"title":"q"}]}]}]}]}'
    empty = '{"tasks":[{"id":"t","result":[{"items":[]}]}]}'
    rows = spark.createDataFrame([(1, "kw", raw), (2, "none", empty), (3, "bad", "{")], ["id", "target", "raw"])
    # made from a join, as pushed filters would become its condition
    responses = rows.select("id", "target").join(rows.select("id", "raw"), "id")
    got = B.extract_paa(B.flatten_serp(responses))
    assert "size(from_json" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in got.collect()] == [("kw", "q", "", "", "q")]


def test_serp_without_its_texts_keeps_every_row(spark):
    """Results and items that are no objects, and broken documents, give the rows that the texts give."""
    def doc(result):
        return '{"tasks":[{"id":"t","status_code":20000,"data":{"device":"mobile","location_code":2840},"result":%s}]}' % result
    item = '{"type":"organic","rank_group":1,"rank_absolute":2.0,"title":"T","items":[{"a":1}]}'
    block = '{"keyword":"k","datetime":"2024-01-02 03:04:05 +00:00","se_results_count":%s,"item_types":["organic"],"items":%s}'
    arrays = [f"[{item}]", f'[{item},5,null,"x","",[{item}],{{}},true]', "[]", "null", item, '"x"',
              '[{"type":{"a":1},"rank_group":"7","title":[1,{"b":2}]}]', '[{"type":"a","type":"b","rank_group":1.5}]',
              "[1.0]", f"[[],{item}]"]
    raws = [doc("[" + block % (n, a) + "]") for a in arrays for n in ("5", '"6.0"', "[1]")]
    good = block % (5, f"[{item}]")
    raws += [doc(r) for r in (f"[{good},5]", f"[5,{good}]", f"[null,{good}]", good, "null", "[]", "7", f'["x",{good}]',
                              '[{"items":{"a":1}}]', f'[{{"datetime":{{}},"items":[{item}]}}]', f"[{good},{{]")]
    whole = doc(f"[{good}]")
    raws += ["", "null", "[]", "5", "{}", '{"tasks":null}', '{"tasks":[]}', '{"tasks":{}}', '{"tasks":[5]}',
             whole[:-3], whole[:-60], whole + "x", "[" + whole + "]", whole.replace('{"device"', '[{"device"'),
             whole.replace('"id":"t"', '"id":["t"]'), whole.replace('"data":{"device":"mobile","location_code":2840}', '"data":5')]
    responses = spark.createDataFrame([(f"kw{i}", r) for i, r in enumerate(raws + [None])], "target string, raw string")
    want = B.flatten_serp(responses).drop("data", "item")
    got = B.flatten_serp(responses, columns=[c for c in want.columns if c != "task_id"])
    assert got.columns == want.columns and got.schema == want.schema
    key = lambda r: tuple(map(str, r))
    want, got = sorted(want.collect(), key=key), sorted(got.collect(), key=key)
    assert len(want) > 40 and got == want


def test_serp_query_gives_all_columns(spark):
    """B1 as a query: the two texts of a row are made as well, the result's once a response."""
    from searchlake.plans import registry
    from searchlake.schemas import ENDPOINTS
    registry.load_all()
    got = registry.QUERIES["b1_flatten_serp"](spark, "/root/testdata/sf0.001")
    assert got.columns == [name for name, _, _ in ENDPOINTS["serp_organic"].columns] + ["task_id"]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [i for i, line in enumerate(plan) if "map_filter" in line]
    assert len(made) == 1 and made[0] > next(i for i, line in enumerate(plan) if "posexplode" in line)
    rows = [(json.loads(r["data"]), json.loads(r["item"]), r) for r in got.collect()]
    assert rows and all("items" not in data and data["keyword"] == r["keyword"] and data["se_domain"] == r["se_domain"]
                        and item["type"] == r["item_type"] and item["rank_absolute"] == r["rank_absolute"]
                        and ("items" in item) == (r["item_type"] == "people_also_ask") for data, item, r in rows)


ODD = ["5", "5.0", "5.5", "-0", "1e3", "1e400", "-1e400", "123456789012345678901234567890", "9223372036854775808", "NaN", "-Infinity",
       '"NaN"', '"Infinity"', '""', '" 7 "', '"12.0"', '"x"', "true", '"true"', "null", "[]", '["a",null,{"b":1}]', '{"a":1}', '"[x"',
       "1e-20", "01"]


@pytest.mark.parametrize("name", ["ranked_keywords", "backlinks", "domain_rank_overview"])
def test_leaves_read_in_their_type_give_the_rows_of_texts(spark, monkeypatch, name):
    """Values of any other kind, and broken documents, give the rows that reading all leaves as text gives."""
    ep = ENDPOINTS[name]
    good = {"bigint": "5", "double": "2.5", "boolean": "true", "csv": '["a",null,"b"]', "json": "[1]"}

    def text(node):
        return node if isinstance(node, str) else "{" + ",".join(f'"{k}":{text(v)}' for k, v in node.items()) + "}"

    def doc(over, result='[{"items":[%s,%s]}]'):
        blocks = {"item": {}, "task": {}}
        for column, path, kind in ep.columns:
            if not path.startswith("$") and over.get(column, "") is not None:
                block, *path = path.split(".") if path.startswith("task.") else ("item", *path.split("."))
                node = blocks[block]
                for part in path[:-1]:
                    node = node.setdefault(part, {})
                node[path[-1]] = over.get(column, good.get(kind, '"s"'))
        task = {"id": '"t"'} | blocks["task"]
        task["result"] = result % ((text(blocks["item"]),) * result.count("%s"))
        return '{"tasks":[%s]}' % text(task)
    raws = [doc({column: v}) for column, _, kind in ep.columns if kind in B.NATIVE for v in ODD] + [doc({c: None}) for c, _, _ in ep.columns]
    whole = doc({})
    raws += [whole, whole + "x", whole[:-3], whole[:-60], "[" + whole + "]", "", "null", "[]", "{}", '{"tasks":[5]}', None]
    raws += [doc({}, r) for r in ('[{"items":[%s,5,null,"x",{},[%s]]}]', '[{"items":%s}]', '[5,{"items":[%s]}]', '{"items":[%s]}', "null")]
    got = [[], []]
    given = spark.createDataFrame([(f"k{i}", r) for i, r in enumerate(raws)], "target string, raw string")
    native = B._native(ep)
    assert len(native) > 10
    for rows in got:
        out = B.flatten(given, ep, keep=("target",), with_position=True)
        rows += [out.dtypes, sorted(out.collect(), key=lambda r: (r["target"], r["item_pos"]))]
        monkeypatch.setattr(B, "_native", lambda ep: {})
    assert got[0][0] == got[1][0] and len(got[0][1]) > len(raws)
    assert [repr(r) for r in got[0][1]] == [repr(r) for r in got[1][1]]


def test_a_wide_endpoint_is_compiled(spark):
    """No generated method of the flattener exceeds the 8000 bytes up to which the JVM compiles one, and numbers are read as such."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for name in ("ranked_keywords", "backlinks"):
        out = B.flatten(spark.createDataFrame([("k", "{}")], "target string, raw string"), name)
        plan = out._jdf.queryExecution().executedPlan()
        stages = debug.codegenStringSeq(plan)
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
        assert "rank,LongType" in plan.toString() or "rank_absolute,LongType" in plan.toString()
