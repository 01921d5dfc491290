"""Response flatteners (B1-B12): JSON text -> typed rows.

One generic job per endpoint: ``from_json`` with every leaf read as STRING, or
in its column's type where that gives the same rows (schema built from the
registry in :mod:`searchlake.schemas`, see :func:`_read_native`), take the first
task, explode the items (or the results), keep rows that carry the required
values, then apply the single typing rule of :mod:`searchlake.functions.typing`.
All of it is one narrow stage: no shuffle, no Python in the row path.

Where the reference tells a missing key from an explicit null (``dict.get(k,
default)``), the element is kept as JSON text too and its key list
(``json_object_keys``) decides; otherwise only the typed struct is parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.functions.typing import cast_leaf, label_list
from searchlake.schemas import ENDPOINTS, Endpoint


def _tree(paths: list[str]) -> dict:
    root: dict = {}
    for p in paths:
        node = root
        parts = p.split(".")
        for part in parts[:-1]:
            nxt = node.get(part)
            if nxt is None:
                nxt = node[part] = {}
            node = nxt
        node.setdefault(parts[-1], None)
    return root


def _struct(tree: dict, native: dict | None = None, at: str = "") -> T.StructType:
    return T.StructType([
        T.StructField(k, (native or {}).get(at + k, T.StringType()) if v is None else _struct(v, native, f"{at}{k}."), True)
        for k, v in tree.items()
    ])


def _paths(ep: Endpoint) -> list[str]:
    out = [p for _, p, _ in ep.columns]
    out += [p for p, _ in ep.fallbacks.values()]
    return [p for p in out if not p.startswith("$")]


def _split_paths(ep: Endpoint):
    item, task, result = [], [], []
    for p in _paths(ep):
        if p.startswith("task."):
            task.append(p[5:])
        elif p.startswith("result."):
            result.append(p[7:])
        else:
            item.append(p)
    return item, task, result


def _modes(ep: Endpoint) -> set[str]:
    return {mode for _, mode in ep.fallbacks.values()}


def _needs_item_text(ep: Endpoint) -> bool:
    return ("missing" in _modes(ep) or ep.skip_empty_items
            or any(p == "$item_json" for _, p, _ in ep.columns))


def _needs_result_text(ep: Endpoint) -> bool:
    return (ep.explode == "first_items" or "missing_res" in _modes(ep)
            or any(p == "$result_data" for _, p, _ in ep.columns))


def item_schema(ep: Endpoint, native: dict | None = None) -> T.StructType:
    item_p, _, _ = _split_paths(ep)
    return _struct(_tree(item_p), native)


def result_schema(ep: Endpoint, item_t: T.DataType, native: dict | None = None) -> T.StructType:
    _, _, result_p = _split_paths(ep)
    fields = [f for f in _struct(_tree(result_p), native, "result.").fields if f.name != "items"]
    return T.StructType(fields + [T.StructField("items", T.ArrayType(item_t))])


def response_schema(ep: Endpoint, by_text: bool = False, native: dict | None = None) -> T.StructType:
    """Read schema of one raw response for ``ep`` (leaves as STRING, but for those of ``native``);
    ``by_text``: results as texts in any case."""
    item_t = T.StringType() if _needs_item_text(ep) else item_schema(ep, native)
    _, task_p, _ = _split_paths(ep)
    # only what the rows need: a number read as text costs more than all else of a task block
    task_fields = [T.StructField("id", T.StringType())]
    task_fields += [f for f in _struct(_tree(task_p), native, "task.").fields if f.name != "id"]
    if ep.explode == "results":
        result_t = T.ArrayType(item_t)
    elif by_text or _needs_result_text(ep):
        result_t = T.ArrayType(T.StringType())
    else:
        result_t = T.ArrayType(result_schema(ep, item_t, native))
    task_fields.append(T.StructField("result", result_t))
    return T.StructType([T.StructField("tasks", T.ArrayType(T.StructType(task_fields)))])


def _explode(c: Column):
    # the outer form: for the inner one Spark infers size(c) > 0 and pushes it below the
    # parsing, which then builds and parses each response again for the test alone
    return F.posexplode_outer(c).alias("_pos", "_it")


def _read_at_once(responses: DataFrame, ep: Endpoint, keep: list[str]) -> DataFrame:
    """(keep..., _task, _res, _items) of ``ep`` read in one parse where its results and items are
    otherwise parsed from texts of their own, so that one that is no object costs itself only.
    The few responses with such a one, or malformed, are read by those texts."""
    once = T.StructType(response_schema(ep).fields + [T.StructField("_bad", T.StringType())])
    parsed = responses.select(*keep, "raw", F.from_json("raw", once, {"columnNameOfCorruptRecord": "_bad"}).alias("_r"))
    task = F.get(F.col("_r.tasks"), 0)
    res = F.get(task["result"], 0)
    text_task = F.get(F.from_json("raw", response_schema(ep, by_text=True))["tasks"], 0)
    text_res = F.from_json(F.get(text_task["result"], 0), result_schema(ep, T.StringType()))
    items = F.transform(text_res["items"], lambda it: F.from_json(it, item_schema(ep)))
    task_names = [f.name for f in response_schema(ep)["tasks"].dataType.elementType if f.name != "result"]
    res_names = [f.name for f in result_schema(ep, item_schema(ep)) if f.name != "items"]

    def block(t: Column, r: Column, its: Column) -> Column:
        return F.struct(F.struct(*[t[n].alias(n) for n in task_names]).alias("_task"),
                        F.struct(*[r[n].alias(n) for n in res_names]).alias("_res"), its.alias("_items"))
    read = F.when(F.col("_r._bad").isNotNull(), block(text_task, text_res, items)).otherwise(
        block(task, res, res["items"]))
    return parsed.select(*keep, read.alias("_b")).select(*keep, "_b._task", "_b._res", "_b._items")


#: The JSON parser makes these from a JSON value of that kind at a fraction of the cost of its text, for
#: which it sets up a JSON writer a value. Any other value there (a number as text, 5.0 for 5, NaN) is an error.
NATIVE = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "csv": T.ArrayType(T.StringType())}


def _native(ep: Endpoint) -> dict[str, T.DataType]:
    """Leaves of ``ep`` by path that may be read in the type of their column: those that only this column reads."""
    if ep.explode != "items" or _needs_item_text(ep) or _needs_result_text(ep) or ep.fallbacks:
        return {}
    paths = [p for _, p, _ in ep.columns]
    return {p: NATIVE[kind] for name, p, kind in ep.columns
            if kind in NATIVE and not p.startswith("$") and paths.count(p) == 1
            and name not in ep.as_text + ep.nonempty and not (name in ep.required and p.startswith(("task.", "result.")))}


def _cast_block(block: Column, t: T.StructType, kinds: dict[str, str], at: str = "") -> Column:
    """A block of text leaves with those of a native type cast by the typing rule."""
    out = []
    for f in t.fields:
        c = block[f.name]
        if isinstance(f.dataType, T.StructType):
            c = _cast_block(c, f.dataType, kinds, f"{at}{f.name}.")
        elif isinstance(f.dataType, T.ArrayType):
            c = label_list(c)
        elif not isinstance(f.dataType, T.StringType):
            c = cast_leaf(c, kinds[at + f.name])
        out.append(c.alias(f.name))
    return F.struct(*out)


def _read_native(responses: DataFrame, ep: Endpoint, keep: list[str], native: dict) -> DataFrame:
    """(keep..., _task, _res, _items, _odd) of ``ep`` read with the leaves of ``native`` in their types.
    A response in which one of them is of another kind, or which is malformed, is ``_odd``: it is read
    with all leaves as text, as ever, and these are cast. An item of it that lacks a required native value is null."""
    item_t, text_t = item_schema(ep, native), item_schema(ep)
    once = T.StructType(response_schema(ep, native=native).fields + [T.StructField("_bad", T.StringType())])
    strict = {"columnNameOfCorruptRecord": "_bad", "allowNonNumericNumbers": "false"}
    parsed = responses.select(*keep, "raw", F.from_json("raw", once, strict).alias("_r"))
    task = F.get(F.col("_r.tasks"), 0)
    res = F.get(task["result"], 0)
    text_task = F.get(F.from_json("raw", response_schema(ep))["tasks"], 0)
    text_res = F.get(text_task["result"], 0)
    kinds = {p: kind for _, p, kind in ep.columns}
    need = [p for name, p, _ in ep.columns if name in ep.required and p in native]

    def cast_item(it: Column) -> Column:
        out = _cast_block(it, item_t, kinds)
        for p in need:
            leaf = it
            for part in p.split("."):
                leaf = leaf[part]
            out = F.when(leaf.isNotNull(), out)
        return out
    task_t = T.StructType([f for f in once["tasks"].dataType.elementType if f.name != "result"])
    res_t = T.StructType([f for f in result_schema(ep, item_t, native) if f.name != "items"])

    def block(t: Column, r: Column, its: Column) -> Column:
        return F.struct(t.alias("_task"), r.alias("_res"), its.alias("_items"))

    def whole(c: Column, t: T.StructType) -> Column:
        return F.struct(*[c[f.name].alias(f.name) for f in t]) if t.fields else F.lit(None)
    read = F.when(F.col("_r._bad").isNotNull(), block(
        _cast_block(text_task, task_t, kinds, "task."),
        _cast_block(text_res, res_t, kinds, "result.") if res_t.fields else F.lit(None),
        F.transform(text_res["items"], cast_item))).otherwise(block(whole(task, task_t), whole(res, res_t), res["items"]))
    return parsed.select(*keep, read.alias("_b"), F.col("_r._bad").isNotNull().alias("_odd")).select(
        *keep, "_b._task", "_b._res", "_b._items", "_odd")


def _result_data(text: Column) -> Column:
    """The result object without its items, as JSON text."""
    m = F.from_json(text, "map<string,variant>")
    return F.to_json(F.map_filter(m, lambda k, v: k != "items"))


def explode_items(responses: DataFrame, ep: Endpoint, keep: list[str], at_once: bool = False) -> DataFrame:
    """Rows of (keep..., _task, _res, _res_text, _data, _pos, _it, _it_text); ``_pos`` is the
    element's position in its array, ``_data`` the result without its items, if a column asks for it. ``at_once``: see :func:`_read_at_once`."""
    it_text = _needs_item_text(ep)
    res_text = _needs_result_text(ep)
    if at_once:
        none = F.lit(None).cast("string")
        rows = _read_at_once(responses, ep, keep).select(*keep, "_task", "_res", none.alias("_res_text"),
                                                         none.alias("_data"), _explode(F.col("_items")))
        return rows.where(F.col("_pos").isNotNull()).withColumn("_it_text", none)
    native = _native(ep)
    if native:
        none = F.lit(None).cast("string")
        rows = _read_native(responses, ep, keep, native).select(
            *keep, "_task", "_res", none.alias("_res_text"), none.alias("_data"), "_odd", _explode(F.col("_items")))
        return rows.where(F.col("_pos").isNotNull()).withColumn("_it_text", none)
    parsed = responses.select(*keep, F.from_json("raw", response_schema(ep)).alias("_r"))
    task = parsed.select(*keep, F.get(F.col("_r.tasks"), 0).alias("_task"))
    none = F.lit(None).cast("string")
    if ep.explode == "results":
        rows = task.select(*keep, "_task", F.lit(None).alias("_res"), none.alias("_res_text"), none.alias("_data"),
                           _explode(F.col("_task.result")))
    else:
        if res_text:
            if ep.explode == "first_items":
                block = F.get(F.filter(F.col("_task.result"), lambda r: F.array_contains(
                    F.json_object_keys(r), F.lit("items"))), 0)
            else:
                block = F.get(F.col("_task.result"), 0)
            item_t = T.StringType() if it_text else item_schema(ep)
            first = task.select(*keep, "_task", block.alias("_res_text"))
            first = first.select(*keep, "_task", "_res_text",
                                 F.from_json("_res_text", result_schema(ep, item_t)).alias("_res"))
        else:
            first = task.select(*keep, "_task", none.alias("_res_text"),
                                F.get(F.col("_task.result"), 0).alias("_res"))
        if any(p == "$result_data" for _, p, _ in ep.columns):
            # a step of its own, see testviews.made: Spark moves it behind the explode of items
            # otherwise, where the whole result is parsed again for each item
            first = first.select(*keep, "_task", "_res", "_res_text",
                                 F.explode(F.array(_result_data(F.col("_res_text")))).alias("_data"))
        else:
            first = first.withColumn("_data", none)
        rows = first.select(*keep, "_task", "_res", "_res_text", "_data", _explode(F.col("_res.items")))
    rows = rows.where(F.col("_pos").isNotNull())
    if it_text:
        rows = rows.select(*keep, "_task", "_res", "_res_text", "_data", "_pos", F.col("_it").alias("_it_text"),
                           F.from_json(F.col("_it"), item_schema(ep)).alias("_it"))
        if ep.skip_empty_items:
            rows = rows.where(F.col("_it_text").isNotNull()
                              & (F.regexp_replace("_it_text", r"\s", "") != "{}")
                              & (F.col("_it_text") != "null"))
    else:
        rows = rows.withColumn("_it_text", none)
    return rows


def _leaf(path: str, target: Column | None = None) -> Column:
    if path == "$target":
        return target
    if path.startswith("$lit:"):
        return F.lit(path[5:])
    if path.startswith("task."):
        return F.col("_task." + path[5:])
    if path.startswith("result."):
        return F.col("_res." + path[7:])
    return F.col("_it." + path)


def _has_key(text_col: str, path: str) -> Column:
    top = path.split(".")[0]
    return F.coalesce(F.array_contains(F.json_object_keys(F.col(text_col)), F.lit(top)), F.lit(False))


def _raw_columns(ep: Endpoint, target: Column | None) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for name, path, _ in ep.columns:
        if path.startswith("$") and path != "$target":
            continue
        c = _leaf(path, target)
        fb = ep.fallbacks.get(name)
        if fb is not None:
            fpath, mode = fb
            alt = _leaf(fpath, target)
            if mode == "missing":
                c = F.when(_has_key("_it_text", path), c).otherwise(alt)
            elif mode == "missing_res":
                c = F.when(_has_key("_res_text", path[7:] if path.startswith("result.") else path),
                           c).otherwise(alt)
            elif mode == "falsy":
                c = F.coalesce(F.when(c != "", c), alt)
            else:
                c = F.coalesce(c, alt)
        out[name] = c
    return out


def _derived(ep: Endpoint, name: str, raw: dict[str, Column]) -> Column:
    if ep.name == "backlinks_summary" and name == "target_type":
        # "url" when a "/" is left after the scheme, else "domain"
        rest = F.regexp_replace(F.coalesce(raw["target"], F.lit("")), r"^.*?://", "")
        return F.when(F.instr(rest, "/") > 0, F.lit("url")).otherwise(F.lit("domain"))
    if ep.name == "bulk_pages_summary" and name in ("dofollow", "nofollow"):
        attrs = raw["referring_links_attributes"]
        nofollow = F.coalesce(cast_leaf(F.get_json_object(attrs, "$.nofollow"), "bigint"), F.lit(0))
        if name == "nofollow":
            return nofollow.cast("bigint")
        backlinks = F.coalesce(cast_leaf(raw["backlinks"], "bigint"), F.lit(0))
        return (backlinks - nofollow).cast("bigint")
    if name == "data":
        return F.col("_data")
    if name == "item":
        return F.col("_it_text")
    raise KeyError(f"no derived column {ep.name}.{name}")


#: More columns than these are made apart from the explode, see :func:`_apart`.
WIDE = 16


def _apart(c: Column) -> Column:
    """``c`` itself, by way of a function without generated code, which keeps the columns beside it out of the
    explode's method. With many of them that one would exceed the 8000 bytes up to which the JVM compiles a method."""
    return F.get(F.transform(F.array(c), lambda x: x), 0)


def _finished(c: Column, kind: str) -> Column:
    """The column's value from a leaf that was read in its type."""
    if kind == "csv":
        return F.array_join(c, ",")
    # a JSON number too large for a double has no value: as text it reads "Infinity", in quotes
    return F.when(F.col("_odd") | (F.abs(c) != float("inf")), c) if kind == "double" else c


def project_endpoint(ep: Endpoint, columns) -> Endpoint:
    """The endpoint restricted to ``columns`` (plus what its drop rules and
    derived columns need), so the read schema only holds those leaves."""
    from dataclasses import replace
    need = set(columns) | set(ep.required) | set(ep.nonempty)
    if ep.name == "bulk_pages_summary" and need & {"dofollow", "nofollow"}:
        need |= {"backlinks", "referring_links_attributes"}
    if ep.name == "backlinks_summary" and "target_type" in need:
        need.add("target")
    cols = [c for c in ep.columns if c[0] in need]
    fallbacks = {k: v for k, v in ep.fallbacks.items() if k in need}
    return replace(ep, columns=cols, fallbacks=fallbacks)


def flatten(responses: DataFrame, endpoint: str | Endpoint,
            keep: tuple[str, ...] = (), with_position: bool = False,
            columns=None) -> DataFrame:
    """Typed endpoint rows plus ``task_id`` from a table with ``raw`` (and
    ``target``, the requested target) columns.

    ``keep`` names input columns carried through; ``with_position`` adds
    ``item_pos``, the element's position in its response; ``columns``
    narrows the output (and the JSON read schema) to the columns named. Garbage, missing
    tasks or empty results give no rows; the schema is fixed either way.
    """
    ep = ENDPOINTS[endpoint] if isinstance(endpoint, str) else endpoint
    at_once = False
    if columns is not None:
        texts = ep.explode == "items" and _needs_item_text(ep) and _needs_result_text(ep)
        ep = project_endpoint(ep, columns)
        at_once = texts and not _needs_item_text(ep) and not _needs_result_text(ep)
    keep = list(keep)
    uses_target = any(p == "$target" for _, p, _ in ep.columns) or any(
        p == "$target" for p, _ in ep.fallbacks.values())
    carry = keep + (["target"] if uses_target and "target" not in keep else [])
    rows = explode_items(responses, ep, carry, at_once)
    raw = _raw_columns(ep, F.col("target") if uses_target else None)
    native = {} if at_once else _native(ep)
    paths = {name: p for name, p, _ in ep.columns}
    cond = F.lit(True)
    for name in ep.required:
        given = raw[name].isNotNull()
        if paths[name] in native:  # the text was there, though its cast may be null
            given = given | (F.col("_odd") & F.col("_it").isNotNull())
        cond = cond & given
    for name in ep.nonempty:
        cond = cond & (raw[name] != "")
    if ep.required or ep.nonempty:
        rows = rows.where(cond)
    typed = []
    for name, path, kind in ep.columns:
        if path.startswith("$") and path != "$target":
            typed.append(_derived(ep, name, raw).alias(name))
        elif path in native:
            typed.append(_finished(raw[name], kind).alias(name))
        else:
            typed.append(cast_leaf(raw[name], kind).alias(name))
    task_id = F.coalesce(F.col("_task.id"), F.lit(""))
    task_id = (_apart(task_id) if native and len(typed) > WIDE else task_id).alias("task_id")
    pos = [F.col("_pos").cast("bigint").alias("item_pos")] if with_position else []
    return rows.select(*keep, *typed, task_id, *pos)


def flatten_serp(responses: DataFrame, keep=(), columns=None) -> DataFrame:
    """B1: one row per SERP item; task and result fields on each item,
    ``data`` = the result without items, ``item`` = the whole item (JSON).
    ``columns`` without these two saves two of three parses."""
    return flatten(responses, "serp_organic", keep, columns=columns)


def extract_paa(serp_rows: DataFrame) -> DataFrame:
    """B2: people-also-ask questions from SERP rows: question = title,
    answer = first expanded element's description (empty when none); missing
    keys become empty text; an item that is not valid JSON is skipped."""
    paa = serp_rows.where(F.col("item_type") == "people_also_ask")
    schema = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
        T.StructField("expanded_element", T.ArrayType(T.StructType([
            T.StructField("description", T.StringType())])))])))])
    parsed = paa.select("keyword", F.from_json("item", schema).alias("_p"))
    qs = parsed.select("keyword", F.explode("_p.items").alias("q"))
    first = F.get(F.col("q.expanded_element"), 0)
    answer = F.when(F.size(F.col("q.expanded_element")) > 0,
                    F.coalesce(first["description"], F.lit(""))).otherwise(F.lit(""))
    return qs.select("keyword", F.coalesce(F.col("q.title"), F.lit("")).alias("question"),
                     answer.alias("answer"), F.coalesce(F.col("q.url"), F.lit("")).alias("url"),
                     F.coalesce(F.col("q.title"), F.lit("")).alias("title"))


def flatten_backlinks(responses: DataFrame, keep=()) -> DataFrame:
    """50 columns per backlink; ``url`` = requested target."""
    return flatten(responses, "backlinks", keep)


def flatten_bulk_pages(responses: DataFrame, keep=()) -> DataFrame:
    """20 columns per page; null items skipped; nofollow from the link
    attributes (0 when absent), dofollow = backlinks - nofollow."""
    return flatten(responses, "bulk_pages_summary", keep)


def flatten_backlinks_summary(responses: DataFrame, keep=()) -> DataFrame:
    """One row per result; target falls back to the requested one."""
    return flatten(responses, "backlinks_summary", keep)


def flatten_ranked_keywords(responses: DataFrame, keep=(), columns=None) -> DataFrame:
    """One row per ranked keyword; rows without keyword, rank, url or
    search volume are dropped (0 is kept, empty text is dropped)."""
    return flatten(responses, "ranked_keywords", keep, columns=columns)


def flatten_keyword_suggestions(responses: DataFrame, keep=()) -> DataFrame:
    """Items of the first result that has an ``items`` key."""
    return flatten(responses, "keyword_suggestions", keep)


def flatten_related_keywords(responses: DataFrame, keep=()) -> DataFrame:
    """Related keywords; a null keyword is kept; task_id first."""
    df = flatten(responses, "related_keywords", keep)
    return df.select(*keep, "task_id", *[c for c in df.columns if c not in keep and c != "task_id"])


def flatten_keyword_overview(responses: DataFrame, keep=()) -> DataFrame:
    """30 columns; language falls back to the result block."""
    return flatten(responses, "keyword_overview", keep)


def flatten_search_intent(responses: DataFrame, keep=()) -> DataFrame:
    """Keyword, main label and probability, secondary list as JSON."""
    return flatten(responses, "search_intent", keep)


def flatten_domain_rank(responses: DataFrame, keep=(), with_position: bool = False) -> DataFrame:
    """Organic and paid metric blocks per item."""
    return flatten(responses, "domain_rank_overview", keep, with_position)


def flatten_search_volume(responses: DataFrame, keep=()) -> DataFrame:
    """Rows are the results themselves; no keyword -> dropped; empty
    ``monthly_searches`` becomes null."""
    df = flatten(responses, "search_volume", keep)
    ms = F.col("monthly_searches")
    return df.withColumn("monthly_searches",
                         F.when(F.regexp_replace(ms, r"\s", "").isin("[]", "{}", '""', "null"),
                                F.lit(None)).otherwise(ms))


def keyword_count(domain_rank: DataFrame, targets: DataFrame) -> DataFrame:
    """Organic keyword count of the first row per requested target; -1
    when there is none or it is null. ``domain_rank`` comes from
    ``flatten_domain_rank(..., with_position=True)``: first = lowest item_pos
    (then task id)."""
    first = domain_rank.groupBy("target").agg(
        F.min(F.struct("item_pos", "task_id", "organic_count")).alias("_f"))
    j = targets.select("target").join(first, "target", "left")
    return j.select("target", F.coalesce(F.col("_f.organic_count"), F.lit(-1)).cast("bigint")
                    .alias("keyword_count"))
