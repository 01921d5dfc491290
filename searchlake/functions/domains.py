"""Domain, URL and name functions (G1-G9) as native column expressions.

No Python UDF: each function is a short chain of regex and array built-ins,
so it stays inside whole-stage codegen. The functions that need public
suffixes (G5, G6) work on frames and take the suffix rules as a table, see
:func:`suffix_rules`.
"""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A rule table of at most this many rows (about 1 MB) is broadcast.
BROADCAST_RULES = 20_000

_WS = r"(?s)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Python ``str.strip()``: all leading and trailing whitespace."""
    return F.regexp_replace(c, _WS, "")


def _head(s: Column) -> Column:
    """Shared head of G1 and G2: strip, lower, cut scheme, drop leading www."""
    d = F.lower(strip(s))
    d = F.regexp_replace(d, r"(?s)^.*?://", "")
    return F.regexp_replace(d, r"^www\.", "")


def clean_domain(s: Column) -> Column:
    """G1: bare host of a URL or domain text (no scheme, www, path, port)."""
    d = F.regexp_replace(_head(s), r"(?s)[/?#].*$", "")
    d = F.regexp_replace(d, r":[^:]*$", "")
    return strip(d)


def clean_domain_keep_path(s: Column) -> Column:
    """Like G1 but keeps the path; drops query, fragment, host port and
    trailing slashes."""
    d = F.regexp_replace(_head(s), r"(?s)[?#].*$", "")
    host = F.regexp_extract(d, r"^([^/]*)", 1)
    rest = F.regexp_extract(d, r"(?s)^[^/]*(/.*)?$", 1)
    host = F.regexp_replace(host, r":[^:]*$", "")
    return F.regexp_replace(F.concat(host, rest), r"/+$", "")


def normalize_domain_sql(s: Column) -> Column:
    """Strip ``(https?://)?(www.)?`` case-sensitively, trailing slashes,
    all whitespace; then lower."""
    d = F.regexp_replace(s, r"^(https?://)?(www\.)?", "")
    d = F.regexp_replace(d, r"/+$", "")
    d = F.regexp_replace(d, r"\s+", "")
    return F.lower(d)


def normalize_domain_review(s: Column) -> Column:
    """Trim first, case-insensitive prefix strip; null -> empty."""
    d = F.regexp_replace(strip(s), r"(?i)^(?:https?://)?(?:www\.)?", "")
    d = F.regexp_replace(d, r"/+$", "")
    d = F.regexp_replace(d, r"\s+", "")
    return F.coalesce(F.lower(d), F.lit(""))


@lru_cache(maxsize=4)
def read_suffix_list(path: str | None = None) -> list[str]:
    """Rules of the ICANN part of a public suffix list file.

    Without a path, the copy that Spark's HTTP client jar carries is read.
    No list at all is an error: a guess would cut names in the wrong place.
    """
    if path is not None:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    else:
        import pyspark
        home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
        jars = glob.glob(os.path.join(home, "jars", "httpclient-4*.jar"))
        if not jars:
            raise FileNotFoundError("no public suffix list: give the path of one")
        with zipfile.ZipFile(jars[0]) as z:
            text = z.read("mozilla/public-suffix-list.txt").decode("utf-8")
    part = text.split("===BEGIN ICANN DOMAINS===")[-1].split("===END ICANN DOMAINS===")[0]
    rules = [x.split()[0].lower() for x in part.splitlines() if x.strip() and not x.startswith("//")]
    if not rules:
        raise ValueError("the public suffix list has no rules")
    return rules


def suffix_rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The suffix rules as a table: tail, labels, and whether the tail is a
    plain rule, the base of a wildcard rule, or an exception."""
    kinds: dict[str, list[bool]] = {}
    for rule in read_suffix_list(path):
        tail = rule.lstrip("!").removeprefix("*.")
        kind = kinds.setdefault(tail, [False, False, False])
        kind[2 if rule.startswith("!") else 1 if rule.startswith("*.") else 0] = True
    tails = list(kinds)
    flags = {name: pa.array([kinds[t][i] for t in tails]) for i, name in enumerate(("plain", "wild", "exception"))}
    table = pa.table({"tail": pa.array(tails), "labels": pa.array([t.count(".") + 1 for t in tails], pa.int32()), **flags})
    # Arrow data of this size is part of the plan: reading the rules takes no job
    rules = spark.createDataFrame(table)
    _SIZES[rules] = (len(tails), max(t.count(".") + 1 for t in tails))
    return rules


#: (rules, most labels) of rule tables whose size is known.
_SIZES: WeakKeyDictionary = WeakKeyDictionary()


def _size_of(rules: DataFrame) -> tuple[int, int]:
    if rules not in _SIZES:
        _SIZES[rules] = tuple(rules.agg(F.count(F.lit(1)), F.max("labels")).first())
    return _SIZES[rules]


def with_suffix_size(df: DataFrame, host: Column, rules: DataFrame, out: str = "_k") -> DataFrame:
    """Add ``out``: the number of labels in the host's public suffix, 0 when none.

    The host's last 1, 2, ... labels are looked up in one relation of the
    rules, which is broadcast once (a tail only meets rules of as many labels).
    An exception rule wins and is one label shorter; else the longest match
    wins, and a wildcard takes one label more than its base, if there is one.
    """
    n_rules, most = _size_of(rules)
    if not n_rules:
        raise ValueError("no public suffix rules")
    labels = F.split(host, r"\.")
    df = df.withColumns({"_labels": labels, "_n": F.size(labels)})
    plain = wild = exception = F.lit(0)
    drop = ["_labels", "_n"]
    for size in range(1, most + 1):
        side = rules.select(
            F.col("tail").alias(f"_tail{size}"), F.col("plain").alias(f"_p{size}"),
            F.col("wild").alias(f"_w{size}"), F.col("exception").alias(f"_e{size}"))
        if n_rules <= BROADCAST_RULES:
            side = F.broadcast(side)
        tail = F.when(F.col("_n") >= size, F.array_join(F.slice("_labels", -size, size), "."))
        df = df.withColumn(f"_tail{size}", tail).join(side, f"_tail{size}", "left")
        plain = F.when(F.col(f"_p{size}"), F.lit(size)).otherwise(plain)
        wild = F.when(F.col(f"_w{size}") & (F.col("_n") > size), F.lit(size + 1)).otherwise(wild)
        exception = F.when(F.col(f"_e{size}"), F.lit(size - 1)).otherwise(exception)
        drop += [f"_tail{size}", f"_p{size}", f"_w{size}", f"_e{size}"]
    return df.withColumn(out, F.when(exception > 0, exception).otherwise(F.greatest(plain, wild))).drop(*drop)


def title_case(s: Column) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of
    letters, lower-case the rest (so ``a1b`` -> ``A1B``)."""
    runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                             F.lower(F.substring(r, 2, 1 << 30)))),
        "")


def domain_to_name(df: DataFrame, col: str, rules: DataFrame, out: str = "domain_name") -> DataFrame:
    """Add ``out``, the registered name of ``col`` as a display title; no
    known suffix or name -> first label of the text without ``www.``; ``-``
    and ``_`` become spaces."""
    s = F.col(col)
    labels = F.split(url_host(s), r"\.")
    k, n = F.col("_k"), F.size(labels)
    name = F.when((k > 0) & (n > k), F.get(labels, n - k - 1))
    fallback = F.split(F.replace(F.lower(s), F.lit("www."), F.lit("")), r"\.")[0]
    name = F.when(F.coalesce(name, F.lit("")) == "", fallback).otherwise(name)
    return with_suffix_size(df, url_host(s), rules).withColumn(out, title_case(F.translate(name, "-_", "  "))).drop("_k")


def url_host(url: Column) -> Column:
    """Host of a URL: no scheme, user info, port, path, query or fragment."""
    h = F.regexp_replace(url, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", "")
    h = F.regexp_replace(h, r"(?s)[/?#].*$", "")
    h = F.regexp_replace(h, r"^.*@", "")
    h = F.regexp_replace(h, r":[0-9]*$", "")
    return F.lower(h)


_IP = r"^[0-9]+(\.[0-9]+){3}$"


def registered_domain(df: DataFrame, col: str, rules: DataFrame, out: str = "registered") -> DataFrame:
    """Add ``out``, the ``name.suffix`` of a URL (an empty name when the
    host is a suffix); with no known suffix the last label (or the whole IP
    address) followed by ``.``."""
    host = url_host(F.col(col))
    labels, k = F.split(host, r"\."), F.col("_k")
    n, is_ip = F.size(labels), host.rlike(_IP)
    with_suffix = F.concat(F.coalesce(F.get(labels, n - k - 1), F.lit("")), F.lit("."),
                           F.array_join(F.slice(labels, n - k + 1, F.greatest(k, F.lit(1))), "."))
    no_suffix = F.concat(F.when(is_ip, host).otherwise(F.element_at(labels, -1)), F.lit("."))
    return with_suffix_size(df, host, rules).withColumn(
        out, F.when((k > 0) & ~is_ip, with_suffix).otherwise(no_suffix)).drop("_k")


def registered_name(df: DataFrame, col: str, rules: DataFrame, out: str = "name") -> DataFrame:
    """Add ``out``, the label before the public suffix; with no known suffix
    the last label (the whole host for an IP address)."""
    host = url_host(F.col(col))
    labels, k = F.split(host, r"\."), F.col("_k")
    n = F.size(labels)
    return with_suffix_size(df, host, rules).withColumn(
        out, F.when(host.rlike(_IP), host)
        .when(k > 0, F.coalesce(F.get(labels, n - k - 1), F.lit("")))
        .otherwise(F.element_at(labels, -1))).drop("_k")


def url_path(url: Column) -> Column:
    """Path of a URL, ``/`` when it has none."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    rest = F.regexp_replace(rest, r"^//[^/?#]*", "")
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def endpoint_slug(url: Column) -> Column:
    """Path segments after ``/v3/`` up to the first UUID-like one, joined
    by ``-``; ``unknown`` when none."""
    after = F.element_at(F.split(url, "/v3/", 2), -1)
    parts = F.filter(F.split(after, "/"), lambda p: p != "")
    is_id = F.transform(parts, lambda p: (F.length(p) == 36) & (F.size(F.split(p, "-")) == 5))
    stop = F.array_position(is_id, True)
    kept = F.when(stop == 0, parts).otherwise(F.slice(parts, 1, (stop - 1).cast("int")))
    slug = F.array_join(kept, "-")
    return F.when(slug == "", F.lit("unknown")).otherwise(slug)


def project_domain_name(name: Column) -> Column:
    """Drop a trailing ``_digits``."""
    return F.regexp_replace(name, r"_[0-9]+$", "")
