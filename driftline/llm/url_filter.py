"""URL filter: a sort-merge range join of urls with host and path rules.

A host is written with its labels reversed, so a rule for a host and all its subdomains is
an interval of the sorted keys. Urls and rules are cut into key ranges; inside each range
one sweep over the sorted keys keeps a stack of the rules whose interval is still open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from driftline.llm.common import ascii_lower
from driftline.shared import staged

ROWS_PER_RANGE = 100_000
_BOUND_SAMPLES = 100
_BOUND_CHARS = 300
_TOP = chr(0x10FFFF) * 4

_RESULT = "page_id string, host string, path string, rule string, verdict string"


def host_and_path(url):
    """Columns (host, path) of a url; both empty without ``://`` or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(_url, instr(_url, '://') + 3)"))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    tail = F.expr("substr(_rest, length(_host) + 1)")
    return rest, host, F.coalesce(F.regexp_extract(tail, r"^[^?#]*", 0), F.lit(""))


def reversed_host(host):
    """``www.example.com`` as ``com.example.www.``; the empty host as the empty string."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judges every row of ``pages(page_id, url)`` by ``rules(host, path, verdict)``.

    A rule fits its host and all subdomains when the url's path starts with the rule's
    path; an empty rule host fits every host. The longest rule text wins, then the longer
    host; of two rules with one text ``block`` wins. A url that no rule fits gets
    ``default`` and a null rule. A null url, or one without ``://``, has empty host and
    path. Rules with a null host, path or verdict fit nothing. Repeated pages stay
    repeated; an empty table gives no rows; other columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    # Ids travel as text: a null among them would turn whole numbers into fractions.
    urls = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").alias("_url"))
    rest, host, path = host_and_path(F.col("_url"))
    urls = urls.withColumn("_rest", rest).withColumn("_raw", host)
    urls = urls.withColumn("_host", F.col("_raw")).withColumn("path", path)
    urls = urls.select("page_id", ascii_lower(F.col("_raw")).alias("host"), "path")
    # The hash of the id ends the sort key, so one url on very many rows still splits.
    urls = urls.withColumn(
        "key",
        F.concat(
            reversed_host(F.col("host")),
            F.lit("\x00"),
            F.col("path"),
            F.lit("\x00"),
            F.lpad(F.hex(F.xxhash64("page_id")), 16, "0"),
        ),
    )
    urls = staged(urls, "urls")
    bounds = _bounds(urls)
    known = rules.select(
        ascii_lower(F.col("host")).alias("host"), F.col("path"), F.col("verdict")
    ).dropna()
    known = known.groupBy("host", "path").agg(F.max(F.col("verdict")).alias("verdict")).select(
        reversed_host(F.col("host")).alias("start"),
        "path",
        F.concat("host", "path").alias("rule"),
        F.length("host").cast("int").alias("host_len"),
        "verdict",
    )

    def ranges_of_urls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["range"] = np.searchsorted(bounds, rows["key"].to_numpy(dtype=object), "right")
            yield rows

    def ranges_of_rules(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A rule reaches every range its interval meets: its own, and one more for
        # each range bound that lies inside the interval.
        for rows in batches:
            starts = rows["start"].to_numpy(dtype=object)
            first = np.searchsorted(bounds, starts, "right")
            last = np.searchsorted(bounds, starts + _TOP, "right")
            rows["range"] = [list(range(a, b + 1)) for a, b in zip(first, last, strict=True)]
            yield rows.explode("range").astype({"range": "int64"})

    left = urls.mapInPandas(
        ranges_of_urls, "page_id string, host string, path string, key string, range long"
    )
    right = known.mapInPandas(
        ranges_of_rules,
        "start string, path string, rule string, host_len int, verdict string, range long",
    )
    parts = max(len(bounds) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left, right = left.repartition(parts, "range"), right.repartition(parts, "range")

    def sweep(urls: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
        return _sweep(urls, rules, default)

    judged = left.groupBy("range").cogroup(right.groupBy("range")).applyInPandas(sweep, _RESULT)
    return judged.withColumn("page_id", F.col("page_id").cast(dict(pages.dtypes)["page_id"]))


def _bounds(urls: DataFrame) -> np.ndarray:
    """Cuts between key ranges of about equal size; they balance tasks and decide nothing."""
    rows = urls.count()
    ranges = -(-rows // ROWS_PER_RANGE)
    if ranges < 2:
        return np.array([], dtype=object)
    share = min(1.0, _BOUND_SAMPLES * ranges / rows)
    seen = urls.select(F.substring("key", 1, _BOUND_CHARS)).sample(share, seed=1).collect()
    keys = sorted(r[0] for r in seen)
    cuts = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    return np.array(sorted(set(cuts)), dtype=object)


def _sweep(urls: pd.DataFrame, rules: pd.DataFrame, default: str) -> pd.DataFrame:
    """One pass over urls and rule hosts in key order.

    A stack entry is a rule host that is a prefix of the current key, with the paths of
    its rules; entries below it are its parent domains.
    """
    urls = urls.sort_values("key")
    hosts: dict[str, dict[str, tuple]] = {}
    for start, path, rule, host_len, verdict in zip(
        rules["start"], rules["path"], rules["rule"], rules["host_len"], rules["verdict"], strict=True
    ):
        hosts.setdefault(start, {})[path] = (len(rule), host_len, rule, verdict)
    coming = sorted(hosts, reverse=True)
    stack: list[tuple[str, dict, list[int]]] = []
    found, verdicts = [], []
    for key, path in zip(urls["key"], urls["path"], strict=True):
        while coming and coming[-1] <= key:
            start = coming.pop()
            while stack and not start.startswith(stack[-1][0]):
                stack.pop()
            paths = hosts[start]
            stack.append((start, paths, sorted({len(p) for p in paths}, reverse=True)))
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        best = None
        for _, paths, lengths in stack:
            # The longest fitting path of a host is its longest fitting rule.
            fit = next((paths[path[:n]] for n in lengths if n <= len(path) and path[:n] in paths), None)
            if fit and (best is None or fit > best):
                best = fit
        found.append(best[2] if best else None)
        verdicts.append(best[3] if best else default)
    return pd.DataFrame(
        {
            "page_id": urls["page_id"],
            "host": urls["host"],
            "path": urls["path"],
            "rule": pd.Series(found, index=urls.index, dtype=object),
            "verdict": pd.Series(verdicts, index=urls.index, dtype=object),
        }
    )
