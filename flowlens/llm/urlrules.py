"""Operator 6: URL filter rules by a sort-merge range join.

A host is turned round label by label (www.example.com -> com.example.www.), so that the hosts a
rule covers, its own and all subdomains, are one interval of keys: those that start with the
rule's key. Intervals of rules are nested or apart. URLs are range-partitioned by (key, path, id),
each rule goes to the partitions whose key range its interval meets, and one sorted sweep per
partition keeps the stack of rules whose interval is open. A hot host is spread over partitions,
since path and id are part of the sort key.

Of the fitting rules the longest text host + path wins, then the longer host, then the smaller
action. Defined results: a null url or one without "://" has empty host and path and no rule; a
path that is empty starts with no non-empty rule path; a rule with null host or path is ignored, a
null action counts as block; repeated urls and rules change nothing; an empty table gives an empty
result, no rules give the default verdict to all; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty without "://"."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Level:
    """The rules of one open host interval: paths by length, the rule texts and actions."""

    def __init__(self, key: str):
        self.key, self.paths, self.lengths = key, {}, []

    def add(self, path: str, rule: str, action: str):
        old = self.paths.get(path)
        if old is None or action < old[1]:
            self.paths[path] = (rule, action)
            self.lengths = sorted({len(p) for p in self.paths}, reverse=True)

    def longest(self, path: str):
        for n in self.lengths:
            if n <= len(path):
                hit = self.paths.get(path[:n])
                if hit:
                    return hit
        return None


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[_Level] = []
    part = None
    for b in batches:
        out: list = [[], []]
        keep = []
        cols = [b.column(i).to_pylist() for i in range(6)]
        for at, (pid, key, kind, path, rule, action) in enumerate(zip(*cols)):
            if pid != part:
                part, stack = pid, []
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1].key != key:
                    stack.append(_Level(key))
                stack[-1].add(path, rule, action)
                continue
            best = None
            for level in reversed(stack):  # innermost host first: it wins ties of length
                hit = level.longest(path)
                if hit and (best is None or len(hit[0]) > len(best[0])):
                    best = hit
            keep.append(at)
            out[0].append(best[0] if best else None)
            out[1].append(best[1] if best else None)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id").take(at), b.column("host").take(at), b.column("path").take(at),
             pa.array(out[0], pa.string()), pa.array(out[1], pa.string())],
            names=["page_id", "host", "path", "rule", "action"])


def match_rules(urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row; ``rules`` has host, path, action."""
    spark = urls.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(F.col("u"))
    u = urls.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("u")).select(
        "page_id", host.alias("host"), path.alias("path"))
    u = u.withColumn("key", host_key(F.col("host")))
    u = cut(u.repartitionByRange(parts, "key", "path", "page_id").withColumn("pid", F.spark_partition_id()))
    # key range of each partition: as many rows as partitions
    ranges = u.groupBy("pid").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    r = rules.where("host is not null and path is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("rh"), F.col("path").alias("rp"), F.coalesce("action", F.lit("block")).alias("action")).distinct()
    r = r.withColumn("key", host_key(F.col("rh")))
    meets = (F.col("key") <= F.col("hi")) & ((F.col("key") >= F.col("lo")) | F.startswith(F.col("lo"), F.col("key")))
    r = r.join(F.broadcast(ranges), meets).select(
        "pid", "key", F.lit(0).alias("kind"), F.col("rp").alias("path"), F.concat("rh", "rp").alias("rule"), "action",
        F.lit(None).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("host"))
    rows = u.select(
        "pid", "key", F.lit(1).alias("kind"), "path", F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("action"), "page_id", "host").unionByName(r)
    done = rows.repartitionById(parts, F.col("pid")).sortWithinPartitions("pid", "key", "kind").mapInArrow(
        _sweep, "page_id bigint, host string, path string, rule string, action string")
    return done.withColumn("verdict", F.coalesce("action", F.lit(default))).drop("action")
