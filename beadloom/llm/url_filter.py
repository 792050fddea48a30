"""URL filters by a sort-merge range join of reversed-host keys with nested rules.

A rule (host, path, verdict) fits its host and all subdomains when the URL's path starts with the rule's path. In
reversed form (`org.example.`) a host and its subdomains are one interval of keys. URLs and rules are swept in key
order; a stack holds the rules whose interval is open, each nested in the one below.

Few rules go to every task, which sorts and sweeps its own URLs, so nothing is shuffled. More rules than a task should
hold are dealt with the URLs over ranges of keys, and each range is swept as it streams by.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beadloom.llm.common import read

#: Bytes of rules, about, that every task gets; more are dealt over ranges of keys.
MAX_BROADCAST = 8 << 20
#: URLs of a range of keys, about; ranges at most; sampled URLs for each range.
RANGE_URLS, RANGES, SAMPLED = 200_000, 10_000, 30

#: The rule set of the op10 query: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
#: Above every character of a host.
_LAST = "\U0010ffff"


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for a null URL or one without '://'. Such columns are replaced."""
    at = F.instr(F.col(url), "://")
    rest = F.coalesce(F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.select(*(c for c in df.columns if c.lower() not in ("host", "path")), host.alias("host"), path.alias("path"))


def reversed_host(host: str) -> str:
    """`example.org` as `org.example.`: what all its subdomains' keys begin with."""
    return ".".join(reversed(host.split("."))) + "." if host else ""


def _reversed(host: str) -> Column:
    return F.when(F.col(host) == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


class Nested:
    """The stack of a sweep: rules whose interval holds the present key, each host's nested in the one below."""

    def __init__(self):
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, text: str, verdict: str) -> None:
        """A rule at key, which is not less than any key before."""
        self._close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, own, sizes = self.stack[-1]
        own[path] = (text, verdict)
        if (at := bisect_left(sizes, len(path))) == len(sizes) or sizes[at] != len(path):
            sizes.insert(at, len(path))

    def verdict(self, key: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the fitting rule of longest text, of equal ones that of the longer host; else (None, None)."""
        self._close(key)
        best: tuple[str, str] | None = None
        for _, own, sizes in reversed(self.stack):  # innermost host first, so ties stay with the longer host
            for size in reversed(sizes):
                if hit := own.get(path[:size]) if size <= len(path) else None:
                    if best is None or len(hit[0]) > len(best[0]):
                        best = hit
                    break
        return best or (None, None)


def sweep(keys: Sequence[tuple[str, str]], rules: Sequence[tuple[str, str, str, str]]) -> list[tuple[str | None, str | None]]:
    """(rule, verdict) for each (reversed host, path) of keys; rules: (reversed host, path, text, verdict). Both are sorted."""
    out: list[tuple[str | None, str | None]] = []
    nested, k = Nested(), 0
    for key, path in keys:
        while k < len(rules) and rules[k][0] <= key:
            nested.open(*rules[k])
            k += 1
        out.append(nested.verdict(key, path))
    return out


def prepared(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str, str]]:
    """(reversed host, path, host + path, verdict), sorted, hosts lower-cased (A-Z). Of equal (host, path) the least verdict counts."""
    by: dict[tuple[str, str], str] = {}
    for host, path, verdict in sorted((host.translate(_TO_LOWER), path, verdict) for host, path, verdict in rules):
        by.setdefault((host, path), verdict)
    return sorted((reversed_host(h), p, h + p, v) for (h, p), v in by.items())


def apply_rules(df: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, url: str = "url", default: str = "allow", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """df with host, path, rule (host + path of the longest fitting rule, else null) and verdict.

    rules: a sequence, or a DataFrame (host, path, verdict) of any size; rows with nulls are no rules. A URL that no
    rule fits gets `default` (allow). A null URL or one without '://' has empty host and path, so only a rule with both
    empty fits it; rules with an empty host fit every host. Repeated URLs are judged alike, repeated rules count once.
    An empty df gives an empty result; columns of df named host, path, rule or verdict are replaced, all others kept.

    max_broadcast: bytes of rules, beyond which the sweep runs over ranges of keys; the result is the same.
    """
    df = with_host_path(df.drop("host", "path", "rule", "verdict"), url)
    if isinstance(rules, DataFrame):
        rules = rules.select("host", "path", "verdict").dropna()
        size = rules.agg(F.sum(F.octet_length("host") * 2 + F.octet_length("path") * 2 + F.octet_length("verdict") + 200)).first()[0] or 0
        if size > max_broadcast:
            return _by_ranges(df, rules, default)
        rules = [tuple(r) for r in rules.collect()]
    table = prepared(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(map(reversed_host, batch.column("host").to_pylist()), batch.column("path").to_pylist(), strict=True))
            order = sorted(range(len(keys)), key=keys.__getitem__)
            found: list[tuple[str | None, str | None]] = [(None, None)] * len(keys)
            for k, hit in zip(order, sweep([keys[k] for k in order], table), strict=True):
                found[k] = hit
            out = [*batch.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v or default for _, v in found], pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, "rule", "verdict"])

    return df.mapInArrow(judge, _judged(df))


def _judged(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


def _by_ranges(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same sweep for any number of rules, over ranges of (key, salt).

    The salt, a hash of the row, splits a host that many URLs have. Borders are quantiles of a sample, at most RANGES *
    SAMPLED hosts or so. A rule goes to all ranges that its interval meets, so each range begins with the rules that are
    open at its border. A task holds the rules of one key and its ancestors at a time.
    """
    rules = rules.groupBy(F.translate("host", _UPPER, _LOWER).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.select(_reversed("host").alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    urls = df.select(_reversed("host").alias("key"), F.xxhash64(*plain).alias("salt"), "path", F.struct(*df.columns).alias("row"))
    n = df.count()
    ranges = min(RANGES, n // RANGE_URLS + 1)
    share = min(1.0, SAMPLED * ranges / max(1, n))
    some = sorted(tuple(r) for r in urls.filter(F.pmod("salt", F.lit(1 << 30)) < share * (1 << 30)).select("key", "salt").collect())
    borders = [some[k * len(some) // ranges] for k in range(1, ranges)] if some else []

    def deal_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(borders, place) for place in zip(batch.column("key").to_pylist(), batch.column("salt").to_pylist(), strict=True)]
            none = pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column("key"), pa.array([1] * len(at), pa.int32()), batch.column("path"), none, none, batch.column("row")], names=names)

    def deal_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for k, key in enumerate(batch.column("key").to_pylist()):
                met = range(bisect_left(borders, (key, -(1 << 63))), bisect_right(borders, (key + _LAST, 1 << 63)) + 1)
                at += met
                rows += [k] * len(met)
            yield batch.take(pa.array(rows, pa.int64())).add_column(0, "range", pa.array(at, pa.int32()))

    names, own = ["range", "key", "kind", "path", "rule", "verdict", "row"], df.columns
    row = df.schema.simpleString()
    dealt = urls.mapInArrow(deal_urls, f"range int, key string, kind int, path string, rule string, verdict string, row {row}")
    opened = rules.mapInArrow(deal_rules, "range int, key string, path string, rule string, verdict string")
    both = dealt.unionByName(opened.select("range", "key", F.lit(0).alias("kind"), "path", "rule", "verdict", F.lit(None).cast(row).alias("row")))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, nested = None, Nested()
        for batch in batches:
            found: list[tuple[str | None, str | None]] = []
            for at, key, kind, path, rule, verdict in zip(*(batch.column(c).to_pylist() for c in names[:-1]), strict=True):
                if at != present:
                    present, nested = at, Nested()
                if kind:
                    found.append(nested.verdict(key, path))
                else:
                    nested.open(key, path, rule, verdict)
            if found:
                rows = batch.filter(pc.equal(batch.column("kind"), 1)).column("row")
                out = [*(rows.field(c) for c in own), pa.array([r for r, _ in found], pa.string()), pa.array([v or default for _, v in found], pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[*own, "rule", "verdict"])

    return both.repartition(ranges, "range").sortWithinPartitions("range", "key", "kind", "path").mapInArrow(judge, _judged(df))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT h.page_id, rh || rp AS rule, rv, row_number() OVER (PARTITION BY h.page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
        FROM h JOIN rules ON (h.host = rh OR ends_with(h.host, '.' || rh)) AND starts_with(h.path, rp))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.rv, 'allow') AS verdict FROM h LEFT JOIN m ON m.page_id = h.page_id AND m.k = 1
"""
