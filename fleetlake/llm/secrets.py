"""Secrets in texts: strong patterns, and weak ones that other parts of a credential support.

Strong candidates are reported as they are. A weak one (a bare key of forty characters,
a short password) says little alone; it is reported where its complement lies in its
scope: an access or user identifier for a key, an identifier and an endpoint for a
password. Parts are intervals of code points, and scopes meet them in an interval join
on bins of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored

SCOPE = 200
_BIN = 512
_VALUE = "[A-Za-z0-9+/_.=-]"
_ASSIGN = rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?({_VALUE}+)"""
_USER = r"""(?i:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{2,64}"""
_ENDPOINT = r"""(?:https?|ftp|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]{3,}"""
_KEY = r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])"

#: name, pattern, group that holds the value, its least and largest size, role
PATTERNS = (
    ("assign", _ASSIGN, 1, 8, None, "strong"),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16, None, "strong"),
    ("hex", r"[0-9a-f]{32,}", 0, 32, None, "strong"),
    ("key", _KEY, 0, 40, 40, "weak"),
    ("password", _ASSIGN, 1, 3, 7, "weak"),
    ("user", _USER, 0, 1, None, "identifier"),
    ("endpoint", _ENDPOINT, 0, 1, None, "endpoint"),
)
STRONG = tuple(name for name, *_, role in PATTERNS if role == "strong")
REPORTED = (*STRONG, "key", "password")


def _matches(pattern: str, group: int) -> Column:
    """(gap, size, value) of each match: characters since the match before, of it, and of its group."""
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split("text", pattern, -1), F.length)
    row = F.transform(
        F.arrays_zip(gaps.alias("gap"), F.transform(whole, F.length).alias("size"), F.transform(values, F.length).alias("value")),
        lambda x: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), x["value"].alias("value")),
    )
    return F.when(F.col("text").rlike(pattern), row)


def parts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id) and their parts (row, kind, role, start, end), stored once."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    sources = {(pattern, group): f"m{i}" for i, (pattern, group) in enumerate(dict.fromkeys((p[1], p[2]) for p in PATTERNS))}
    held = stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", *[_matches(*key).alias(name) for key, name in sources.items()]
        )
    )
    listed = F.array(*[F.struct(F.lit(name).alias("source"), F.col(name).alias("found")) for name in sources.values()])
    single = (
        held.select("row", F.inline(F.filter(listed, lambda x: F.size(x["found"]) > 0)))
        .select("row", "source", F.posexplode("found").alias("nth", "match"))
        .select("row", "source", "nth", "match.*")
    )
    before = Window.partitionBy("row", "source").orderBy("nth")
    placed = single.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(before)).where("size IS NOT NULL")
    kinds = F.array(
        *[
            F.when(
                (F.col("source") == sources[pattern, group])
                & (F.col("value") >= least)
                & (F.lit(True) if most is None else F.col("value") <= most),
                F.struct(F.lit(name).alias("kind"), F.lit(role).alias("role")),
            )
            for name, pattern, group, least, most, role in PATTERNS
        ]
    )
    found = placed.select(
        "row", F.inline(F.filter(kinds, lambda x: x.isNotNull())), (F.col("end") - F.col("size")).alias("start"), "end"
    )
    return held.select("row", "doc_id"), stored(found)


def _bins(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / _BIN), F.floor(end / _BIN)))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complements lie within `scope` characters and that overlap no strong one."""
    weak = found.where("role = 'weak'").select("row", "kind", "start", "end", _bins(F.col("start"), F.col("end")).alias("bin"))
    near = F.when(F.col("role") == "strong", 0).otherwise(scope)
    other = (
        found.where("role IN ('identifier', 'endpoint', 'strong')")
        .select(
            "row",
            F.when(F.col("kind") == "access", "identifier").otherwise(F.col("role")).alias("what"),
            F.col("start").alias("from"),
            F.col("end").alias("to"),
            F.explode(F.when(F.col("kind") == "access", F.array(F.lit(0), F.lit(scope))).otherwise(F.array(near))).alias("reach"),
        )
        .withColumn("what", F.when(F.col("reach") == 0, "strong").otherwise(F.col("what")))
        .withColumn("bin", _bins(F.greatest(F.col("from") - F.col("reach"), F.lit(0)), F.col("to") + F.col("reach")))
    )
    meets = (F.col("from") - F.col("reach") < F.col("end")) & (F.col("start") < F.col("to") + F.col("reach"))
    has = {w: F.bool_or(F.col("what") == w) for w in ("identifier", "endpoint", "strong")}
    return (
        weak.join(other, ["row", "bin"])
        .where(meets)
        .groupBy("row", "kind", "start", "end")
        .agg(*[c.alias(w) for w, c in has.items()])
        .where("NOT strong AND identifier AND (kind = 'key' OR endpoint)")
        .select("row", "kind", "start", "end")
    )


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: doc_id, plain and spans, arrays of (start, rank, kind, end) by start, then kind.

    `plain` has strong candidates, `spans` also linked weak ones; offsets are code points,
    end is exclusive. Null and empty texts have none. Ids may be null or repeated: rows
    are told apart by a number of their own. Other columns are ignored, and an empty
    table gives no rows. A document's parts meet only within bins of fixed width, so the
    join grows with the text.
    """
    rows, found = parts(docs, id_column, text_column)
    reported = found.where("role = 'strong'").select("row", "kind", "start", "end", F.lit(True).alias("strong")).union(
        linked(found, scope).withColumn("strong", F.lit(False))
    )
    rank = F.coalesce(*[F.when(F.col("kind") == name, F.lit(i)) for i, name in enumerate(REPORTED)])
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    gathered = reported.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("strong"), span))).alias("plain"), F.array_sort(F.collect_list(span)).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return rows.join(gathered, "row", "left").select(
        "doc_id", F.coalesce("plain", none).alias("plain"), F.coalesce("spans", none).alias("spans")
    )
