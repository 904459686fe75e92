"""Near-duplicate embeddings by product quantisation.

Unit vectors go to the inverted list of their nearest coarse centroid, and what is left
after the centroid is coded in subspaces, a byte for each. A query goes to the lists of its
nearest centroids, a byte for each of its dimensions, and reads its distances to the codes
there from tables of its own. A coded vector is a candidate while the triangle inequality
allows the threshold, given how far both are from what was sent of them; so within probed
lists no link is lost.

Candidates are not written as pairs. Two lists learn which of their vectors have any
candidate in the other, asked from either side, and only these meet, once for each two lists,
to be compared by exact cosine in double precision. A list meets itself as well. A meeting
reports counts for the vectors of both sides and a spanning set of links.

Probes: vectors at just the threshold from sampled ones are made in random directions, and
`PROBE_FACTOR` times as many lists are probed as find `RECALL` of these partners from either
side, whatever the size of the table. There are about twice the root of the vectors' number of
lists, `MOST_LISTS` at most. Centroids and probes are fitted on a sample of `SAMPLE_ROWS` vectors,
or `ROWS_A_LIST` for each list where that is more, but of at most `SAMPLE_NUMBERS` components
together, code books on `CODE_ROWS` of it; all vectors are indexed and all are queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, ship, stored

SAMPLE_ROWS = 20_000
ROWS_A_LIST = 8
SAMPLE_NUMBERS = 1 << 24
MOST_LISTS = 16_384
SUBSPACES = 16
CODES = 256
CODE_ROWS = 8_000
RECALL = 0.995
PROBE_FACTOR = 2
PROBE_TRIALS = 2_000
CELL_ROWS = 2048
_STEPS = 127
_ROW = "rep long, size int, code binary, error float, query binary, scale float, list int, probes array<int>"
_CANDIDATES = "low int, high int, list int, rep long"


def _nearest(rows: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    """Indices of the n nearest centres of each row, nearest first."""
    distance = (centres**2).sum(1)[None, :] - 2 * rows @ centres.T
    if n == 1:
        return distance.argmin(1)[:, None]
    found = np.argpartition(distance, n - 1, axis=1)[:, :n]
    return np.take_along_axis(found, np.take_along_axis(distance, found, 1).argsort(1), 1)


def _step(centres: int) -> int:
    """Rows whose distances to that many centres are held at a time."""
    return max(64, min(2048, (1 << 22) // centres))


def _all_nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row, in blocks of bounded size."""
    step = _step(len(centres))
    return np.concatenate([_nearest(rows[i : i + step], centres)[:, 0] for i in range(0, len(rows), step)])


def _centres(rows: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced rows of a shuffle with a fixed seed."""
    rng = np.random.default_rng(7)
    centres = rows[rng.permutation(len(rows))[:n]].copy()
    for _ in range(rounds):
        mine = _all_nearest(rows, centres)
        counts = np.bincount(mine, minlength=len(centres))
        order = np.argsort(mine, kind="stable")
        full = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[full]
        centres[full] = np.add.reduceat(rows[order], starts, axis=0) / counts[full, None]
    return centres


def _partners(rows: np.ndarray, threshold: float) -> np.ndarray:
    """A vector at just the threshold from each row, in a random direction of a fixed seed."""
    side = np.random.default_rng(11).normal(size=rows.shape)
    side -= (side * rows).sum(1, keepdims=True) * rows
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    return threshold * rows + np.sqrt(max(0.0, 1 - threshold**2)) * side


@dataclass
class Index:
    """Coarse centroids, code books of the subspaces of residuals, and how many lists are probed."""

    coarse: np.ndarray
    books: np.ndarray  # subspace, code, dimension within
    probes: int

    @staticmethod
    def fit(rows: np.ndarray, lists: int, threshold: float) -> Index:
        coarse = _centres(rows, min(lists, len(rows)))
        some = rows[:CODE_ROWS]
        left = some - coarse[_all_nearest(some, coarse)]
        width = -(-rows.shape[1] // SUBSPACES)
        left = np.pad(left, ((0, 0), (0, width * SUBSPACES - rows.shape[1])))
        books = [_centres(left[:, i * width : (i + 1) * width], min(CODES, len(some)), 6) for i in range(SUBSPACES)]
        trial = rows[:PROBE_TRIALS]
        ranks = Index._ranks(trial, _partners(trial, threshold), coarse)
        probes = int(np.sort(ranks)[max(0, int(np.ceil(RECALL * len(ranks))) - 1)]) + 1
        return Index(coarse, np.stack(books), min(len(coarse), PROBE_FACTOR * probes))

    @staticmethod
    def _ranks(rows: np.ndarray, partners: np.ndarray, coarse: np.ndarray) -> np.ndarray:
        """How many lists are nearer to one vector than its partner's list, from the better side."""
        size, ranks = (coarse**2).sum(1), []
        for at in range(0, len(rows), 256):
            sides = [size - 2 * x[at : at + 256] @ coarse.T for x in (rows, partners)]
            for mine, other in (sides, sides[::-1]):
                target = np.take_along_axis(mine, other.argmin(1)[:, None], 1)
                ranks.append((mine < target).sum(1))
        return np.minimum(np.concatenate(ranks[0::2]), np.concatenate(ranks[1::2]))

    def split(self, residuals: np.ndarray) -> np.ndarray:
        width = self.books.shape[2]
        padded = np.pad(residuals, ((0, 0), (0, width * SUBSPACES - residuals.shape[1])))
        return padded.reshape(len(residuals), SUBSPACES, width)

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each vector is from what its code says."""
        parts = self.split(residuals)
        codes = np.stack([_nearest(parts[:, i], self.books[i])[:, 0] for i in range(SUBSPACES)], axis=1).astype(np.uint8)
        coded = np.stack([self.books[i][codes[:, i]] for i in range(SUBSPACES)], axis=1)
        return codes, np.sqrt(((parts - coded) ** 2).sum((1, 2)))

    def tables(self, residuals: np.ndarray) -> np.ndarray:
        """Squared distances from each query to every code: subspace, query, code."""
        parts = self.split(residuals)
        product = parts.transpose(1, 0, 2) @ self.books.transpose(0, 2, 1)
        return ((parts**2).sum(2).T[:, :, None] + (self.books**2).sum(2)[:, None, :] - 2 * product).astype(np.float32)


def _unit(rows: list, dimensions: int) -> np.ndarray:
    out = np.zeros((len(rows), dimensions))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    # by a power of two, exactly, so that squares neither overflow nor vanish
    out = np.ldexp(out, -np.frexp(np.abs(out).max(axis=1, keepdims=True, initial=0.0))[1])
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _candidates(index: Index, dimensions: int, threshold: float):
    """Which vectors of a list and of the queries sent there have any candidate, by their two lists."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-5
    steps = float(np.sqrt(dimensions)) / 2

    def find(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        base, asked = group[group["is_base"]], group[~group["is_base"]]
        if base.empty or asked.empty:
            return pd.DataFrame({"low": [], "high": [], "list": [], "rep": []}).astype({"low": "int32", "high": "int32", "list": "int32", "rep": "int64"})
        codes = np.frombuffer(b"".join(base["code"]), np.uint8).reshape(len(base), SUBSPACES).T.astype(np.intp)
        error, names = base["error"].to_numpy(np.float32), base["rep"].to_numpy()
        scales = asked["scale"].to_numpy(np.float64)
        sent = np.frombuffer(b"".join(asked["query"]), np.int8).reshape(len(asked), dimensions) * scales[:, None]
        centre, homes = index.coarse[key[0]], asked["list"].to_numpy()
        wide = scales * steps  # half a step off in every dimension at most
        lists, home = np.unique(homes, return_inverse=True)
        hit, met = np.zeros(len(asked), bool), [np.zeros(0, np.int64)]
        for at in range(0, len(asked), 256):
            some = slice(at, at + 256)
            tables = index.tables(sent[some] - centre)
            distance = np.take(tables[0], codes[0], axis=1)
            for s in range(1, SUBSPACES):
                distance += np.take(tables[s], codes[s], axis=1)
            q, b = np.nonzero(distance <= (radius + wide[some, None] + error[None, :]) ** 2)
            hit[at + q] = True
            # which of the list's vectors the queries of each other list have met
            met.append(np.unique(home[at + q] * len(base) + b))
        met = np.unique(np.concatenate(met))
        from_home, of_base = lists[met // len(base)], met % len(base)
        asking = np.flatnonzero(hit)
        other = np.concatenate([homes[asking], from_home]).astype(np.int32)
        mine = np.full(len(other), key[0], np.int32)
        return pd.DataFrame(
            {
                "low": np.minimum(mine, other),
                "high": np.maximum(mine, other),
                "list": np.concatenate([homes[asking].astype(np.int32), mine[len(asking) :]]),
                "rep": np.concatenate([asked["rep"].to_numpy()[asking], names[of_base]]),
            }
        )

    return find


def _meet(dimensions: int, threshold: float):
    """Counts of linked vectors for both sides of a meeting, and links that span what is linked there."""

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        same_list, same_part = key[0] == key[1], key[2] == key[3]
        left = group[group["is_left"]]
        right = left if same_list and same_part else group[~group["is_left"]]
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        sides = []
        for side in (left, right):
            names, copies, sizes = (side[c].to_numpy(np.int64) for c in ("rep", "copies", "size"))
            sides.append((names, copies, sizes, _unit(list(side["v"]), dimensions)))
        (names, copies, sizes, rows), (others, other_copies, other_sizes, other_rows) = sides
        nodes, slot = np.unique(np.concatenate([names, others]), return_inverse=True)
        root = np.arange(len(nodes))
        counts = np.zeros(len(nodes), np.int64)
        for at in range(0, len(rows), 256):
            a, b = np.nonzero(rows[at : at + 256] @ other_rows.T >= threshold - 1e-6)
            a += at
            cosine = np.concatenate(
                [np.einsum("ij,ij->i", rows[a[i : i + 65536]], other_rows[b[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)]
            )
            true = (cosine >= threshold) & (names[a] != others[b]) & (sizes[a] == other_sizes[b])
            a, b = a[true], b[true]
            x, y = slot[a], slot[len(names) + b]
            np.add.at(counts, x, other_copies[b])
            if right is not left:  # a side that meets itself has each pair twice
                np.add.at(counts, y, copies[a])
            while len(x):
                low = np.minimum(root[x], root[y])
                before = root.copy()
                np.minimum.at(root, root[x], low)
                np.minimum.at(root, root[y], low)
                root = root[root]
                if (before == root).all() and (root[x] == root[y]).all():
                    break
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        some = counts > 0
        return pd.DataFrame(
            {
                "a": np.concatenate([nodes[some], nodes[linked]]),
                "b": np.concatenate([np.full(some.sum(), -1), nodes[root[linked]]]),
                "n": np.concatenate([counts[some], np.full(len(linked), -1)]),
            }
        )

    return compare


def _sample(classes: DataFrame, n: int, rows: int, dimensions: int) -> list:
    """The vectors of the least hashes of their ids, `rows` or what SAMPLE_NUMBERS allows.

    A bound on the hash leaves little more than these to be ordered.
    """
    rows = max(1, min(rows, SAMPLE_NUMBERS // dimensions))
    order = F.xxhash64("rep")
    share = (1.2 * rows + 1000) / n
    some = classes if share >= 1 else classes.where(order < int(-(2**63) + share * 2**64))
    return [r[0] for r in some.orderBy(order, "rep").select("v").limit(rows).collect()]


def _parts(sized: DataFrame, *keys: str) -> DataFrame:
    """How many parts of about CELL_ROWS rows each group is cut into."""
    return sized.groupBy(*keys).agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts"))


def _asked(placed: DataFrame, index: Index, dimensions: int, threshold: float) -> DataFrame:
    """(low, high, list, rep): vectors of a list that have a candidate in the other of two lists."""
    salt = F.xxhash64("rep")
    asking = placed.select("rep", "query", "scale", "list", F.explode("probes").alias("at")).where("at <> list")
    bases = _parts(placed.select("list"), "list").select(F.col("list").alias("at"), F.col("parts").alias("bases"))
    asks = _parts(asking.select("at"), "at").select("at", F.col("parts").alias("asks"))
    # one row per list, MOST_LISTS at most
    parts = F.broadcast(stored(bases.join(asks, "at")))
    common = ["at", "base_part", "ask_part", "is_base", "rep", "code", "error", "query", "scale", "list"]
    nothing = F.lit(None).cast("binary")
    there = (
        placed.select("rep", "code", "error", "list", F.col("list").alias("at"))
        .join(parts, "at")
        .withColumn("base_part", F.pmod(salt, "bases").cast("int"))
        .withColumn("ask_part", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
        .withColumn("is_base", F.lit(True))
        .withColumn("query", nothing)
        .withColumn("scale", F.lit(0.0).cast("float"))
    )
    sent = (
        asking.join(parts, "at")
        .withColumn("ask_part", F.pmod(salt, "asks").cast("int"))
        .withColumn("base_part", F.explode(F.sequence(F.lit(0), F.col("bases") - 1)))
        .withColumn("is_base", F.lit(False))
        .withColumn("code", nothing)
        .withColumn("error", F.lit(0.0).cast("float"))
    )
    cells = there.select(common).union(sent.select(common)).groupBy("at", "base_part", "ask_part")
    return cells.applyInPandas(_candidates(index, dimensions, threshold), _CANDIDATES).distinct()


def _meetings(classes: DataFrame, placed: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of each meeting: two lists, the part of each, and the vectors of both sides."""
    own = placed.select(F.col("list").alias("low"), F.col("list").alias("high"), "list", "rep")
    called = stored(own.union(asked.select("low", "high", "list", "rep")))
    counted = _parts(called, "low", "high", "list")
    sizes = counted.groupBy("low", "high").agg(
        F.max(F.when(F.col("list") == F.col("low"), F.col("parts"))).alias("lefts"),
        F.max(F.when(F.col("list") == F.col("high"), F.col("parts"))).alias("rights"),
    )
    rows = called.join(sizes, ["low", "high"]).join(classes.select("rep", "copies", "v"), "rep")
    rows = rows.withColumn("size", F.size("v"))
    salt, one = F.xxhash64("rep"), F.col("low") == F.col("high")
    left = F.col("list") == F.col("low")
    mine = F.pmod(salt, F.when(left, F.col("lefts")).otherwise(F.col("rights"))).cast("int")
    others = F.when(left, F.col("rights")).otherwise(F.col("lefts"))
    # a list that meets itself: part i is on the left of every part from i on, on the right of those before
    after = F.sequence(F.col("mine"), F.col("rights") - 1)
    before = F.when(F.col("mine") > 0, F.sequence(F.lit(0), F.col("mine") - 1)).otherwise(F.array().cast("array<int>"))
    meets = F.when(
        one,
        F.concat(
            F.transform(after, lambda p: F.struct(F.lit(True).alias("is_left"), p.alias("other"))),
            F.transform(before, lambda p: F.struct(F.lit(False).alias("is_left"), p.alias("other"))),
        ),
    ).otherwise(F.transform(F.sequence(F.lit(0), others - 1), lambda p: F.struct(left.alias("is_left"), p.alias("other"))))
    split = rows.withColumn("mine", mine).withColumn("meets", F.explode(meets))
    return split.select(
        "low",
        "high",
        F.when(F.col("meets.is_left"), F.col("mine")).otherwise(F.col("meets.other")).alias("left_part"),
        F.when(F.col("meets.is_left"), F.col("meets.other")).otherwise(F.col("mine")).alias("right_part"),
        "meets.is_left",
        "rep",
        "copies",
        "size",
        "v",
    ).groupBy("low", "high", "left_part", "right_part")


def near_duplicates(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """One row per input row: vec_id, n_links (other vectors linked directly), component_id, kept.

    Links have a cosine of `threshold` at least, between vectors of equal length. Vectors
    that are null, empty, zero or hold null or non-finite numbers link with nothing and are
    components of their own; so is a row without an id, whose component is null. Equal
    vectors are one class with a count, whatever their number. kept is true for the row
    whose id names its component; a repeated id counts as another vector. Other columns
    are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    ship(spark)
    number = "float" if dict(table.dtypes)[vector_column] == "array<float>" else "double"
    v = F.col(vector_column).cast(f"array<{number}>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    valid = rows.where(good)
    classes = stored(
        valid.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    n, dimensions = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    lists = max(1, min(MOST_LISTS, int(2 * n**0.5)))
    sample = _sample(classes, n, max(SAMPLE_ROWS, lists * ROWS_A_LIST), dimensions)
    index = Index.fit(_unit(sample, dimensions), lists, threshold)
    step = _step(len(index.coarse))

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), step):
                some = part.iloc[at : at + step]
                unit = _unit(list(some["v"]), dimensions)
                near = _nearest(unit, index.coarse, index.probes)
                codes, error = index.encode(unit - index.coarse[near[:, 0]])
                scale = np.abs(unit).max(1) / _STEPS
                yield pd.DataFrame(
                    {
                        "rep": some["rep"].to_numpy(),
                        "size": [len(x) for x in some["v"]],
                        "code": [c.tobytes() for c in codes],
                        "error": error.astype(np.float32) + np.float32(1e-5),
                        "query": [q.tobytes() for q in np.rint(unit / scale[:, None]).astype(np.int8)],
                        "scale": scale.astype(np.float32) * np.float32(1 + 1e-6),
                        "list": near[:, 0].astype(np.int32),
                        "probes": list(near.astype(np.int32)),
                    }
                )

    placed = stored(classes.select("rep", "v").mapInPandas(assign, _ROW))
    asked = _asked(placed, index, dimensions, threshold)
    cells = _meetings(classes, placed, asked)
    found = stored(cells.applyInPandas(_meet(dimensions, threshold), "a long, b long, n long"))
    counted = found.where("n >= 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = components(found.where("n < 0").select("a", "b"))
    joined = (
        classes.select("rep", "copies", "v")
        .join(counted, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "rep", F.coalesce("root", "rep").alias("root"))
    )
    joined = stored(joined)
    least = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = stored(joined.join(least, "root").select("v", "n_links", "component_id"))
    linked = valid.join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
