"""Exact top-k items by inner product for every user, without scoring every pair (M19, §2.12 exclude-seen).

Users are dealt to groups by a hash of their id, one group per task, each with at most about ``GROUP_USERS`` users. Items are
dealt into bands by falling norm and a band into blocks by angle, the one between the norms of the first and the second half of the
factors. A group holds its users' factors and their k best items so far, and the blocks stream past
it once, in order:

- a score is at most the product of the norms, and of the cosine of what the angles are apart, and at most what the block's largest
  and smallest value of each factor allow; only users whose k-th best unseen score is within all are scored against a block. What is left out cannot hold an item of
  the list, ties included;
- one matrix product per tile of users, small enough for a core's cache, finds what may reach the lists, in the factors' own
  precision; these scores are computed again in double precision before they are compared;
- found items are put into the lists a bounded number at a time, so a task holds little beside its users' factors and lists;
- seen items arrive with their block, once per group, and are struck out in it: a list stays at k, however much a user has
  seen.

A user's factors are shuffled once, an item's once per group, a seen pair with its block; no pair of blocks and no candidate
is written. The number of groups is the session's parallelism until groups are full, so what is moved grows with users, items
and seen pairs. The arithmetic alone grows with users times items, less what the bounds rule out. Nothing is collected to the
driver or broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemlens.operators.topk import global_rank
from itemlens.session import configured, write_scratch_table

#: Users of a tile, which is scored at once and stays in a core's cache, and items of a block.
USER_BLOCK = 128
ITEM_BLOCK = 2048
#: Blocks of a band, a power of 2; the first bands have 1, 2, 4, ..., so that lists begin with the largest norms.
BAND_BLOCKS = 8
#: Users that are bounded at once, and cells that are sorted into the lists at once: what a task holds beside them.
CHUNK = 16_384
CANDIDATES = 1 << 18
#: Most users of a group on average; a task holds their factors and lists, about 400 bytes each.
GROUP_USERS = 500_000
#: Bytes of a batch that a task hands to Python: some blocks of items. Spark's own setting, its default is 64 MB.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20
#: Bounds are raised by this share of the product of norms, above the rounding of a dot product in single or double precision.
SLACK = {np.dtype(np.float32): 1e-5, np.dtype(np.float64): 1e-9}


def _norm(vector):
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _angle(vector: str):
    half = F.floor(F.size(vector) / 2).cast("int")
    return F.atan2(_norm(F.slice(vector, half + 1, F.size(vector))), _norm(F.slice(vector, F.lit(1), half)))


def item_blocks(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(blocks, places) of items (id, features): per block its number (0 has the largest norms, later bands have smaller ones), ids
    and factors; and per item the block and the place in it."""
    normed = items.select("id", "features", _norm("features").alias("norm"), _angle("features").alias("angle"))
    ranked = global_rank(normed, [F.desc("norm"), F.col("id")], rank_col="at")
    nth, width = F.floor((F.col("at") - 1) / size) + 1, 2
    first = F.when(nth < 2, F.lit(1))
    while width < BAND_BLOCKS:
        first, width = first.when(nth < 2 * width, F.lit(width)), 2 * width
    ranked = ranked.withColumn("first", first.otherwise(F.floor(nth / BAND_BLOCKS) * BAND_BLOCKS).cast("int"))
    turn = F.row_number().over(Window.partitionBy("first").orderBy("angle", "id")) - 1  # a band has at most BAND_BLOCKS blocks
    ranked = ranked.withColumn("turn", turn).withColumn("block", (F.col("first") - 1 + F.floor(F.col("turn") / size)).cast("int"))
    row = F.struct("turn", F.col("id").cast("bigint").alias("id"), F.col("features").alias("f"))
    blocks = ranked.groupBy("block").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    blocks = blocks.select("block", F.col("rows.id").alias("ids"), F.flatten("rows.f").alias("factors"))
    blocks = write_scratch_table(items.sparkSession, blocks, "item-blocks")
    return blocks, blocks.select("block", F.posexplode("ids").alias("place", "id"))


def _lengths(factors: np.ndarray) -> np.ndarray:
    return np.sqrt((factors.astype(np.float64) ** 2).sum(axis=1))


def _angles(factors: np.ndarray) -> np.ndarray:
    half = factors.shape[1] // 2
    return np.arctan2(_lengths(factors[:, half:]), _lengths(factors[:, :half]))


def _true_cells(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true cells of ``mask``, row by row, looked for eight cells at a time."""
    flat = mask.reshape(-1)
    words = len(flat) // 8 * 8
    some = np.flatnonzero(flat[:words].view(np.uint64))
    word, bit = np.nonzero(flat[:words].reshape(-1, 8)[some])
    at = np.concatenate([some[word] * 8 + bit, words + np.flatnonzero(flat[words:])])
    return np.divmod(at, mask.shape[1])


class _Group:
    """Users of a group with their ``k`` best items of the blocks so far."""

    def __init__(self, ids: np.ndarray, factors: np.ndarray, k: int):
        order = np.argsort(ids)
        self.k, self.ids, self.factors = k, ids[order], factors[order]
        chunks = [self.factors[i : i + CHUNK] for i in range(0, len(ids), CHUNK)]
        self.norm, self.angle = (np.concatenate([f(c) for c in chunks]) for f in (_lengths, _angles))
        self.slack = self.norm * SLACK[self.factors.dtype]
        self.score = np.full((len(ids), k), -np.inf)  # falling, then ids rising
        self.item = np.zeros((len(ids), k), dtype=np.int64)
        self.cut = np.full(len(ids), -np.inf)  # items of a smaller norm are out of the list
        self.pairs = 0

    def meet(self, item_ids: np.ndarray, factors: np.ndarray, struck_ids: np.ndarray, places: np.ndarray) -> None:
        """Scores a block against the users that it may matter to; ``struck_ids`` are users that have seen the item in ``places``."""
        wide = factors.astype(np.float64)
        top = float(_lengths(factors).max())
        high, low = wide.max(axis=0), wide.min(axis=0)
        angles = _angles(factors)
        angles = angles.min(), angles.max()
        near = np.flatnonzero(self.cut <= top)
        if not len(near):
            return
        at = np.searchsorted(self.ids, struck_ids)
        known = at < len(self.ids)
        known[known] = self.ids[at[known]] == struck_ids[known]
        order = np.argsort(at[known], kind="stable")
        struck = at[known][order], places[known][order]
        for i in range(0, len(near), CHUNK):
            own = near[i : i + CHUNK]
            f = self.factors[own].astype(np.float64)
            apart = np.maximum(np.maximum(angles[0] - self.angle[own], self.angle[own] - angles[1]), 0)
            bound = np.minimum(np.maximum(f, 0) @ high + np.minimum(f, 0) @ low, self.norm[own] * top * np.cos(apart))
            self._score(own[bound + self.slack[own] * top >= self.score[own, -1]], item_ids, factors, wide, top, struck)

    def _score(self, near, item_ids, factors, wide, top, struck) -> None:
        """Scores a block against the users ``near``, rising, and adds what may be in their lists. What is held at once is bounded."""
        self.pairs += len(near) * len(item_ids)
        n, found, held = len(item_ids), [], 0
        least = self.score[near, -1]
        slack = 2 * self.slack[near] * top
        lowest = np.finfo(factors.dtype).min  # above an item that is struck out
        reach = np.maximum(least - slack, lowest).astype(factors.dtype)
        unfilled = np.isneginf(least)
        users, places = struck
        for i in range(0, len(near), USER_BLOCK):
            tile, t = near[i : i + USER_BLOCK], slice(i, i + USER_BLOCK)
            scores = self.factors[tile] @ factors.T
            a, b = np.searchsorted(users, (tile[0], tile[-1] + 1))
            if a < b:
                turn = np.minimum(np.searchsorted(tile, users[a:b]), len(tile) - 1)
                here = tile[turn] == users[a:b]
                scores[turn[here], places[a:b][here]] = -np.inf
            if n > self.k and unfilled[t].any():
                kth = np.partition(scores, n - self.k, axis=1)[:, n - self.k]
                reach[t] = np.maximum(reach[t], np.maximum(kth - slack[t], lowest).astype(factors.dtype))
            user, place = _true_cells(scores >= reach[t, None])
            if len(user):
                user = tile[user]
                found.append((user, item_ids[place], np.einsum("ij,ij->i", self.factors[user].astype(np.float64), wide[place])))
                held += len(user)
            if found and (held >= CANDIDATES or i + USER_BLOCK >= len(near)):
                self.add(*(np.concatenate(x) for x in zip(*found)))
                found, held = [], 0

    def add(self, user: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        """Puts found items, ordered by user, into the lists: each list beside its user's new items is a row to sort."""
        user, start, count = np.unique(user, return_index=True, return_counts=True)
        order = np.argsort(count, kind="stable")  # rows of like width together
        i = 0
        while i < len(order):
            j = len(order)
            while j - i > 1 and (j - i) * (self.k + count[order[j - 1]]) > CANDIDATES:
                j = i + (j - i) // 2
            rows = order[i:j]
            at = np.arange(count[rows[-1]])
            new = start[rows, None] + np.minimum(at, count[rows, None] - 1)
            scores = np.concatenate([self.score[user[rows]], np.where(at < count[rows, None], score[new], -np.inf)], axis=1)
            items = np.concatenate([self.item[user[rows]], item[new]], axis=1)
            best = np.lexsort((items, -scores), axis=1)[:, : self.k]
            self.score[user[rows]] = np.take_along_axis(scores, best, axis=1)
            self.item[user[rows]] = np.take_along_axis(items, best, axis=1)
            i = j
        reach = self.norm[user] + self.slack[user]
        self.cut[user] = np.where(reach > 0, self.score[user, -1] / np.where(reach > 0, reach, 1), -np.inf)

    def rows(self) -> Iterator[tuple]:
        for i in range(0, len(self.ids), CHUNK):
            user, pos = np.nonzero(self.score[i : i + CHUNK] > -np.inf)
            yield self.ids[i + user], pos + 1, self.item[i + user, pos], self.score[i + user, pos]


FIELDS = "user_id bigint, pos int, item_id bigint, score double, scored bigint"


def _lists(k: int):
    """Lists of groups from rows of users, then of blocks, each after its struck pairs; and a row with the number of pairs scored."""

    def out(user, pos, item, score, scored) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int64())
        columns = [pa.array(c, t) for c, t in zip((user, pos, item, score, scored), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["user_id", "pos", "item_id", "score", "scored"])

    def done(group: _Group | None) -> Iterator[pa.RecordBatch]:
        if group is not None:
            for user, pos, item, score in group.rows():
                yield out(user, pos, item, score, [None] * len(user))
            yield out([None], [None], [None], [None], [group.pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, users, group, struck = None, [], None, None
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            key = col["part"].to_numpy(), col["block"].to_numpy(), col["kind"].to_numpy()
            change = np.logical_or.reduce([x[1:] != x[:-1] for x in key])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                part, kind = int(key[0][i]), int(key[2][i])
                if part != number:
                    yield from done(group)
                    number, users, group, struck = part, [], None, None
                ids, factors, places = (col[c].slice(i, j - i).flatten().to_numpy() for c in ("ids", "factors", "places"))
                if kind == 0:
                    users.append((ids, factors.reshape(len(ids), -1)))
                elif kind == 1:
                    struck = ids, places
                elif users:
                    group = group or _Group(*(np.concatenate(x) for x in zip(*users)), k)
                    group.meet(ids, factors.reshape(len(ids), -1), *(struck or nothing))
                    struck = None
        yield from done(group)

    return run


def top_items(
    user_factors: DataFrame, item_factors: DataFrame, k: int, seen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(lists, work). ``lists`` is (user_id, pos, item_id, score): every user's k best items that are not in ``seen``
    (user_id, item_id; repeated pairs count once), by score, then id; fewer where a user has fewer unseen items.
    ``work`` is one row: users, items, pairs (users x items) and pairs_scored.

    Both factor tables are (id, features) with one row per id, as MLlib's ``userFactors`` and ``itemFactors``.
    """
    spark = user_factors.sparkSession
    items, places = item_blocks(item_factors, ITEM_BLOCK)
    users = user_factors.select(F.col("id").cast("bigint").alias("id"), "features")
    n_users = users.count()
    groups = max(1, spark.sparkContext.defaultParallelism, -(-n_users // GROUP_USERS))
    part = lambda c: F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(groups)).cast("int").alias("part")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    number = lambda n, name: F.lit(n).cast("int").alias(name)
    vector = item_factors.schema["features"].dataType

    # Per group: its users, then the blocks in order, each after the pairs that are struck in it.
    held = users.select(
        part("id"), number(-1, "block"), number(0, "kind"), F.array("id").alias("ids"), F.col("features").alias("factors"), none("array<int>", "places")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    met = items.select(every, "block", number(2, "kind"), "ids", "factors", none("array<int>", "places"))
    sent = held.unionByName(met)
    if seen is not None:
        ids = places.select(F.col("id").cast("bigint").alias("item_id"), "block", "place")
        pairs = seen.select(part("user_id"), F.col("user_id").cast("bigint").alias("user_id"), "item_id").join(ids, "item_id")
        # At most the users of a group times the items of a block.
        struck = pairs.groupBy("part", "block").agg(F.collect_list(F.struct("user_id", "place")).alias("s"))
        sent = sent.unionByName(
            struck.select("part", "block", number(1, "kind"), F.col("s.user_id").alias("ids"), none(vector, "factors"), F.col("s.place").alias("places"))
        )
    sent = sent.repartitionById(groups, "part").sortWithinPartitions("part", "block", "kind")
    with configured(spark, BATCH_SETTING, str(BATCH_BYTES)):
        found = write_scratch_table(spark, sent.mapInArrow(_lists(k), FIELDS), "lists")
    scored = found.agg(F.coalesce(F.sum("scored"), F.lit(0)).alias("pairs_scored"))
    n_items = items.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("bigint").alias("n")).scalar()
    n = F.lit(n_users).cast("bigint")
    work = scored.select(n.alias("users"), n_items.alias("items"), (n * n_items).alias("pairs"), "pairs_scored")
    return found.where("user_id IS NOT NULL").select("user_id", "pos", "item_id", "score"), work
