"""Exact top-k search by inner product with one KD-tree per shard.

**Shards.** A sample of ``SAMPLE`` vectors (those with the smallest hashes) gives median splits of
space into at most ``SAMPLE / REGION`` regions. Every vector belongs to a region; a region of more than
``SHARD`` vectors is dealt out over several shards by hash, so a shard stays small however many vectors are alike.

**Trees.** Each shard is split at the median of its widest side down to leaves of ``LEAF`` vectors. Every
node has the tight bounding box of its vectors. For a query q, the sum over all sides of the larger of
q * low and q * high bounds every inner product in the box. Best-first traversal opens the node of
the highest bound and ends as soon as that is below the query's kth best score.

**Rounds.** A query is searched in its own shard first. Its kth score there goes with it to the other
regions, which it enters only if the bound of the region's box reaches the kth score; inside, the
trees are searched with that score as the start. Shards and teams of about ``GROUP`` queries meet by cogroup; a
shard goes only to the teams that have a query for it. The sample shapes the regions only; results are exact.

Rows that are equal in id and vector are one candidate with a number of copies. Defined results: a
vector that is null, holds a null or a non-finite component, or has no id takes no part; vectors of different
lengths do not compare; of a row's copies each is a result of the others; ties go to the smaller id; a
query without any candidate and an empty table give no rows. Other columns are not looked at.
"""

import heapq
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow.llm import common

K, EVERY = 20, 20
SAMPLE, REGION, SHARD, LEAF = 4096, 64, 4096, 128
GROUP = 32_768  # queries that meet a shard at a time


class Tree:
    """Boxes and ranges of rows of all nodes; children follow their parent."""

    def __init__(self, points: np.ndarray, leaf: int):
        n, d = points.shape
        self.order = np.arange(n)
        self.low, self.high, self.range, self.child, self.cut = [], [], [], [], []
        open_ = [(0, n, -1)]
        while open_:
            lo, hi, parent = open_.pop()
            rows = self.order[lo:hi]
            own = points[rows]
            low, high = own.min(axis=0), own.max(axis=0)
            node = len(self.range)
            self.low.append(low)
            self.high.append(high)
            self.range.append((lo, hi))
            self.child.append([])
            self.cut.append(None)
            if parent >= 0:
                self.child[parent].append(node)
            if hi - lo <= leaf or not d or (high == low).all():
                continue
            side = int((high - low).argmax())
            value = int(np.partition(own[:, side], (hi - lo) // 2)[(hi - lo) // 2])
            if value == low[side]:
                value += 1  # half of the rows or more have the least value
            left = own[:, side] < value
            self.order[lo:hi] = np.concatenate((rows[left], rows[~left]))
            self.cut[node] = (side, value)
            middle = lo + int(left.sum())
            open_ += [(middle, hi, node), (lo, middle, node)]  # the left child comes first
        self.low, self.high = np.stack(self.low), np.stack(self.high)

    def regions(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls into."""
        out = np.zeros(len(points), dtype=np.int64)
        open_ = [(0, np.arange(len(points)))]
        while open_:
            node, rows = open_.pop()
            if self.cut[node] is None:
                out[rows] = node
                continue
            side, value = self.cut[node]
            left = points[rows, side] < value
            a, b = self.child[node]
            open_ += [(a, rows[left]), (b, rows[~left])]
        return out


def _kind(a: np.ndarray, *others: np.ndarray) -> type:
    """The type in which inner products of whole numbers are exact; floats are faster."""
    most = max((float(np.abs(b).max(initial=0)) for b in others), default=0.0)
    exact = float(np.abs(a).max(initial=0)) * most * max(1, a.shape[-1]) < 2**53
    return np.float64 if exact else np.int64


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Highest possible inner product of each query with a point of each box."""
    kind = _kind(queries, low, high)
    queries, low, high = queries.astype(kind), low.astype(kind), high.astype(kind)
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search(
    tree: Tree, ids: np.ndarray, points: np.ndarray, queries: np.ndarray,
    floors: np.ndarray, skip: np.ndarray, k: int = K,
) -> list[list[tuple[int, int]]]:
    """For each query its best k rows of the shard as (score, row), none below the query's floor.

    ``ids`` and ``points`` are in the tree's order; ``skip`` is a row that is no candidate, or -1.
    """
    reach = bounds(queries, tree.low, tree.high)
    kind = _kind(queries, points)
    points, queries = points.astype(kind), queries.astype(kind)
    out = []
    for q, floor, own, bound in zip(queries, floors.tolist(), skip.tolist(), reach.tolist()):
        queue, best = [(-bound[0], 0)], []
        while queue:
            negative, node = heapq.heappop(queue)
            if -negative < floor:
                break
            if tree.child[node]:
                for c in tree.child[node]:
                    if bound[c] >= floor:
                        heapq.heappush(queue, (-bound[c], c))
                continue
            lo, hi = tree.range[node]
            scores = points[lo:hi] @ q
            hit = np.flatnonzero(scores >= floor)
            if not len(hit):
                continue
            if len(hit) > k:
                hit = hit[np.lexsort((ids[lo + hit], -scores[hit]))[: k + 1]]
            best += [(-int(s), i, r) for s, i, r in
                     zip(scores[hit].tolist(), ids[lo + hit].tolist(), (lo + hit).tolist()) if r != own]
            if len(best) >= k:
                best = heapq.nsmallest(k, best)
                floor = max(floor, -best[-1][0])
        out.append([(-s, r) for s, _, r in sorted(best)[:k]])
    return out


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, v (floor of 64 times each component), copies: the vectors that take part, each once."""
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .filter(
            "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> coalesce("
            "NOT isnan(x) AND abs(CAST(x AS DOUBLE)) < double('infinity'), false))"
        )
        .selectExpr("vec_id", "transform(embedding, x -> CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v")
        .groupBy("vec_id", "v")
        .agg(F.count("*").alias("copies"))
    )


def _matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _region_trees(unique: DataFrame) -> dict[int, Tree]:
    """Splits of space by the length of the vectors, from the bounded sample."""
    drawn = unique.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE).select("v").collect()
    by_length: dict[int, list] = {}
    for row in drawn:
        by_length.setdefault(len(row["v"]), []).append(row["v"])
    return {d: Tree(np.array(rows, dtype=np.int64).reshape(len(rows), d), REGION) for d, rows in by_length.items()}


def _with_region(unique: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    def run(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            region = np.zeros(batch.num_rows, dtype=np.int64)
            for d in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == d)
                if d in trees:
                    region[rows] = trees[d].regions(_matrix(batch.column("v").take(pa.array(rows)), d))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths.astype(np.int64)), pa.array(region)],
                names=[*batch.schema.names, "length", "region"],
            )

    return unique.mapInArrow(run, "vec_id long, v array<long>, copies long, length long, region long")


_SHARD = "length long, region long, part long, low array<long>, high array<long>, shard binary, asked binary"


def _built(k: int, every: int):
    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """A shard's tree, and its own queries with what they find in it."""
        length, region, part = (x.as_py() for x in key)
        ids = table.column("vec_id").to_numpy()
        by_id = np.argsort(ids, kind="stable")
        ids, copies = ids[by_id], table.column("copies").to_numpy()[by_id]
        points = _matrix(table.column("v"), length)[by_id]
        tree = Tree(points, LEAF)
        ids, copies, points = ids[tree.order], copies[tree.order], points[tree.order]
        own = np.flatnonzero(ids % every == 0)
        skip = np.where(copies[own] == 1, own, -1)
        found = search(tree, ids, points, points[own], np.full(len(own), -np.inf), skip, k)
        # Copies may fill the k places earlier, so the last of k rows is a floor that is never too high.
        floors = np.array([best[-1][0] if len(best) == k else -np.inf for best in found])
        asked = {
            "at": np.repeat(own, [len(b) for b in found]),
            "hit": np.array([r for b in found for _, r in b], dtype=np.int64),
            "score": np.array([s for b in found for s, _ in b], dtype=np.int64),
            "own": own, "floor": floors, "points": points[own], "ids": ids[own], "copies": copies[own],
        }
        asked["hit_id"] = ids[asked["hit"]]
        asked["hit_copies"] = copies[asked["hit"]] - (asked["hit"] == asked["at"])
        low, high = points.min(axis=0), points.max(axis=0)
        return pa.table(
            {
                "length": [length], "region": [region], "part": [part],
                "low": pa.array([low.tolist()], pa.list_(pa.int64())),
                "high": pa.array([high.tolist()], pa.list_(pa.int64())),
                "shard": [pickle.dumps((tree, ids, copies, points))],
                "asked": pa.array([pickle.dumps(asked) if len(own) else None], pa.binary()),
            }
        )

    return build


_HITS = "query_id long, query_key long, query_copies long, vec_id long, score long, copies long"


def _hits(query_id, key, query_copies, ids, scores, copies) -> pa.Table:
    names = [part.split()[0] for part in _HITS.split(", ")]
    columns = (query_id, key, query_copies, ids, scores, copies)
    return pa.table({n: pa.array(np.asarray(c, dtype=np.int64)) for n, c in zip(names, columns)})


def _key(row: dict, own: np.ndarray) -> np.ndarray:
    """Tells apart the queries of one id and different vectors."""
    place = row["length"] << 50 | row["region"] << 40 | row["part"] << 14
    return np.int64(place % 2**63) + own


def _home(batches):
    for batch in batches:
        for row in batch.to_pylist():
            a = pickle.loads(row["asked"])
            at = np.searchsorted(a["own"], a["at"])
            yield from _hits(
                a["ids"][at], _key(row, a["at"]), a["copies"][at],
                a["hit_id"], a["score"], a["hit_copies"],
            ).to_batches()


def _sent(boxes: dict, groups: int):
    """Queries of each shard, once for every shard elsewhere that may hold a better row."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a = pickle.loads(row["asked"])
                home = (row["length"], row["region"], row["part"])
                group = hash(home) % groups
                for (length, region), (parts, low, high) in boxes.items():
                    if length != home[0]:
                        continue
                    able = bounds(a["points"], low[None], high[None])[:, 0] >= a["floor"]
                    if not able.any():
                        continue
                    load = pickle.dumps(
                        (a["points"][able], a["floor"][able], a["ids"][able],
                         _key(row, a["own"][able]), a["copies"][able])
                    )
                    parts = [p for p in range(parts) if (length, region, p) != home]
                    if parts:
                        yield pa.RecordBatch.from_pydict(
                            {"length": [length] * len(parts), "region": [region] * len(parts),
                             "part": parts, "team": [group] * len(parts), "load": [load] * len(parts)}
                        )

    return run


def _visited(k: int):
    def visit(key: tuple[pa.Scalar, ...], shards: pa.Table, loads: pa.Table) -> pa.Table:
        found = [_hits(*[[]] * 6)]
        if shards.num_rows and loads.num_rows:
            tree, ids, copies, points = pickle.loads(shards.column("shard")[0].as_py())
            for load in loads.column("load"):
                queries, floors, query_ids, keys, times = pickle.loads(load.as_py())
                none = np.full(len(queries), -1)
                hits = search(tree, ids, points, queries, floors, none, k)
                at = np.repeat(np.arange(len(queries)), [len(h) for h in hits])
                rows = np.array([r for h in hits for _, r in h], dtype=np.int64)
                scores = np.array([s for h in hits for s, _ in h], dtype=np.int64)
                found.append(_hits(query_ids[at], keys[at], times[at], ids[rows], scores, copies[rows]))
        return pa.concat_tables(found)

    return visit


def entered(shards: DataFrame, loads: DataFrame) -> DataFrame:
    """A shard once for each team with a query that enters it; shards that none enters are left out."""
    teams = loads.select("length", "region", "part", F.col("team").alias("team")).distinct()
    return shards.join(teams, ["length", "region", "part"])


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the rows whose id is divisible by ``every``."""
    unique = common.stored(whole_numbers(vectors), "vectors")
    placed = common.stored(_with_region(unique, _region_trees(unique)), "placed")
    sizes = placed.groupBy("length", "region").agg(
        F.expr(f"CAST(ceil(count(*) / {SHARD}) AS BIGINT)").alias("parts")
    )
    dealt = placed.join(sizes, ["length", "region"]).withColumn(
        "part", F.expr("pmod(xxhash64(vec_id, v), parts)")
    )
    shards = dealt.groupBy("length", "region", "part").applyInArrow(_built(k, every), _SHARD)
    shards = common.stored(shards, "shards")
    asking = shards.filter("asked IS NOT NULL").select("length", "region", "part", "asked")

    # One box for each region: at most SAMPLE / REGION regions for each length of vectors.
    sides = shards.selectExpr(
        "length", "region", "part", "posexplode_outer(arrays_zip(low, high)) AS (side, box)"
    ).groupBy("length", "region", "side").agg(
        F.min("box.low").alias("low"), F.max("box.high").alias("high"), F.count_distinct("part").alias("parts")
    )
    boxes: dict = {}
    for row in sides.orderBy("length", "region", "side").collect():
        parts, low, high = boxes.setdefault((row["length"], row["region"]), (row["parts"], [], []))
        if row["side"] is not None:
            low.append(row["low"])
            high.append(row["high"])
    boxes = {key: (parts, np.array(low, np.int64), np.array(high, np.int64)) for key, (parts, low, high) in boxes.items()}

    n = unique.filter(F.col("vec_id") % every == 0).count()
    groups = -(-n // GROUP) or 1
    keys = ("length", "region", "part", "team")
    # Stored, as they are read twice: first for the shards that any of a team's queries enters, only these are copied.
    loads = common.stored(
        asking.mapInArrow(_sent(boxes, groups), "length long, region long, part long, team long, load binary"), "loads"
    )
    teams = entered(shards.select("length", "region", "part", "shard"), loads)
    away = teams.groupBy(*keys).cogroup(loads.groupBy(*keys)).applyInArrow(_visited(k), _HITS)
    hits = asking.mapInArrow(_home, _HITS).unionByName(away)
    hits = hits.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    ranked = hits.selectExpr(
        "*", "row_number() OVER (PARTITION BY query_id, query_key ORDER BY score DESC, vec_id, copy) AS rank"
    ).filter(F.col("rank") <= k)
    return ranked.withColumn("asked", F.explode(F.sequence(F.lit(1), "query_copies"))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op1_kdtree_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS place, CAST(vec_id AS BIGINT) AS vec_id,
         [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id % 20 = 0 AND q.place <> c.place AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
