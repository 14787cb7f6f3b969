"""Product codes of vectors: integer codebooks per part, nearest entries by kd-trees, entries moved by distributed sums.

Every component x becomes floor(4096 * x), so all that follows is integer arithmetic and the same on any partitioning. A
vector is cut into equal consecutive parts. Each round broadcasts one kd-tree per part (a codebook has a fixed number of
entries, so the broadcast is bounded by parts x entries x width). A task searches its Arrow batches for all rows at once:
rows go down the tree in groups, nearer child first, and a subtree is passed over only where the distance to its box is
greater than the best so far. Subtrees of equal bound are visited, so of equal distances the lower index stays. A task
hands on one sum and one count per entry and component, whatever its number of rows; Spark adds them up.

Vectors that are null, empty, or hold null or non-finite components are dropped, and so are vectors of another length
than the kept one with the smallest vec_id. A length that the number of parts does not divide, and components of 2**15 or
more (their distances would leave 64 bits) are refused with an error. Rows that share a vec_id are rows of
their own, in the order of their components; a null vec_id sorts last. With fewer kept rows than entries, a codebook
has as many entries as there are rows. Null labels are one group. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import bounded_batches, release, scratch_table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Entries of a leaf of a tree.
LEAF = 2
#: Components from this size on are refused.
LARGEST = 1 << 15
#: Sums per label are broadcast up to this many labels; beyond it the join shuffles.
BROADCAST_LABELS = 1 << 18


@dataclass
class Node:
    """A box around entries; a leaf holds their indexes, another node two children."""

    low: np.ndarray
    high: np.ndarray
    index: np.ndarray | None = None
    children: tuple[Node, Node] | None = None


def build_tree(entries: np.ndarray, index: np.ndarray | None = None) -> Node:
    """Halves at the median of the component with the widest range."""
    index = np.arange(len(entries)) if index is None else index
    own = entries[index]
    low, high = own.min(axis=0), own.max(axis=0)
    if len(index) <= LEAF:
        return Node(low, high, index=np.sort(index))
    order = index[np.argsort(own[:, np.argmax(high - low)], kind="stable")]
    half = len(order) // 2
    return Node(low, high, children=(build_tree(entries, order[:half]), build_tree(entries, order[half:])))


def nearest(tree: Node, entries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point, the lower one of equals, and its squared distance."""
    found = np.full(len(points), len(entries), "i8")
    best = np.full(len(points), np.iinfo("i8").max, "i8")

    def bound(node: Node, rows: np.ndarray) -> np.ndarray:
        at = points[rows]
        outside = np.maximum(np.maximum(node.low - at, at - node.high), 0)
        return np.einsum("ij,ij->i", outside, outside)

    def visit(node: Node, rows: np.ndarray, least: np.ndarray) -> None:
        open_ = least <= best[rows]
        rows = rows[open_]
        if not len(rows):
            return
        if node.children is None:
            for i in node.index:
                apart = points[rows] - entries[i]
                far = np.einsum("ij,ij->i", apart, apart)
                wins = (far < best[rows]) | (far == best[rows]) & (i < found[rows])
                found[rows[wins]], best[rows[wins]] = i, far[wins]
            return
        left, right = node.children
        to_left, to_right = bound(left, rows), bound(right, rows)
        first = to_left <= to_right
        for near, far, side in ((left, right, first), (right, left, ~first)):
            if side.any():
                near_bound, far_bound = (to_left, to_right) if near is left else (to_right, to_left)
                visit(near, rows[side], near_bound[side])
                visit(far, rows[side], far_bound[side])

    rows = np.arange(len(points))
    visit(tree, rows, bound(tree, rows))
    return found, best


def _points(column: pa.Array, parts: int) -> np.ndarray:
    """rows x parts x width."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("i8")
    return flat.reshape(len(column), parts, -1)


def _assign(codebooks: np.ndarray, trees: list[Node], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and part the entry, and per row the squared distances summed over parts."""
    found = np.empty(points.shape[:2], "i8")
    error = np.zeros(len(points), "i8")
    for p, tree in enumerate(trees):
        found[:, p], apart = nearest(tree, codebooks[p], np.ascontiguousarray(points[:, p]))
        error += apart
    return found, error


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])


def _entry_sums(shared):
    def run(batches):
        codebooks, trees = shared.value
        parts, entries, width = codebooks.shape
        total, n = np.zeros((parts * entries, width), "i8"), np.zeros(parts * entries, "i8")
        for batch in batches:
            if batch.num_rows:
                points = _points(batch.column(0), parts)
                cell = _assign(codebooks, trees, points)[0] + np.arange(parts) * entries
                np.add.at(total, cell.ravel(), points.reshape(-1, width))
                n += np.bincount(cell.ravel(), minlength=parts * entries)
        used = np.flatnonzero(n)
        part, entry = np.divmod(np.repeat(used, width), entries)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(np.tile(np.arange(width), len(used)), pa.int32()), pa.array(total[used].ravel()), pa.array(np.repeat(n[used], width))], schema=_SUMS
        )

    return run


def _encode(shared):
    def run(batches):
        codebooks, trees = shared.value
        hexes = np.array([f"{i:02x}" for i in range(codebooks.shape[1])])
        for batch in batches:
            if batch.num_rows:
                found, error = _assign(codebooks, trees, _points(batch.column("q"), len(trees)))
                code = ["".join(row) for row in hexes[found].tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def quantised(vectors: DataFrame, *, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q: the kept vectors with integer components."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(~broken)
    fits = F.forall("embedding", lambda x: F.abs(x) < LARGEST)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component of {LARGEST} or more"))).alias("q"))


def _shared(spark, codebooks: np.ndarray):
    return spark.sparkContext.broadcast((codebooks, [build_tree(c) for c in codebooks]))


def train_codebooks(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x width) of rows with an integer array q of one length; None of an empty table."""
    spark = rows.sparkSession
    bounded_batches(spark, rows=8192)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not first:
        return None
    width = len(first[0].q)
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    codebooks = np.array([r.q for r in first], "i8").reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        shared = _shared(spark, codebooks)
        sums = rows.select("q").mapInArrow(_entry_sums(shared), "part int, entry int, place int, total long, n long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():  # parts x entries x width rows at most
            codebooks[r.part, r.entry, r.place] = int(r.total) // r.n
        shared.destroy()
    return codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256, label of every kept vector."""
    spark = vectors.sparkSession
    whole = scratch_table(quantised(vectors, scale=scale), "codes-quantised")
    head = whole.orderBy(F.col("vec_id").asc_nulls_last(), "q").select(F.size("q").alias("n")).first()
    rows = whole.filter(F.size("q") == (head.n if head else 0))
    codebooks = train_codebooks(rows, parts=parts, entries=entries, rounds=rounds)
    label = vectors.schema["label"].dataType
    if codebooks is None:
        release(whole)
        schema = StructType([StructField("vec_id", LongType()), StructField("code", StringType()), StructField("error", LongType()), StructField("label_error", LongType()), StructField("codebooks_sha256", StringType()), StructField("label", label)])
        return spark.createDataFrame([], schema)
    shared = _shared(spark, codebooks)
    schema = StructType([StructField("vec_id", LongType()), StructField("label", label), StructField("code", StringType()), StructField("error", LongType())])
    coded = scratch_table(rows.mapInArrow(_encode(shared), schema), "codes-coded")
    shared.destroy()
    release(whole)
    sums = scratch_table(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"), "label")


def oracle_sql(*, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same as DuckDB SQL over `embeddings`, every round a table of its own."""
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS r, vec_id, label, q
            FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS q FROM embeddings
                  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
        f"""cells AS MATERIALIZED (
            SELECT r, label, (i - 1) // (len(q) // {parts}) AS part, (i - 1) % (len(q) // {parts}) AS place, q[i] AS v
            FROM (SELECT r, label, q, unnest(range(1, len(q) + 1)) AS i FROM kept))""",
        f"book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, v FROM cells WHERE r <= {entries})",
    ]
    nearest_of = """SELECT part, r, min(apart) AS apart, arg_min(entry, (apart, entry)) AS entry
            FROM (SELECT c.part, c.r, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS apart FROM cells c JOIN book{k} b ON c.part = b.part AND c.place = b.place GROUP BY ALL) GROUP BY ALL"""
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({nearest_of.format(k=k)})")
        steps.append(
            f"""book{k + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, b.place, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.v) AS v
            FROM book{k} b LEFT JOIN (SELECT part, entry, place, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM cells JOIN near{k} USING (part, r) GROUP BY ALL) m USING (part, entry, place))"""
        )
    steps.append(f"near{rounds} AS MATERIALIZED ({nearest_of.format(k=rounds)})")
    steps.append(f"""coded AS MATERIALIZED (
            SELECT kept.vec_id, kept.label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(apart) AS BIGINT) AS error
            FROM near{rounds} JOIN kept USING (r) GROUP BY r, kept.vec_id, kept.label)""")
    return "WITH " + ", ".join(steps) + f"""
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256, label
        FROM coded"""
