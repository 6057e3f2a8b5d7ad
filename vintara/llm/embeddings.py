"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is rotated by a random orthogonal matrix and its signs are kept: 1 bit a dimension,
beside the correction factor, the inner product of the rotated vector with its own code. For two
vectors o and q the quotient <code(o), q> / <code(o), o> is an unbiased estimate of <o, q>, and its
error is bounded, at a confidence of ``sigmas`` deviations, by sqrt((1 - f^2) / f^2 / (d - 1)). Pairs
whose upper bound stays below the threshold are settled by their codes; the others are computed
again from the vectors in double precision.

Which pairs meet is decided by sign bits as well: bits of further rotations make the keys of
several tables, as many as it takes for a pair at the threshold to agree in all bits of some table
with probability ``1 - miss``; keys get longer as rows grow, so that cells keep their size. A pair
counts in the first table where it meets. A cell with too many members is dealt out into cells of
bounded size; it gives the number of links of each vector and a spanning forest, never its pairs.
Equal vectors meet once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.llm import common
from vintara.llm.components import components
from vintara.llm.simhash import HOME, cells_of, dealt, join_labels, whole_cells
from vintara.operators.joins import lookup_join
from vintara.session import settle

common.by_value(__name__)

#: Rows that share a key by chance, and the bits a key has at least.
CHANCE, LEAST_BITS = 64, 4
#: Pairs estimated at a time.
_PAIRS = 1 << 20


def rotation(d: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every run."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs packed to bytes, correction factor) of unit vectors."""
    turned = unit @ turn.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def error(factor: np.ndarray, d: int, sigmas: float) -> np.ndarray:
    return sigmas * np.sqrt(np.maximum(0, 1 - factor ** 2) / factor ** 2 / max(1, d - 1))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)  # no overflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def tables(rows: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits of a key, tables): a pair at the threshold meets in none with probability ``miss``."""
    bits = max(LEAST_BITS, (rows // CHANCE).bit_length())
    agree = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return bits, 1 if agree >= 1 else math.ceil(math.log(miss) / math.log(1 - agree))


def _members(bits: int, count: int, seed: int):
    """Rows (anchor, home, id, n, keys, code, factor, vector): one for each table."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for d in map(int, np.unique(sizes)):
                rows = batch.filter(pa.array(sizes == d))
                unit = _unit(_matrix(rows.column("vector")))
                code, factor = codes(unit, rotation(d, seed))
                planes = np.concatenate([rotation(d, seed + 1 + i) for i in range(-(-bits * count // d))])
                signs = (unit @ planes[:bits * count].T > 0).reshape(len(unit), count, bits)
                keys = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(2)
                n = len(unit)
                packed = pa.array([k.tobytes() for k in keys.astype("<u4")], pa.binary())
                stored = pa.array([c.tobytes() for c in code], pa.binary())
                at = pa.array(np.tile(np.arange(n), count))
                anchor = (((d << 12) + np.arange(count))[:, None] << 32) + keys.T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.ravel()), pa.array(np.ones(n * count, bool)), rows.column("id").take(at),
                     rows.column("n").take(at), packed.take(at), stored.take(at),
                     pa.array(factor.astype(np.float32)).take(at), rows.column("vector").take(at)],
                    ["anchor", "home", "id", "n", "keys", "code", "factor", "vector"])

    return members


def _compare(threshold: float, sigmas: float, seed: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in whole_cells(batches, 1 << 12):
            homes, starts, sizes = cells_of(cells)
            for begin in np.unique(starts):
                own = homes[starts == begin] - begin
                yield _cell(cells.slice(begin, int(sizes[starts == begin][0])).combine_chunks(), own)

    def _cell(cell: pa.Table, homes: np.ndarray) -> pa.RecordBatch:
        column = {c: cell.column(c).chunk(0) for c in cell.column_names}
        anchor = column["anchor"][0].as_py()
        table, d = anchor >> 32 & 0xFFF, anchor >> 44
        unit = _unit(_matrix(column["vector"]))
        turned = (unit @ rotation(d, seed).T).astype(np.float32)
        bits = np.frombuffer(b"".join(column["code"].to_pylist()), np.uint8).reshape(len(unit), -1)
        signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
        keys = np.frombuffer(b"".join(column["keys"].to_pylist()), "<u4").reshape(len(unit), -1)
        factor = column["factor"].to_numpy().astype(np.float64)
        scale, margin = 1 / math.sqrt(d) / factor, error(factor, d, sigmas)
        ids, n = column["id"].to_numpy(), column["n"].to_numpy()
        member = column["role"].to_numpy() != HOME
        label, count = np.arange(len(unit)), np.zeros(len(unit), np.int64)
        step = max(1, _PAIRS // len(unit))
        for at in range(0, len(homes), step):
            some = homes[at:at + step]
            # the estimate of each pair from the member's code, and its upper bound
            i, j = np.nonzero((turned[some] @ signs.T) * scale + margin >= threshold)
            left, right = some[i], j
            use = member[right] & (ids[left] != ids[right])
            left, right = left[use], right[use]
            # a pair that met in an earlier table has been counted there
            first = np.ones(len(left), bool)
            for earlier in range(table):
                first &= keys[left, earlier] != keys[right, earlier]
            left, right = left[first], right[first]
            hit = np.einsum("ij,ij->i", unit[left], unit[right]) >= threshold
            left, right = left[hit], right[hit]
            np.add.at(count, left, n[right])
            join_labels(label, left, right)
        linked = np.flatnonzero((count > 0) | (label != np.arange(len(unit))))
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]]), pa.array(count[linked])],
                                          ["a", "b", "n"])

    return compare


def links(vectors: DataFrame, threshold: float = 0.95, miss: float = 1e-4, sigmas: float = 4.5,
          seed: int = 7) -> DataFrame:
    """Rows (a, b, n) for ``vectors(id, n, vector)`` with ids and vectors that are all different:
    links that span what is linked, and parts of the number of vectors that a links to."""
    bits, count = tables(vectors.count(), threshold, miss)
    kind = dict(vectors.dtypes)["vector"]
    members = common.tuned(vectors).select("id", "n", "vector").mapInArrow(
        _members(bits, count, seed),
        f"anchor long, home boolean, id long, n long, keys binary, code binary, factor float, vector {kind}")
    return dealt(members).mapInArrow(_compare(threshold, sigmas, seed), "a long, b long, n long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    threshold: float = 0.95, **options) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept``, a row for each row of the vectors.

    ``n_links`` counts the other rows whose cosine reaches the threshold, ``component_id`` is the
    smallest id reachable, and that row is kept. A vector that is null, empty or zero, or has a
    null, infinite or undefined component links with nothing; vectors of different lengths do not
    link. Rows that repeat an id are rows of their own; a row without an id is kept if nothing it
    reaches has one.
    """
    v = F.col(vector)
    finite = F.coalesce(F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))
    usable = finite & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = settle(common.tuned(vectors).select(F.col(vec_id).cast("long").alias("vec_id"), F.when(usable, v).alias("vector")))
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = settle(classes.withColumn("id", F.monotonically_increasing_id()))
    found = settle(links(classes, threshold, **options))
    counts = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    roots = components(found).withColumnRenamed("node", "id")
    rooted = settle(lookup_join(lookup_join(classes, counts, ["id"]), roots, ["id"]).select(
        "vector", "least", F.coalesce("root", "id").alias("root"),
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    named = lookup_join(rooted, rooted.groupBy("root").agg(F.min("least").alias("component_id")), ["root"])
    out = lookup_join(rows, named.select("vector", "n_links", "component_id"), ["vector"])
    own = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"),
                      F.col("vec_id").eqNullSafe(own).alias("kept"))
