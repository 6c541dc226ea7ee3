"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector o is rotated at random and reduced to the signs of its
coordinates, a unit vector s. With the stored correction a = <s, o> the product
x = <o, q> with any unit vector q is estimated without bias by <s, q> / a. The
error is sqrt(1 - a^2) / a times sqrt(1 - x^2) times the product of two unit
vectors in the dimensions beside o, one of which the random rotation makes
uniform. So that product exceeds EPSILON / sqrt(D - 1) hardly ever, and it
never exceeds 1. Pairs whose upper bound reaches the threshold are computed
exactly, in double precision; no other.

Pairs to be estimated come from hash tables on the sign bits of further
rotations. The number of bits follows from the number of vectors of a label,
so that buckets stay near BLOCK; the number of tables follows from the bits, so
that a pair at the threshold meets with probability 1 - MISS or more. Labels of
up to BLOCK vectors are compared whole. A bucket above BLOCK is dealt to pairs
of blocks. A pair that meets in several tables counts in the first one.
"""

from math import acos, log, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F

from echolex.llm.graph import components

THRESHOLD = 0.93
BLOCK = 2048
MISS = 1e-4
EPSILON = 5.0
MAX_BITS = 40
STRIP = 256
PAIRS = 1 << 15


def rotation(dim, number):
    """A random orthogonal matrix, the same everywhere."""
    random = np.random.Generator(np.random.PCG64([dim, number])).standard_normal((dim, dim))
    q, r = np.linalg.qr(random)
    return q * np.sign(np.diag(r))


def table_keys(unit, bits, tables):
    """One 64-bit key per table of each row: sign bits of consecutive rotated coordinates."""
    n, dim = unit.shape
    if bits == 0:
        return np.zeros((n, tables), np.int64)
    count = -(-bits * tables // dim)
    signs = np.concatenate([unit @ rotation(dim, 1 + k).T > 0 for k in range(count)], axis=1)
    signs = signs[:, : bits * tables].reshape(n, tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def tables_for(bits, threshold=THRESHOLD, miss=MISS):
    """Tables after which a pair at the threshold has missed all with probability `miss`."""
    if bits == 0:
        return 1
    return int(-(-log(miss) // log(1 - (1 - acos(threshold) / pi) ** bits)))


def may_reach(signs, a, queries, threshold):
    """Of all pairs of coded o (signs, a) and rotated unit q: can <o, q> reach the threshold?

    The error bound falls as <o, q> rises, so it is taken at the threshold.
    """
    dim = queries.shape[1]
    estimate = (signs @ queries.T) / (np.sqrt(dim) * a[:, None])
    spread = min(1.0, EPSILON / np.sqrt(max(dim - 1, 1)))
    error = spread * np.sqrt(np.maximum(0, 1 - a * a)) / a * np.sqrt(1 - threshold**2)
    return estimate + error[:, None] >= threshold - 1e-4


def _unit(vectors):
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def linked_pairs(left, right, same, threshold=THRESHOLD):
    """(i, j) of the rows of two matrices of unit vectors with product >= threshold.

    With `same` the matrices are one and only i < j counts.
    """
    dim = left.shape[1]
    turn = rotation(dim, 0).T
    rotated = (right @ turn).astype(np.float32)
    coded = left @ turn
    signs = np.where(coded > 0, 1, -1).astype(np.float32)
    a = (np.abs(coded).sum(axis=1) / np.sqrt(dim)).astype(np.float32)
    found = []
    for at in range(0, len(left), STRIP):
        near = may_reach(signs[at : at + STRIP], a[at : at + STRIP], rotated, threshold)
        i, j = np.nonzero(near)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS):
            p, q = i[k : k + PAIRS], j[k : k + PAIRS]
            exact = np.einsum("ij,ij->i", left[p], right[q]) >= threshold
            found.append((p[exact], q[exact]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _roots(n, i, j):
    """Smallest row connected to each of n rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            return root


def _matrix(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _usable(vector):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(vector, lambda x: x != 0)


def _keyed(classes):
    """Adds `keys`, one per table, to rows with label, bits, tables and vector."""

    def run(batches):
        for batch in batches:
            bits, tables = (batch.column(k).to_pylist() for k in (1, 2))
            size = pa.compute.list_value_length(batch.column(3)).to_pylist()
            kinds = {}
            for row, kind in enumerate(zip(bits, tables, size)):
                kinds.setdefault(kind, []).append(row)
            for (b, t, _), rows in sorted(kinds.items()):
                part = batch.take(pa.array(rows))
                keys = table_keys(_unit(_matrix(part.column(3))), b, t)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(rows) + 1, dtype=np.int32) * t), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in (0, 3, 4, 5)] + [lists],
                    names=["label", "vector", "rep", "n", "keys"],
                )

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("label", "bits", "tables", "vector", "rep", "n").mapInArrow(
        run, f"label {label}, vector array<double>, rep long, n long, keys array<long>"
    )


def _group_links(threshold):
    """Links inside one pair of blocks of a bucket: rep, links, root."""

    def run(key, rows):
        table, first, second = key[1].as_py(), key[4].as_py(), key[5].as_py()
        rows = rows.combine_chunks()
        rep, n, side = (rows[c].to_numpy() for c in ("rep", "n", "chunk"))
        order = np.argsort(rep, kind="stable")
        rep, n, side = rep[order], n[order], side[order]
        unit = _unit(_matrix(rows["vector"])[order])
        left, right = np.flatnonzero(side == first), np.flatnonzero(side == second)
        i, j = linked_pairs(unit[left], unit[right], first == second, threshold)
        i, j = left[i], right[j]
        if table:  # counted already where an earlier table has the pair
            keys = rows["keys"].combine_chunks() if hasattr(rows["keys"], "combine_chunks") else rows["keys"]
            keys = keys.flatten().to_numpy().reshape(len(rep), -1)[order][:, :table]
            fresh = np.concatenate(
                [~(keys[i[k : k + PAIRS]] == keys[j[k : k + PAIRS]]).any(axis=1) for k in range(0, len(i), PAIRS)]
                or [np.zeros(0, bool)]
            )
            i, j = i[fresh], j[fresh]
        links = np.bincount(i, n[j], minlength=len(rep)) + np.bincount(j, n[i], minlength=len(rep))
        root = _roots(len(rep), i, j)
        has = links > 0
        return pa.table(
            {"rep": rep[has], "links": links[has].astype(np.int64), "root": rep[root[has]]}
        )

    return run


def _same_id(base, classes):
    """(rep, root): classes that hold rows of one id, each with the first of them."""
    own = base.filter("same is not null and vec_id is not null").select("vec_id", "label", "same").distinct()
    own = own.join(classes.select("label", "same", "rep"), ["label", "same"]).select("vec_id", "rep")
    several = own.groupBy("vec_id").agg(F.min("rep").alias("root"), F.max("rep").alias("last"))
    several = several.filter("root < last").select("vec_id", "root")
    return own.join(several, "vec_id").filter("rep != root").select("rep", "root")


def near_vectors(rows, id_col="vec_id", vector_col="embedding", label_col="label", threshold=THRESHOLD):
    """vec_id, n_links, component_id, kept: one row per row.

    Only vectors of one label and one length are compared. A null label, and a
    vector that is null, empty, zero or holds a null or non-finite component,
    links with nothing. Equal vectors are one class: a link of the class counts
    for each of its rows, and each row links with the other copies. Rows of one
    id are one vector for components, whatever they hold, and count their links
    apart. A row without an id counts and is counted in links, leads from one
    vector to another, has no component itself and is kept. Repeated rows are
    copies of each other. An empty table gives no rows; other columns are
    ignored.
    """
    vector = F.col(vector_col).cast("array<double>")
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector"))
    usable = F.col("label").isNotNull() & F.coalesce(_usable("vector"), F.lit(False))
    base = base.withColumn("same", F.when(usable, F.md5(F.to_json("vector"))))
    classes = (
        base.filter("same is not null")
        .groupBy("label", "same")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("vector").alias("vector"))
        # Numbered before they are stored, so the numbers stay.
        .withColumn("rep", F.monotonically_increasing_id())
        .checkpoint()
    )
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("of_label"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("of_label") / BLOCK)), F.lit(0)), F.lit(MAX_BITS)).cast("int")
    tables = F.element_at(
        F.array(*[F.lit(tables_for(b, threshold)) for b in range(MAX_BITS + 1)]), F.col("bits") + 1
    )
    sizes = sizes.withColumn("bits", bits).withColumn("tables", tables)
    keyed = _keyed(classes.join(sizes, "label")).checkpoint()

    entries = keyed.select("label", F.size("vector").alias("dim"), "rep", F.posexplode("keys").alias("table", "key"))
    bucket = ["label", "table", "key", "dim"]
    blocks = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    blocks = blocks.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).drop("m")
    chunk = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    pair = F.transform(
        each, lambda k: F.struct(F.least(k, "chunk").alias("first"), F.greatest(k, "chunk").alias("second"))
    )
    met = (
        keyed.select("*", F.size("vector").alias("dim"), F.posexplode("keys").alias("table", "key"))
        .join(blocks, bucket)
        .withColumn("chunk", chunk)
        .withColumn("pair", F.explode(pair))
        .select(*bucket, "pair.first", "pair.second", "rep", "n", "vector", "keys", "chunk")
    )
    found = (
        met.groupBy(*bucket, "first", "second")
        .applyInArrow(_group_links(threshold), "rep long, links long, root long")
        .checkpoint()
    )
    edges = found.select("rep", "root").unionAll(_same_id(base, classes)).distinct()
    groups = components(edges, "rep", "root").select(F.col("node").alias("rep"), "component")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.drop("vector").join(links, "rep", "left").join(groups, "rep", "left")
    known = known.withColumn("component", F.coalesce("component", "rep"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select(
        "label", "same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    out = base.select("vec_id", "label", "same").join(known, ["label", "same"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
